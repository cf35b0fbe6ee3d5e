"""The dashboard document: one JSON object, made of small aggregates."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlake.operators import journey, kpis, scoring
from cartlake.plans.layers import Layers
from cartlake.session import stage

SAMPLE_CARTS = 50


def section(name: str, one_row: DataFrame) -> DataFrame:
    return one_row.select(F.lit(name).alias("name"), F.to_json(F.struct("*")).alias("body"))


def mapped(name: str, rows: DataFrame, key: str, value: str) -> DataFrame:
    """A few rows as one JSON object; the caller bounds the number of rows."""
    entries = F.sort_array(F.collect_list(F.struct(F.col(key).cast("string").alias("k"), F.col(value).alias("v"))))
    return rows.agg(F.to_json(F.map_from_entries(entries)).alias("body")).select(F.lit(name).alias("name"), "body")


def cart_cards(scored: DataFrame, n: int = SAMPLE_CARTS) -> DataFrame:
    """The first ``n`` carts of the priority order as one JSON array."""
    shown = scoring.priority_queue(scored).limit(n).select(
        "urgency_rank",
        F.col("user_session").alias("sessionId"),
        F.col("user_id").alias("userId"),
        F.col("total_cart_value").alias("totalVal"),
        F.col("num_cart_items").alias("numItems"),
        F.col("num_views_before_cart").alias("numViews"),
        F.col("hour_of_day").alias("hourOfDay"),
        F.col("p_abandonment").alias("pAbandon"),
        F.col("is_abandoned").alias("isAbandoned"),
        F.struct(
            "coupon_code", "coupon_label", "discount_pct", "free_shipping", "urgency_level", "rationale"
        ).alias("coupon"),
        F.col("estimated_recovered_gmv").alias("recoveredGMV"),
    )
    card = F.struct(*[c for c in shown.columns if c != "urgency_rank"])
    ordered = F.array_sort(
        F.collect_list(F.struct("urgency_rank", (-F.col("totalVal")).alias("v"), F.col("sessionId").alias("s"), card.alias("card")))
    )
    cards = F.transform(ordered, lambda row: row["card"])
    return shown.agg(F.to_json(cards).alias("body")).select(
        F.lit("abandonedCartsWithCoupons").alias("name"), "body"
    )


def model_metrics(comparison: DataFrame) -> DataFrame:
    """The chosen model's quality on carts it was not trained on."""
    best = comparison.where("is_best").limit(1).select(
        F.col("model").alias("bestModelName"),
        "accuracy",
        F.col("roc_auc").alias("rocAuc"),
        "precision",
        "recall",
        "f1",
        F.struct("tn", "fp", "fn", "tp").alias("confusionMatrix"),
    )
    return section("modelMetrics", best)


# Names of the journey's metrics in the document.
JOURNEY_NAMES = {
    "total_views_before_purchase": "viewsBeforePurchase",
    "prior_cart_sessions": "priorCartsBeforePurchase",
    "journey_duration_hours": "journeyDurationHours",
}


def purchase_journey(silver: DataFrame) -> DataFrame:
    """Mean and exact median of what buyers did before their first purchase: one row per metric."""
    stats = journey.journey_stats(journey.buyer_journey(silver))
    name = F.create_map(*[F.lit(x) for pair in JOURNEY_NAMES.items() for x in pair])[F.col("metric")]
    rows = stats.select(name.alias("name"), F.struct("buyers", "mean", F.col("p50").alias("median")).alias("figures"))
    return mapped("purchaseJourney", rows, "name", "figures")


def sections(silver: DataFrame, gold: DataFrame, comparison: DataFrame | None = None) -> DataFrame:
    """Rows (name, body), each body a JSON text of bounded size. ``gold`` is read
    once per section, so it should be a written table. ``comparison``: the models of a campaign,
    of which the best is reported."""
    scored = scoring.score(gold)
    totals = kpis.cart_kpis(gold).select(
        F.col("total_carts").alias("totalCarts"),
        F.col("abandoned_carts").alias("abandonedCarts"),
        F.col("abandonment_rate").alias("abandonmentRate"),
        F.col("total_gmv").alias("totalGMV"),
        F.col("gmv_lost").alias("gmvLost"),
        kpis.recovery_kpis(scored).select("gmv_recovered").scalar().alias("gmvRecovered"),
        kpis.recovery_kpis(scored).select("coupon_eligible").scalar().alias("couponEligibleCount"),
    )
    parts = [
        section("kpis", totals),
        section("funnel", kpis.funnel(silver)),
        section("buyerJourneyStats", kpis.prior_activity_stats(gold)),
        mapped("categories", kpis.top_abandoned_categories(gold), "main_category", "carts"),
        mapped("hourlyAbandonment", kpis.hourly_abandonment(gold), "hour_of_day", "abandonment_rate"),
        mapped("couponDistribution", kpis.coupon_distribution(scored), "coupon_label", "carts"),
        purchase_journey(silver),
        cart_cards(scored),
    ]
    if comparison is not None:
        parts.append(model_metrics(comparison))
    return reduce(lambda a, b: a.unionByName(b), parts)


def document(parts: DataFrame) -> DataFrame:
    """All sections as one JSON text, in the order of their names."""
    entries = F.sort_array(F.collect_list(F.struct("name", "body")))
    pairs = F.transform(entries, lambda e: F.concat(F.lit('"'), e["name"], F.lit('":'), e["body"]))
    return parts.agg(F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}")).alias("document"))


def dashboard_payload(x: Layers) -> DataFrame:
    return document(sections(stage(x.silver, "silver"), stage(x.gold, "gold")))


def figures(found: DataFrame) -> DataFrame:
    """The numbers of a document, read back from its text: (section, name, value)."""
    bodies = found.select(F.explode(F.from_json("document", "map<string,string>")).alias("section", "body"))
    cards = F.col("section") == "abandonedCartsWithCoupons"
    nested = F.col("section").isin("purchaseJourney")
    flat = bodies.where(~cards & ~nested).select(
        "section", F.explode(F.from_json("body", "map<string,double>")).alias("name", "value")
    )
    deep = bodies.where(nested).select(
        "section", F.explode(F.from_json("body", "map<string,map<string,double>>")).alias("outer", "inner")
    )
    deep = deep.select("section", "outer", F.explode("inner").alias("name", "value"))
    shown = F.from_json("body", "array<struct<sessionId:string,totalVal:double,recoveredGMV:double>>")
    cart = bodies.where(cards).select("section", F.posexplode(shown).alias("place", "card"))
    listed = cart.select(
        "section", F.concat(F.col("place") + 1, F.lit(" "), F.col("card.sessionId")).alias("name"),
        F.round("card.totalVal", 2).alias("value"),
    )
    named = deep.select("section", F.concat("outer", F.lit("."), "name").alias("name"), "value")
    return flat.unionByName(named).unionByName(listed)


def dashboard_figures(x: Layers) -> DataFrame:
    return figures(stage(dashboard_payload(x), "document"))
