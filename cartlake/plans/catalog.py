"""Every registered query: name -> function of (session, data folder)."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlake.functions import offers, profiles, risk
from cartlake.operators import (
    explore,
    gold,
    journey,
    kpis,
    learning,
    metrics,
    scoring,
    serving,
    silver,
    sketches,
    triggers,
)
from cartlake.plans import learned, live
from cartlake.plans.dashboard import dashboard_figures, dashboard_payload
from cartlake.plans.layers import Layers
from cartlake.schemas import GOLD_COLUMNS, TRAINING_COLUMNS
from cartlake.session import new_path, stage
from cartlake.sources.files import sample_files
from cartlake.sources.sinks import write_layer

# Users named by the user filters of the queries; they occur at every scale.
ONE_USER = 7
TWO_USERS = [3, 7]

SILVER_OUTPUT = [
    "event_id",
    "event_time",
    "event_type",
    "product_id",
    "category_id",
    "category_code",
    "brand",
    "price",
    "user_id",
    "user_session",
    "hour_of_day",
    "is_night",
]
CART_KEYS = ["user_session", "user_id", "total_cart_value", "num_views_before_cart", "hour_of_day", "is_night"]
OFFER_COLUMNS = [
    "p_abandonment",
    "coupon_code",
    "coupon_label",
    "discount_pct",
    "free_shipping",
    "urgency_level",
    "rationale",
]
MATRIX_COLUMNS = [
    "user_session",
    "user_id",
    "total_cart_value",
    "is_abandoned",
    "p_abandonment",
    "coupon_code",
    "coupon_label",
    "urgency_level",
]
BASE_COLUMNS = [c for c in GOLD_COLUMNS if not c.startswith("user_") or c in ("user_session", "user_id")]
CONFORM_KEEP = ["user_session", "user_id"]

Q: dict[str, Callable[[Layers], DataFrame]] = {}


def query(build: Callable[[Layers], DataFrame]) -> Callable[[Layers], DataFrame]:
    Q[build.__name__] = build
    return build


# --- layers -----------------------------------------------------------------


@query
def bronze_events(x: Layers) -> DataFrame:
    return x.bronze


@query
def silver_events(x: Layers) -> DataFrame:
    return x.silver.select(*SILVER_OUTPUT, "event_time_clean", F.unix_seconds("event_time_ts").alias("event_time_sec"))


@query
def silver_quality_report(x: Layers) -> DataFrame:
    return silver.quality_report(x.bronze)


@query
def silver_dedup(x: Layers) -> DataFrame:
    """Each event arrives twice, once with an untidy type and a later id."""
    again = x.bronze.withColumns(
        {"event_id": F.col("event_id") + 1_000_000_000_000, "event_type": F.concat(F.lit(" "), F.upper("event_type"))}
    )
    cleaned = silver.silver_events(x.bronze.unionByName(again), normalize=True, dedup=True)
    return cleaned.select(*SILVER_OUTPUT)


@query
def sampled_load(x: Layers) -> DataFrame:
    parts = [x.bronze.where(F.col("event_id") % 3 == part) for part in range(3)]
    return sample_files(parts, ["event_time", "event_id"], 300)


@query
def partitioned_silver(x: Layers) -> DataFrame:
    """Written in the lake layout year=/month= and read back by partition."""
    path = new_path(x.spark, "silver-months")
    write_layer(silver.with_month(x.silver), path, ["year", "month"])
    return x.spark.read.parquet(path).groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("events"), kpis.money_sum("price").alias("amount")
    )


@query
def fact_events(x: Layers) -> DataFrame:
    facts = silver.fact_events(x.silver)
    return facts.withColumns(
        {"event_time": F.date_format("event_time", "yyyy-MM-dd HH:mm:ss"), "price": F.col("price").cast("double")}
    )


@query
def user_events(x: Layers) -> DataFrame:
    return explore.of_user(x.bronze, ONE_USER)


@query
def events_excluding_users(x: Layers) -> DataFrame:
    return explore.without_users(x.silver, TWO_USERS).select(*SILVER_OUTPUT)


@query
def cart_session_events(x: Layers) -> DataFrame:
    return gold.cart_session_events(x.silver).select(*SILVER_OUTPUT)


@query
def gold_cart_base(x: Layers) -> DataFrame:
    return x.base.select(*BASE_COLUMNS)


@query
def main_category(x: Layers) -> DataFrame:
    return x.base.select("user_session", "main_category")


@query
def gold_cart(x: Layers) -> DataFrame:
    return x.gold.select(*GOLD_COLUMNS)


@query
def load_stats(x: Layers) -> DataFrame:
    return kpis.load_stats(x.events, x.base)


# --- exploring the layers ---------------------------------------------------


@query
def layer_sample_bronze(x: Layers) -> DataFrame:
    return explore.sample(x.bronze, "event_time", "event_id")


@query
def layer_sample_silver(x: Layers) -> DataFrame:
    columns = [c for c in SILVER_OUTPUT if c not in ("category_id", "is_night")]
    return explore.sample(x.silver.select(*columns), "event_time", "event_id")


@query
def layer_sample_gold(x: Layers) -> DataFrame:
    return explore.sample(x.gold, "first_event_sec", "user_session").select(*GOLD_COLUMNS)


@query
def layer_filter(x: Layers) -> DataFrame:
    return explore.filter_events(x.silver, "cart").select(*SILVER_OUTPUT)


@query
def layer_search(x: Layers) -> DataFrame:
    return explore.search(x.silver.select(*SILVER_OUTPUT), " Economy.GEAR ")


@query
def layer_sort_page(x: Layers) -> DataFrame:
    """Page 3 of the carts by category, and a page far past the end."""
    listing = explore.filter_carts(x.base.select(*BASE_COLUMNS), "1")
    third = explore.page(listing, "main_category", "user_session", 3, descending=True)
    last = explore.page(listing, "total_cart_value", "user_session", 10**9, size=25)
    return third.unionByName(last)


@query
def matrix_filter(x: Layers) -> DataFrame:
    kept = explore.filter_matrix(x.logistic, status="ABANDONED", urgency="Crítica", term="frete")
    return kept.select(*MATRIX_COLUMNS)


@query
def priority_pinned_carts(x: Layers) -> DataFrame:
    pinned = explore.pin_users(x.logistic, TWO_USERS, "first_event_sec", "user_session")
    return pinned.select("priority", *MATRIX_COLUMNS)


@query
def user_360(x: Layers) -> DataFrame:
    """One buyer's carts, from the raw events to the offer."""
    events = silver.silver_events(explore.of_user(x.bronze, ONE_USER))
    scored = scoring.score(gold.gold_carts(events))
    return scored.select(*GOLD_COLUMNS, *OFFER_COLUMNS, F.col("recovered_money").cast("double").alias("recovered_gmv"))


# --- defaults ---------------------------------------------------------------


@query
def conform_features(x: Layers) -> DataFrame:
    return serving.conform_features(x.base, CONFORM_KEEP)


@query
def fill_defaults(x: Layers) -> DataFrame:
    """All sessions: those without a cart have no cart values to start from."""
    sessions = gold.session_base(x.silver, carts_only=False).select(*BASE_COLUMNS)
    return scoring.fill_defaults(sessions, scoring.MATRIX_DEFAULTS)


# --- counts and rates -------------------------------------------------------


@query
def cart_kpis(x: Layers) -> DataFrame:
    return kpis.cart_kpis(x.base)


@query
def recovery_kpis(x: Layers) -> DataFrame:
    return kpis.recovery_kpis(x.logistic)


@query
def gmv_at_risk(x: Layers) -> DataFrame:
    return kpis.gmv_at_risk(x.logistic)


@query
def funnel(x: Layers) -> DataFrame:
    return kpis.funnel(x.silver)


@query
def funnel_from_gold(x: Layers) -> DataFrame:
    return kpis.funnel_from_gold(x.base)


@query
def funnel_metrics_daily(x: Layers) -> DataFrame:
    return kpis.funnel_by_day(x.silver)


@query
def hourly_abandonment(x: Layers) -> DataFrame:
    return kpis.hourly_abandonment(x.base)


@query
def top_abandoned_categories(x: Layers) -> DataFrame:
    return kpis.top_abandoned_categories(x.base)


@query
def conversion_by_category(x: Layers) -> DataFrame:
    return kpis.conversion_by_category(x.base)


@query
def conversion_by_brand(x: Layers) -> DataFrame:
    return kpis.conversion_by_brand(x.silver)


@query
def price_band_abandonment(x: Layers) -> DataFrame:
    return kpis.price_band_abandonment(x.base)


@query
def abandonment_by_prior_carts(x: Layers) -> DataFrame:
    return kpis.abandonment_by_prior_carts(x.gold)


@query
def prior_activity_stats(x: Layers) -> DataFrame:
    return kpis.prior_activity_stats(x.gold)


@query
def uniques(x: Layers) -> DataFrame:
    return kpis.uniques(x.silver)


@query
def sketched_uniques(x: Layers) -> DataFrame:
    """Seven-day windows from daily sketches, held to their error bounds."""
    return sketches.checked(stage(x.silver, "silver"))


@query
def kpi_increment(x: Layers) -> DataFrame:
    return kpis.kpi_increment(x.logistic)


@query
def running_mean(x: Layers) -> DataFrame:
    return kpis.running_mean(x.logistic)


# --- journey ----------------------------------------------------------------


@query
def buyer_journey(x: Layers) -> DataFrame:
    return journey.buyer_journey(x.silver)


@query
def journey_stats(x: Layers) -> DataFrame:
    return journey.journey_stats(journey.buyer_journey(x.silver))


@query
def prior_cart_distribution(x: Layers) -> DataFrame:
    return journey.prior_cart_distribution(journey.buyer_journey(x.silver))


@query
def direct_conversion(x: Layers) -> DataFrame:
    return journey.direct_conversion(journey.buyer_journey(x.silver))


# --- rules ------------------------------------------------------------------


@query
def heuristic_risk(x: Layers) -> DataFrame:
    return scoring.with_heuristic_risk(x.base).select(*CART_KEYS, "p_abandonment")


@query
def logistic_risk(x: Layers) -> DataFrame:
    scored = scoring.with_logistic_risk(x.base)
    return scored.select(*CART_KEYS, "session_duration_sec", "user_profile", "p_abandonment")


@query
def stream_risk(x: Layers) -> DataFrame:
    p = risk.stream_risk()
    return x.base.select(*CART_KEYS, p.alias("p_abandonment"), risk.predicted_abandoned(p).alias("predicted_abandoned"))


@query
def risk_bands(x: Layers) -> DataFrame:
    scored = scoring.with_logistic_risk(x.base)
    return scored.select("user_session", "p_abandonment", risk.risk_band(F.col("p_abandonment")).alias("risk_band"))


@query
def profile_rule_a(x: Layers) -> DataFrame:
    return x.base.select(*CART_KEYS, profiles.rule_a().alias("user_profile"))


@query
def profile_rule_b(x: Layers) -> DataFrame:
    return x.base.select(*CART_KEYS, profiles.rule_b().alias("user_profile"))


@query
def profile_rule_c(x: Layers) -> DataFrame:
    return x.base.select(*CART_KEYS, "session_duration_sec", profiles.rule_c().alias("user_profile"))


@query
def coupon_matrix(x: Layers) -> DataFrame:
    return x.logistic.select(*CART_KEYS, *OFFER_COLUMNS)


@query
def profile_prescription(x: Layers) -> DataFrame:
    offered = scoring.with_prescription(x.base, profiles.rule_c())
    return offered.select(
        *CART_KEYS, "user_profile", "profile_name_pt", *[c for c in OFFER_COLUMNS if c != "p_abandonment"]
    )


@query
def recovered_gmv(x: Layers) -> DataFrame:
    return x.logistic.select(
        "user_session", "total_cart_value", "coupon_code", "discount_pct", "estimated_recovered_gmv"
    )


@query
def stream_recovered_gmv(x: Layers) -> DataFrame:
    p = risk.stream_risk()
    recovered = offers.stream_recovered_gmv(p, F.col("total_cart_value"))
    return x.base.select("user_session", "total_cart_value", p.alias("p_abandonment"), recovered.alias("recovered_gmv"))


@query
def scored_carts(x: Layers) -> DataFrame:
    scored = scoring.score(x.gold)
    return scored.select(*GOLD_COLUMNS, *OFFER_COLUMNS, "estimated_recovered_gmv", "discount_value")


@query
def validated_matrix(x: Layers) -> DataFrame:
    return scoring.validated_matrix(gold.session_base(x.silver, carts_only=False))


@query
def abandoned_carts(x: Layers) -> DataFrame:
    return serving.abandoned_carts(x.base).select(*BASE_COLUMNS)


@query
def coupon_eligible(x: Layers) -> DataFrame:
    return serving.coupon_eligible(x.logistic).select(*MATRIX_COLUMNS)


@query
def coupon_distribution(x: Layers) -> DataFrame:
    return kpis.coupon_distribution(x.logistic)


@query
def priority_queue(x: Layers) -> DataFrame:
    return scoring.priority_queue(x.logistic).select("urgency_rank", *MATRIX_COLUMNS)


# --- serving ----------------------------------------------------------------


def money_as_double(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal" else F.col(f.name)
            for f in df.schema.fields
        ]
    )


@query
def dim_users(x: Layers) -> DataFrame:
    return serving.dim_users(x.silver, x.base)


@query
def dim_products(x: Layers) -> DataFrame:
    return money_as_double(serving.dim_products(x.silver))


@query
def dim_categories(x: Layers) -> DataFrame:
    return serving.dim_categories(x.silver)


@query
def dim_date(x: Layers) -> DataFrame:
    return serving.dim_date(x.silver)


@query
def serving_session_features(x: Layers) -> DataFrame:
    return money_as_double(serving.serving_session_features(x.gold))


@query
def serving_prescriptions(x: Layers) -> DataFrame:
    return money_as_double(serving.serving_prescriptions(x.logistic))


def latest(x: Layers) -> DataFrame:
    """The scored carts hold the counts as well; staged, so the events are read once."""
    scored = stage(x.logistic, "scored")
    features = scored.withColumnRenamed("user_session", "session_id")
    return serving.latest_prescriptions(serving.serving_prescriptions(scored), features)


@query
def latest_prescriptions(x: Layers) -> DataFrame:
    return money_as_double(latest(x))


@query
def formatted_prescriptions(x: Layers) -> DataFrame:
    return serving.formatted_prescriptions(latest(x))


@query
def recent_carts(x: Layers) -> DataFrame:
    return serving.recent_carts(x.logistic).select(*MATRIX_COLUMNS, "last_cart_sec", "is_new")


# --- triggers ---------------------------------------------------------------


@query
def trigger_5min(x: Layers) -> DataFrame:
    return triggers.trigger_5min(stage(x.silver, "silver"))


@query
def trigger_1hour(x: Layers) -> DataFrame:
    return triggers.trigger_1hour(stage(x.silver, "silver"))


@query
def trigger_chain(x: Layers) -> DataFrame:
    return triggers.trigger_chain(stage(x.silver, "silver"))


@query
def decision_features(x: Layers) -> DataFrame:
    return triggers.decision_features(stage(x.silver, "silver"))


# --- learning ---------------------------------------------------------------


@query
def profile_training_set(x: Layers) -> DataFrame:
    return learning.training_table(x.gold).select(*TRAINING_COLUMNS)


@query
def feature_frame(x: Layers) -> DataFrame:
    return learning.feature_frame(x.gold, keep=["user_session", "is_abandoned"])


@query
def scaled_features(x: Layers) -> DataFrame:
    """Means first, then rows: the frame is read twice, so it is staged."""
    frame = learning.feature_frame(x.gold, keep=["user_session"]).drop("main_category")
    return learning.scaled(stage(frame, "features"), digits=4)


@query
def one_hot_category(x: Layers) -> DataFrame:
    """The names are those of the training rows; base is read twice, so it is staged."""
    carts = stage(x.base.select("user_session", "is_abandoned", "main_category"), "base")
    known = learning.known_categories(learning.with_split(carts).filter("split = 'train'"), "main_category")
    return learning.one_hot(carts, "main_category", known, keep=["user_session"])


@query
def stratified_split(x: Layers) -> DataFrame:
    return learning.with_split(x.base).select("user_session", "is_abandoned", "split")


@query
def split_shares(x: Layers) -> DataFrame:
    return learning.split_shares(learning.with_split(x.base))


@query
def exact_stratified_split(x: Layers) -> DataFrame:
    return learning.with_split(x.base, exact=True).select("user_session", "is_abandoned", "split")


def judged(x: Layers) -> DataFrame:
    scored = scoring.with_logistic_risk(x.base)
    p = F.col("p_abandonment")
    return scored.select(
        F.col("is_abandoned").alias("label"), p.alias("score"), risk.predicted_abandoned(p).alias("prediction")
    )


@query
def confusion_matrix(x: Layers) -> DataFrame:
    return metrics.confusion_matrix(judged(x))


@query
def classification_metrics(x: Layers) -> DataFrame:
    return metrics.classification_metrics(metrics.confusion_matrix(judged(x)))


@query
def roc_auc(x: Layers) -> DataFrame:
    return metrics.roc_auc(judged(x))


@query
def roc_curve(x: Layers) -> DataFrame:
    return metrics.roc_curve(judged(x))


for build in (
    learned.model_comparison,
    learned.feature_set_gain,
    learned.feature_importance,
    learned.profile_report,
    learned.model_scored_carts,
    dashboard_payload,
    dashboard_figures,
    learned.forest_decisions,
    live.stream_trigger_chain,
    live.stream_gold,
    live.stream_funnel_daily,
    live.stream_kpis,
):
    query(build)


def run(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: Q[name](Layers(spark, sf_dir))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: run(name) for name in Q}
