"""The way of each buyer to the first purchase."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartlake.functions.events import CART, PURCHASE, VIEW, event_order, hours_between
from cartlake.operators.running import exact_quantiles
from cartlake.operators.skew import ROWS_PER_TASK, spread_join
from cartlake.session import stage


def session_steps(silver: DataFrame) -> DataFrame:
    """Events summed per buyer, session and second, by hash."""
    sec = F.unix_seconds("event_time_ts")
    kind = F.col("event_type")
    return silver.groupBy("user_id", "user_session", sec.alias("sec")).agg(
        F.count_if(kind == VIEW).alias("views"),
        F.count_if(kind == CART).alias("carts"),
        F.min(F.when(kind == PURCHASE, event_order(sec, F.col("event_id")))).alias("purchase_order"),
    )


def first_purchases(steps: DataFrame) -> DataFrame:
    """Per session first, so that texts are compared on one row per buyer and session."""
    per_session = (
        steps.where("purchase_order is not null")
        .groupBy("user_id", "user_session")
        .agg(F.min("sec").alias("sec"), F.min("purchase_order").alias("purchase_order"))
    )
    return per_session.groupBy("user_id").agg(
        F.min("sec").alias("purchase_sec"),
        F.min_by("user_session", "purchase_order").alias("purchase_session"),
    )


def buyer_journey(silver: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """One row per buyer with a purchase. Only the first purchase counts, and
    only events strictly before it.

    The purchases take part as events, so that every buyer has a row to join and
    no second join has to bring back those without views or carts. Three branches
    read the summed steps, so they are staged.
    """
    steps = stage(session_steps(silver), "journey-steps")
    placed = spread_join(steps, first_purchases(steps), "user_id", F.struct("user_session", "sec"), rows_per_task)
    before = F.col("sec") < F.col("purchase_sec")
    other = F.col("user_session") != F.col("purchase_session")
    buyer = ["user_id", "purchase_sec", "purchase_session"]

    def total(condition: Column, column: str) -> Column:
        return F.sum(F.when(condition, F.col(column)).otherwise(0))

    # Per session first: distinct sessions become plain sums, and a buyer with
    # many events is counted in many tasks.
    per_session = placed.groupBy(*buyer, "user_session").agg(
        total(before & other, "views").alias("views"),
        total(before & other, "carts").alias("carts"),
        total(before & ~other, "views").alias("final_views"),
        F.min("sec").alias("first_sec"),
    )
    per_buyer = per_session.groupBy(*buyer).agg(
        F.count_if(F.col("carts") > 0).alias("prior_cart_sessions"),
        F.sum("carts").alias("prior_cart_items"),
        F.sum("views").alias("views_in_prior_sessions"),
        F.sum("final_views").alias("views_in_final_session"),
        F.count_if(F.col("carts") + F.col("views") > 0).alias("total_prior_sessions"),
        F.min("first_sec").alias("first_sec"),
    )
    hours = F.round(hours_between(F.col("purchase_sec"), F.col("first_sec")), 2)
    return per_buyer.select(
        "user_id",
        "purchase_session",
        "prior_cart_sessions",
        "prior_cart_items",
        "views_in_prior_sessions",
        "views_in_final_session",
        (F.col("views_in_prior_sessions") + F.col("views_in_final_session")).alias("total_views_before_purchase"),
        hours.alias("journey_duration_hours"),
        "total_prior_sessions",
    )


# Columns of the statistics, with the factor that makes them whole numbers.
JOURNEY_METRICS = {
    "total_views_before_purchase": 1,
    "prior_cart_sessions": 1,
    "journey_duration_hours": 100,
}
QUANTILES = {"p25": 0.25, "p50": 0.50, "p75": 0.75, "p90": 0.90}


def metric_rows(journey: DataFrame) -> DataFrame:
    """One row (metric, scale, v) per buyer and metric."""
    rows = [
        F.struct(F.lit(m).alias("metric"), F.lit(scale).alias("scale"), F.col(m).cast("double").alias("v"))
        for m, scale in JOURNEY_METRICS.items()
    ]
    return journey.select(F.explode(F.array(*rows)).alias("row")).select("row.*")


def journey_stats(journey: DataFrame) -> DataFrame:
    """Summary and exact quantiles of each metric. Two branches read the metric
    rows, so they are staged."""
    rows = stage(metric_rows(journey), "journey-metrics")
    summary = rows.groupBy("metric").agg(
        F.count("v").alias("buyers"),
        F.round(F.avg("v"), 4).alias("mean"),
        F.round(F.stddev_samp("v"), 4).alias("std"),
        F.round(F.min("v"), 4).alias("min"),
        F.round(F.max("v"), 4).alias("max"),
    )
    whole = F.round(F.col("v") * F.col("scale"))
    quantiles = exact_quantiles(rows, whole, list(QUANTILES.values()), ["metric", "scale"]).select(
        "metric",
        *[F.round(F.col(f"q{i}") / F.col("scale"), 4).alias(name) for i, name in enumerate(QUANTILES)],
    )
    return summary.join(quantiles, "metric")


def approximate_journey_stats(journey: DataFrame) -> DataFrame:
    """The quantiles from sketches, in one pass."""
    return (
        metric_rows(journey)
        .groupBy("metric")
        .agg(*[F.percentile_approx("v", share).alias(name) for name, share in QUANTILES.items()])
    )


def prior_cart_distribution(journey: DataFrame) -> DataFrame:
    """Share of buyers with 0, 1, 2, 3 or at least 4 earlier cart sessions."""
    bucket = F.least(F.col("prior_cart_sessions"), F.lit(4)).cast("int")
    counts = journey.groupBy(bucket.alias("prior_carts")).agg(F.count(F.lit(1)).alias("buyers"))
    # A window over the five buckets.
    total = F.sum("buyers").over(Window.partitionBy())
    return counts.withColumn("share_pct", F.round(F.col("buyers") * 100 / total, 1))


def direct_conversion(journey: DataFrame) -> DataFrame:
    direct = F.col("prior_cart_sessions") == 0
    return journey.agg(
        F.count(F.lit(1)).alias("buyers"),
        F.count_if(direct).alias("direct_buyers"),
        F.round(F.try_divide(F.count_if(direct), F.count(F.lit(1))), 4).alias("direct_share"),
    )
