"""Distinct counts and quantiles that add up over days.

A day's sketches are a few kilobytes whatever its events. Kept in a table, they give the uniques
and price quantiles of any stretch of days without reading events again, and a new day only adds
its own row. Distinct counts are HyperLogLog, quantiles KLL; both merge in any order.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlake.functions.events import CART, from_cents, to_cents

#: 2^LOG_K registers: a relative standard error of about 0.8 / sqrt(2^LOG_K), 1.3 %.
LOG_K = 12
#: Items a KLL sketch keeps per level: ranks are off by 1.7 % at most (99 % sure).
KLL_K = 200
#: What results are held to: over three standard errors of a count, and twice a rank's.
COUNT_ERROR, RANK_ERROR = 0.05, 0.035


def day_of(when: Column) -> Column:
    return F.to_date(when)


def daily_sketches(silver: DataFrame) -> DataFrame:
    """One row per day: events, sketches of buyers and sessions, and of the prices put in carts.

    Sketches are filled before the shuffle, so a day costs one row per task."""
    cents = F.when(F.col("event_type") == CART, to_cents(F.col("price")))
    return silver.groupBy(day_of(F.col("event_time_ts")).alias("day")).agg(
        F.count(F.lit(1)).alias("events"),
        F.hll_sketch_agg("user_id", F.lit(LOG_K)).alias("buyers"),
        F.hll_sketch_agg("user_session", F.lit(LOG_K)).alias("sessions"),
        F.kll_sketch_agg_bigint(cents, F.lit(KLL_K)).alias("prices"),
    )


def merged(days: DataFrame, by: list[str]) -> DataFrame:
    """The sketches of groups of days, as sketches again."""
    return days.groupBy(*by).agg(
        F.sum("events").alias("events"),
        F.hll_union_agg("buyers").alias("buyers"),
        F.hll_union_agg("sessions").alias("sessions"),
        F.kll_merge_agg_bigint("prices").alias("prices"),
    )


def trailing(days: DataFrame, width: int) -> DataFrame:
    """For each day that has events, the sketches of the ``width`` days that end with it: every
    day's row is repeated ``width`` times, not its events."""
    ends = F.sequence("day", F.date_add("day", width - 1))
    spread = days.withColumn("until", F.explode(ends)).drop("day")
    known = days.select(F.col("day").alias("until"))
    return merged(spread.join(known, "until", "left_semi"), ["until"]).withColumnRenamed("until", "day")


def estimates(sketches: DataFrame) -> DataFrame:
    """The numbers in the place of their sketches; no prices, no median."""
    n = F.kll_sketch_get_n_bigint("prices")
    median = F.when(n > 0, F.kll_sketch_get_quantile_bigint("prices", F.lit(0.5)))
    return sketches.withColumns(
        {
            "buyers": F.hll_sketch_estimate("buyers"),
            "sessions": F.hll_sketch_estimate("sessions"),
            "median_price": from_cents(median),
        }
    ).drop("prices")


def checked(silver: DataFrame, width: int = 7) -> DataFrame:
    """Per trailing window the exact counts, and whether the estimates keep their error bounds.

    The exact side reads events ``width`` times over; it is there to judge the sketches."""
    found = estimates(trailing(daily_sketches(silver), width)).select(
        "day", F.col("buyers").alias("buyers_said"), F.col("sessions").alias("sessions_said"), "median_price"
    )
    ends = F.sequence(day_of(F.col("event_time_ts")), F.date_add(day_of(F.col("event_time_ts")), width - 1))
    events = silver.select("user_id", "user_session", "event_type", "price", F.explode(ends).alias("day"))
    met = events.join(F.broadcast(found.select("day", "median_price")), "day")
    cart = F.col("event_type") == CART
    exact = met.groupBy("day").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_distinct("user_id").alias("buyers"),
        F.count_distinct("user_session").alias("sessions"),
        F.count_if(cart).alias("carts"),
        F.count_if(cart & (to_cents(F.col("price")) < F.round(F.col("median_price") * 100))).alias("below"),
        F.count_if(cart & (to_cents(F.col("price")) <= F.round(F.col("median_price") * 100))).alias("up_to"),
    )

    def near(said: str, true: str) -> Column:
        return F.abs(F.col(said) - F.col(true)) <= F.col(true) * COUNT_ERROR

    low, high = (0.5 - RANK_ERROR) * F.col("carts") - 1, (0.5 + RANK_ERROR) * F.col("carts") + 1
    return exact.join(found, "day").select(
        F.date_format("day", "yyyy-MM-dd").alias("day"), "events", "buyers", "sessions",
        near("buyers_said", "buyers").alias("buyers_near"),
        near("sessions_said", "sessions").alias("sessions_near"),
        F.coalesce((F.col("below") <= high) & (F.col("up_to") >= low), F.lit(True)).alias("median_near"),
    )
