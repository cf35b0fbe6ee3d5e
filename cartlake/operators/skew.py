"""Joins that stay balanced when one key holds a large share of the rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def salted_join(
    large: DataFrame,
    small: DataFrame,
    on: str,
    spread_by: Column,
    salts: int = 16,
    how: str = "inner",
) -> DataFrame:
    """Join many rows per key with one row per key, over ``salts`` tasks per key.

    ``small`` has one row per key and is repeated ``salts`` times, so it must be
    narrow. Splitting skewed partitions at run time does not help where a
    grouping on the same key follows: it would need another shuffle.
    """
    left = large.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)))
    right = small.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))
    )
    return left.join(right, [on, "_salt"], how).drop("_salt")


# Rows of one key that one task takes before the key is split.
ROWS_PER_TASK = 1_000_000


def spread_join(
    large: DataFrame, small: DataFrame, on: str, spread_by: Column, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """As ``salted_join``, with as many salts per key as its rows ask for, so only keys of
    more than ``rows_per_task`` rows are split and repeated.

    Those keys are fewer than rows / ``rows_per_task``, which bounds both what is broadcast
    (a key and a number each) and what is repeated. ``large`` is read twice, so it should be
    a staged table.
    """
    hot = large.groupBy(on).agg(F.ceil(F.count(F.lit(1)) / F.lit(rows_per_task)).cast("long").alias("_salts"))
    hot = F.broadcast(hot.where(F.col("_salts") > 1))
    salts = F.coalesce(F.col("_salts"), F.lit(1).cast("long"))
    left = large.join(hot, on, "left").withColumn("_salt", F.pmod(F.xxhash64(spread_by), salts)).drop("_salts")
    every = F.explode(F.sequence(F.lit(0).cast("long"), salts - 1))
    right = small.join(hot, on, "left").withColumn("_salt", every).drop("_salts")
    return left.join(right, [on, "_salt"]).drop("_salt")
