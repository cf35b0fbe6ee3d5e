"""The given tables as a bronze event log."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlake.functions.events import CART, TIME_PATTERN
from cartlake.session import use_utc
from cartlake.sources.sessions import sessionize

SESSION_GAP_HOURS = 12

SCHEMAS = {
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
        "value double, props string"
    ),
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` joined to ``part``: clicks become cart events, products give
    category and brand, some of which are left empty, and a pause of more than
    twelve hours starts a new session. Other event types stay for the silver
    rules to reject."""
    events = sessionize(table(spark, sf_dir, "events"), "user_id", "ts", SESSION_GAP_HOURS)
    part = table(spark, sf_dir, "part")
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("long")
    joined = events.withColumn("k", k).join(part, F.col("k") == F.col("p_partkey"), "left")
    noun = F.split_part("p_name", F.lit(" "), F.lit(2))
    return joined.select(
        "event_id",
        F.concat(F.date_format("ts", TIME_PATTERN), F.lit(" UTC")).alias("event_time"),
        F.when(F.col("event_type") == "click", CART).otherwise(F.col("event_type")).alias("event_type"),
        F.col("k").alias("product_id"),
        F.col("p_size").cast("long").alias("category_id"),
        F.when(F.col("k") % 7 != 0, F.concat(F.lower("p_type"), F.lit("."), noun)).alias("category_code"),
        F.when(F.col("k") % 11 != 0, F.lower("p_brand")).alias("brand"),
        F.round(F.col("value") * 10, 2).alias("price"),
        "user_id",
        F.concat(
            F.col("user_id").cast("string"), F.lit("-"), F.col("session_no").cast("string")
        ).alias("user_session"),
    )
