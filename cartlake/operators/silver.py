"""Bronze to silver: trusted events."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlake.functions.events import (
    EVENT_TYPES,
    UNKNOWN_BRAND,
    UNKNOWN_CATEGORY,
    clean_time_text,
    night_flag,
    parse_time,
)
from cartlake.schemas import BRONZE, SILVER_COLUMNS

ACCEPTED = "accepted"


def with_event_id(bronze: DataFrame) -> DataFrame:
    """An id to break ties of equal seconds; from the content where none is given,
    so that it does not depend on file or partition order."""
    if "event_id" in bronze.columns:
        return bronze
    return bronze.withColumn("event_id", F.xxhash64(*BRONZE.names))


def normalized(bronze: DataFrame) -> DataFrame:
    return bronze.withColumn("event_type", F.lower(F.trim("event_type")))


def deduplicated(bronze: DataFrame) -> DataFrame:
    """Exact duplicates by event content; the lowest id of a group stays."""
    content = BRONZE.names
    if "event_id" not in bronze.columns:
        return bronze.dropDuplicates(content)
    unique = bronze.groupBy(*content).agg(F.min("event_id").alias("event_id"))
    return unique.select(*bronze.columns)


def rejection_reason() -> Column:
    """The first rule an event breaks; a null comparison counts as broken."""
    keys = [F.col(c).isNull() for c in ("product_id", "user_id", "user_session")]
    return (
        F.when(parse_time(F.col("event_time")).isNull(), "bad_time")
        .when(keys[0] | keys[1] | keys[2], "missing_key")
        .when(~F.coalesce((F.col("price") > 0) & (F.col("price") < float("inf")), F.lit(False)), "bad_price")
        .when(F.coalesce(~F.col("event_type").isin(*EVENT_TYPES), F.lit(True)), "bad_type")
        .otherwise(ACCEPTED)
    )


def silver_events(bronze: DataFrame, normalize: bool = False, dedup: bool = False) -> DataFrame:
    events = normalized(bronze) if normalize else bronze
    events = deduplicated(events) if dedup else events
    trusted = with_event_id(events).where(
        parse_time(F.col("event_time")).isNotNull()
        & F.col("product_id").isNotNull()
        & F.col("user_id").isNotNull()
        & F.col("user_session").isNotNull()
        & (F.col("price") > 0)
        & (F.col("price") < float("inf"))
        & F.col("event_type").isin(*EVENT_TYPES)
    )
    timed = trusted.withColumns(
        {
            "event_time_clean": clean_time_text(F.col("event_time")),
            "event_time_ts": parse_time(F.col("event_time")),
            "category_code": F.coalesce("category_code", F.lit(UNKNOWN_CATEGORY)),
            "brand": F.coalesce("brand", F.lit(UNKNOWN_BRAND)),
        }
    )
    return (
        timed.withColumn("hour_of_day", F.hour("event_time_ts"))
        .withColumn("is_night", night_flag(F.col("hour_of_day")))
        .select(*SILVER_COLUMNS)
    )


def quality_report(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy(rejection_reason().alias("outcome")).agg(
        F.count(F.lit(1)).alias("events")
    )


def with_month(silver: DataFrame) -> DataFrame:
    """The partition columns of the lake layout year=/month=."""
    return silver.withColumns(
        {"year": F.year("event_time_ts"), "month": F.month("event_time_ts")}
    )


def fact_events(silver: DataFrame) -> DataFrame:
    return silver.select(
        "event_id",
        F.col("event_time_ts").alias("event_time"),
        "event_type",
        "product_id",
        "user_id",
        "user_session",
        F.col("price").cast("decimal(10,2)").alias("price"),
        "hour_of_day",
        "is_night",
    )
