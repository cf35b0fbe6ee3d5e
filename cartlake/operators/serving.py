"""Dimension, fact and serving tables."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartlake.functions import profiles, text
from cartlake.functions.events import (
    OTHER_CATEGORY,
    UNKNOWN_CATEGORY,
    event_order,
    leading_category,
)
from cartlake.functions.offers import NO_COUPON
from cartlake.schemas import NUMERIC_FEATURES, PRESCRIPTIONS, SESSION_FEATURES
from cartlake.session import stage

# What a prescription shows when its session row is missing.
MISSING_ITEMS = 1
MISSING_VIEWS = 3
NEW_STATUS = "🟢 NOVO (Streaming)"
OLD_STATUS = "✓ Processado"
HOUR = 3600


def conform(df: DataFrame, columns: dict[str, str], defaults: dict[str, object] | None = None) -> DataFrame:
    """Exactly these columns in this order and type; a missing one gets its
    default, 0 if none is named."""
    defaults = defaults or {}
    return df.select(
        *[
            (F.col(c) if c in df.columns else F.lit(defaults.get(c, 0))).cast(dtype).alias(c)
            for c, dtype in columns.items()
        ]
    )


# Feature table of the classifiers: numbers default to 0, the category to other.
MODEL_COLUMNS = {c: "double" for c in NUMERIC_FEATURES} | {"main_category": "string"}
MODEL_DEFAULTS = {"main_category": OTHER_CATEGORY}


def conform_features(carts: DataFrame, keep: list[str]) -> DataFrame:
    kept = {c: carts.schema[c].dataType.simpleString() for c in keep}
    return conform(carts, kept | MODEL_COLUMNS, MODEL_DEFAULTS)


def serving_session_features(gold: DataFrame) -> DataFrame:
    """Gold in the types of the serving table, one row per session."""
    return conform(
        gold.withColumnRenamed("user_session", "session_id"),
        SESSION_FEATURES,
        {"user_prior_abandon_rate": 0.5},
    )


def serving_prescriptions(scored: DataFrame) -> DataFrame:
    """Prescriptions with an id made from the session, so that a repeated load
    gives the same ids, and the time at which the one-hour trigger acts."""
    named = scored.withColumnRenamed("user_session", "session_id")
    ids = named.withColumns(
        {
            "prescription_id": F.md5("session_id"),
            "trigger_executed_sec": F.col("first_cart_sec") + HOUR,
            "estimated_recovered_gmv": F.col("recovered_money"),
        }
    )
    types = {"prescription_id": "string", "trigger_executed_sec": "bigint"} | PRESCRIPTIONS
    return conform(ids, types)


def latest_prescriptions(
    prescriptions: DataFrame, features: DataFrame, n: int = 50, last_batch: int = 10
) -> DataFrame:
    """The newest ``n`` prescriptions with their session's counts; the first
    ``last_batch`` of them are marked as new."""
    # n rows, a bound set by the caller; read twice, so staged.
    newest = stage(prescriptions.orderBy(F.desc("trigger_executed_sec"), "session_id").limit(n), "newest")
    keys = F.broadcast(newest.select("session_id"))
    counts = features.select("session_id", "num_cart_items", "num_views_before_cart").join(
        keys, "session_id", "left_semi"
    )
    order = Window.orderBy(F.desc("trigger_executed_sec"), "session_id")
    return (
        newest.join(counts, "session_id", "left")
        .withColumns(
            {
                "num_cart_items": F.coalesce("num_cart_items", F.lit(MISSING_ITEMS)),
                "num_views_before_cart": F.coalesce("num_views_before_cart", F.lit(MISSING_VIEWS)),
                "position": F.row_number().over(order),
            }
        )
        .withColumn("is_new", F.col("position") <= last_batch)
    )


def formatted_prescriptions(latest: DataFrame) -> DataFrame:
    """The listing as shown: texts of money, shares and times."""
    when = F.timestamp_seconds("trigger_executed_sec")
    return latest.select(
        "position",
        F.when(F.col("is_new"), NEW_STATUS).otherwise(OLD_STATUS).alias("status"),
        F.date_format(when, "HH:mm:ss").alias("executed_at"),
        text.shortened(F.col("session_id"), 12).alias("session"),
        "user_id",
        text.money(F.col("total_cart_value")).alias("cart_value"),
        F.col("num_cart_items").alias("items"),
        F.col("num_views_before_cart").alias("views"),
        text.percent(F.col("p_abandonment").cast("double")).alias("risk"),
        F.col("coupon_label").alias("coupon"),
        F.col("urgency_level").alias("urgency"),
        text.money(F.col("estimated_recovered_gmv")).alias("recovered"),
    )


def dim_users(silver: DataFrame, carts: DataFrame) -> DataFrame:
    """First contact, number of sessions and the profile of the latest cart; a
    buyer who never filled a cart is a browser."""
    # Per session first: counting distinct sessions becomes a sum, and one
    # buyer's events are merged in many tasks.
    sessions = silver.groupBy("user_id", "user_session").agg(
        F.min(F.unix_seconds("event_time_ts")).alias("first_sec")
    )
    users = sessions.groupBy("user_id").agg(
        F.min("first_sec").alias("first_interaction_sec"),
        F.count(F.lit(1)).alias("total_sessions"),
    )
    latest = (
        carts.withColumn("profile", profiles.rule_c())
        .groupBy("user_id")
        .agg(F.max_by("profile", F.struct("first_event_sec", "user_session")).alias("profile"))
    )
    return users.join(latest, "user_id", "left").select(
        "user_id",
        "first_interaction_sec",
        F.coalesce("profile", F.lit(profiles.BROWSER)).alias("user_intent_profile"),
        F.col("total_sessions").cast("int").alias("total_sessions"),
    )


def dim_products(silver: DataFrame) -> DataFrame:
    """The latest attributes of each product; of equal times and ids, the greatest.

    Events are first merged by hash per distinct set of attributes, with one number as
    buffer, so only those few rows are sorted by product."""
    attributes = ["category_id", "category_code", "brand", "price"]
    number = F.coalesce("event_id", F.lit(-(2**63)))
    last = silver.groupBy("product_id", *attributes).agg(
        F.max(event_order(F.unix_seconds("event_time_ts"), number)).alias("last")
    )
    newest = F.max_by(F.struct(*attributes), F.struct("last", *attributes))
    products = last.groupBy("product_id").agg(newest.alias("p")).select("product_id", "p.*")
    known = F.when(F.col("category_code") != UNKNOWN_CATEGORY, leading_category(F.col("category_code")))
    return products.select(
        "product_id",
        "category_id",
        "category_code",
        F.coalesce(known, F.lit(OTHER_CATEGORY)).alias("main_category"),
        "brand",
        F.col("price").cast("decimal(10,2)").alias("price"),
    )


def dim_categories(silver: DataFrame) -> DataFrame:
    return (
        silver.where(F.col("category_code") != UNKNOWN_CATEGORY)
        .groupBy("category_code")
        .agg(F.count(F.lit(1)).alias("events"))
        .withColumn("main_category", leading_category(F.col("category_code")))
    )


def dim_date(silver: DataFrame) -> DataFrame:
    """Every day between the first and the last event."""
    span = silver.agg(
        F.to_date(F.min("event_time_ts")).alias("a"), F.to_date(F.max("event_time_ts")).alias("b")
    )
    days = span.select(F.explode(F.sequence("a", "b")).alias("d"))
    return days.select(
        F.date_format("d", "yyyy-MM-dd").alias("day"),
        F.year("d").alias("year"),
        F.month("d").alias("month"),
        F.dayofmonth("d").alias("day_of_month"),
        F.weekday("d").alias("day_of_week"),
        F.when(F.weekday("d") >= 5, 1).otherwise(0).alias("is_weekend"),
    )


def abandoned_carts(carts: DataFrame) -> DataFrame:
    return carts.where(F.col("is_abandoned") == 1)


def coupon_eligible(scored: DataFrame) -> DataFrame:
    return scored.where(F.col("coupon_code") != NO_COUPON)


def recent_carts(scored: DataFrame, n: int = 60) -> DataFrame:
    """The newest ``n`` carts; those of the latest day are new."""
    newest = scored.orderBy(F.desc("last_cart_sec"), "user_session").limit(n)
    day = F.floor(F.col("last_cart_sec") / 86_400)
    # A window over n rows.
    return newest.withColumn("is_new", day == F.max(day).over(Window.partitionBy()))
