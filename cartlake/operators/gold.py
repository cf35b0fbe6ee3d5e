"""Silver to gold: one row per cart session, with the buyer's history."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlake.functions.events import (
    CART,
    OTHER_CATEGORY,
    PURCHASE,
    UNKNOWN_BRAND,
    UNKNOWN_CATEGORY,
    VIEW,
    event_order,
    from_cents,
    hours_between,
    leading_category,
    night_flag,
    to_cents,
    weekend_flag,
)
from cartlake.operators.running import running_totals
from cartlake.schemas import GOLD_COLUMNS
from cartlake.session import stage

HOUR_SECONDS = 3_600
# Fixed value: abandon rate of a buyer without earlier carts.
NO_HISTORY_RATE = 0.5


def session_parts(silver: DataFrame) -> DataFrame:
    """Partial sums per (session, facet, value).

    A cart event counts once under its category and once under its brand, any
    other event under neither. Grouping by the value first turns the distinct
    counts and the most frequent category into plain sums over few rows, and
    spreads a session that holds a large share of the log over many tasks. All
    buffers are numbers, so Spark aggregates by hash.
    """
    is_cart = F.col("event_type") == CART
    events = silver.select(
        "user_session",
        "user_id",
        "event_type",
        F.unix_seconds("event_time_ts").alias("sec"),
        "event_id",
        to_cents(F.col("price")).alias("cents"),
        F.explode(
            F.when(
                is_cart,
                F.create_map(F.lit("category"), "category_code", F.lit("brand"), "brand"),
            ).otherwise(F.create_map(F.lit("none"), F.lit("")))
        ).alias("facet", "facet_value"),
    )
    once = F.col("facet") != "brand"
    in_cart = F.col("facet") == "category"
    return events.groupBy("user_session", "facet", "facet_value").agg(
        F.count_if(in_cart).alias("items"),
        F.sum(F.when(in_cart, F.col("cents"))).alias("cents"),
        F.max(F.when(in_cart, F.col("cents"))).alias("max_cents"),
        F.min(F.when(in_cart, F.col("cents"))).alias("min_cents"),
        F.count_if(once & (F.col("event_type") == VIEW)).alias("views"),
        F.count_if(once & (F.col("event_type") == PURCHASE)).alias("purchases"),
        F.min("sec").alias("first_sec"),
        F.min(F.when(in_cart, F.col("sec"))).alias("first_cart_sec"),
        F.max(F.when(in_cart, F.col("sec"))).alias("last_cart_sec"),
        F.min(event_order(F.col("sec"), F.col("event_id"))).alias("first_order"),
        F.min_by("user_id", event_order(F.col("sec"), F.col("event_id"))).alias("owner"),
    )


def merged_parts(parts: DataFrame) -> DataFrame:
    """Partial sums of several batches of events as those of all of them."""
    return parts.groupBy("user_session", "facet", "facet_value").agg(
        *[F.sum(c).alias(c) for c in ("items", "cents")],
        F.max("max_cents").alias("max_cents"),
        F.min("min_cents").alias("min_cents"),
        *[F.sum(c).alias(c) for c in ("views", "purchases")],
        F.min("first_sec").alias("first_sec"),
        F.min("first_cart_sec").alias("first_cart_sec"),
        F.max("last_cart_sec").alias("last_cart_sec"),
        F.min("first_order").alias("first_order"),
        F.min_by("owner", "first_order").alias("owner"),
    )


def session_totals(parts: DataFrame) -> DataFrame:
    """Sums per session; ``parts`` has one row per (session, facet, value)."""
    category = (F.col("facet") == "category") & (F.col("facet_value") != UNKNOWN_CATEGORY)
    brand = (F.col("facet") == "brand") & (F.col("facet_value") != UNKNOWN_BRAND)
    # Most frequent first, then alphabetical.
    rank = F.when(category, F.struct(-F.col("items"), F.col("facet_value").alias("name")))
    return parts.groupBy("user_session").agg(
        F.min_by("owner", "first_order").alias("user_id"),
        F.sum("items").alias("items"),
        F.sum("cents").alias("cents"),
        F.max("max_cents").alias("max_cents"),
        F.min("min_cents").alias("min_cents"),
        F.count_if(brand).alias("brands"),
        F.count_if(category).alias("categories"),
        F.min(rank)["name"].alias("top_category"),
        F.sum("views").alias("views"),
        F.sum("purchases").alias("purchases"),
        F.min("first_sec").alias("first_event_sec"),
        F.min("first_cart_sec").alias("first_cart_sec"),
        F.max("last_cart_sec").alias("last_cart_sec"),
    )


def session_base(silver: DataFrame, carts_only: bool = True) -> DataFrame:
    """Gold without history. ``carts_only=False`` keeps sessions without a cart,
    whose cart columns are null."""
    return base_of_parts(session_parts(silver), carts_only)


def base_of_parts(parts: DataFrame, carts_only: bool = True) -> DataFrame:
    totals = session_totals(parts)
    if carts_only:
        totals = totals.where(F.col("items") > 0)
    last_cart = F.timestamp_seconds("last_cart_sec")
    return totals.select(
        "user_session",
        "user_id",
        F.col("items").cast("int").alias("num_cart_items"),
        from_cents(F.col("cents")).alias("total_cart_value"),
        from_cents(F.col("max_cents")).alias("max_item_price"),
        from_cents(F.col("min_cents")).alias("min_item_price"),
        F.try_divide(F.col("cents").cast("double"), F.col("items") * 100.0).alias("avg_item_price"),
        F.col("brands").cast("int").alias("num_distinct_brands"),
        F.col("categories").cast("int").alias("num_distinct_categories"),
        F.coalesce(leading_category(F.col("top_category")), F.lit(OTHER_CATEGORY)).alias("main_category"),
        F.col("views").cast("int").alias("num_views_before_cart"),
        F.round(F.col("views") / F.greatest(F.col("items"), F.lit(1)), 2).alias("view_to_cart_ratio"),
        F.when(
            F.col("items") > 0,
            F.greatest(F.col("last_cart_sec") - F.col("first_event_sec"), F.lit(0)),
        ).alias("session_duration_sec"),
        F.hour(last_cart).alias("hour_of_day"),
        F.weekday(last_cart).alias("day_of_week"),
        weekend_flag(F.weekday(last_cart)).alias("is_weekend"),
        night_flag(F.hour(last_cart)).alias("is_night"),
        F.when(F.col("purchases") == 0, 1).otherwise(0).alias("is_abandoned"),
        "first_event_sec",
        "first_cart_sec",
        "last_cart_sec",
    )


def with_history(base: DataFrame) -> DataFrame:
    """Add what the buyer did in earlier cart sessions, never in this one.

    ``base`` is read twice, once for the rows and once for the totals per buyer
    and hour, so it is staged. Hours keep a buyer with a third of all carts from
    being sorted in one task.
    """
    carts = stage(base, "session-base").withColumns(
        {
            "_cart": F.lit(1).cast("long"),
            "_views": F.col("num_views_before_cart").cast("long"),
            "_abandoned": F.col("is_abandoned").cast("long"),
        }
    )
    counted = running_totals(
        carts,
        ["user_id"],
        F.floor(F.col("first_event_sec") / HOUR_SECONDS),
        ["first_event_sec", "user_session"],
        sums={
            "user_prior_carts": "_cart",
            "user_prior_views": "_views",
            "user_prior_abandoned_carts": "_abandoned",
        },
        firsts={"first_seen_sec": "first_event_sec"},
    )
    prior_carts = F.col("user_prior_carts")
    return counted.withColumns(
        {
            "user_total_cumulative_views": F.col("user_prior_views") + F.col("_views"),
            "user_lifetime_hours": hours_between(F.col("first_event_sec"), F.col("first_seen_sec")),
            "user_prior_abandon_rate": F.when(
                prior_carts > 0, F.col("user_prior_abandoned_carts") / prior_carts
            ).otherwise(F.lit(NO_HISTORY_RATE)),
        }
    ).drop("_cart", "_views", "_abandoned", "first_seen_sec")


def gold_carts(silver: DataFrame) -> DataFrame:
    """Gold in table order; the epoch seconds of the session follow at the end."""
    gold = with_history(session_base(silver))
    return gold.select(*GOLD_COLUMNS, "first_event_sec", "first_cart_sec", "last_cart_sec")


def cart_session_events(silver: DataFrame) -> DataFrame:
    """All events of sessions with a cart. Gold does not need this join: it drops
    other sessions after its aggregation."""
    cart_sessions = silver.where(F.col("event_type") == CART).select("user_session").distinct()
    return silver.join(cart_sessions, "user_session", "left_semi")
