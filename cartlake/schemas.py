"""Fixed table schemas. Nothing in the library infers a schema from data."""

from pyspark.sql import types as T

# Bronze: the event log as it arrives (CSV with header, JSON lines or a topic).
BRONZE = T.StructType(
    [
        T.StructField("event_time", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("category_id", T.LongType()),
        T.StructField("category_code", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("user_session", T.StringType()),
    ]
)

# A log whose producer already numbers its events.
BRONZE_WITH_ID = T.StructType([T.StructField("event_id", T.LongType())] + BRONZE.fields)

SILVER_COLUMNS = [
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
    "event_time_clean",
    "event_time_ts",
    "hour_of_day",
    "is_night",
]

# Gold: one row per cart session.
GOLD_COLUMNS = [
    "user_session",
    "user_id",
    "num_cart_items",
    "total_cart_value",
    "max_item_price",
    "min_item_price",
    "avg_item_price",
    "num_distinct_brands",
    "num_distinct_categories",
    "main_category",
    "num_views_before_cart",
    "view_to_cart_ratio",
    "session_duration_sec",
    "hour_of_day",
    "day_of_week",
    "is_weekend",
    "is_night",
    "user_prior_views",
    "user_prior_carts",
    "user_prior_abandoned_carts",
    "user_total_cumulative_views",
    "user_lifetime_hours",
    "user_prior_abandon_rate",
    "is_abandoned",
]

# Serving tables: column -> SQL type, in table order.
SESSION_FEATURES = {
    "session_id": "string",
    "user_id": "bigint",
    "total_cart_value": "decimal(12,2)",
    "num_cart_items": "int",
    "num_views_before_cart": "int",
    "view_to_cart_ratio": "decimal(8,2)",
    "session_duration_sec": "decimal(10,2)",
    "hour_of_day": "int",
    "day_of_week": "int",
    "is_weekend": "int",
    "is_night": "int",
    "main_category": "string",
    "user_prior_views": "int",
    "user_prior_carts": "int",
    "user_prior_abandoned_carts": "int",
    "user_total_cumulative_views": "int",
    "user_lifetime_hours": "decimal(10,2)",
    "user_prior_abandon_rate": "decimal(5,4)",
    "is_abandoned": "int",
}

PRESCRIPTIONS = {
    "session_id": "string",
    "user_id": "bigint",
    "total_cart_value": "decimal(12,2)",
    "p_abandonment": "decimal(6,4)",
    "urgency_level": "string",
    "coupon_code": "string",
    "coupon_label": "string",
    "discount_pct": "decimal(5,2)",
    "estimated_recovered_gmv": "decimal(12,2)",
}

# Feature lists of the classifiers.
SESSION_FEATURE_NAMES = [
    "num_cart_items",
    "total_cart_value",
    "max_item_price",
    "min_item_price",
    "avg_item_price",
    "num_distinct_brands",
    "num_distinct_categories",
    "num_views_before_cart",
    "view_to_cart_ratio",
    "session_duration_sec",
    "hour_of_day",
    "day_of_week",
    "is_weekend",
    "is_night",
]
HISTORY_FEATURE_NAMES = [
    "user_prior_views",
    "user_prior_carts",
    "user_prior_abandoned_carts",
    "user_total_cumulative_views",
    "user_lifetime_hours",
    "user_prior_abandon_rate",
]
NUMERIC_FEATURES = SESSION_FEATURE_NAMES + HISTORY_FEATURE_NAMES
CATEGORICAL_FEATURES = ["main_category"]
TARGET = "is_abandoned"

# Training table of the two forests behind the one-hour trigger.
TRAINING_COLUMNS = [
    "session_id",
    "user_id",
    "total_cart_value",
    "num_cart_items",
    "num_views_before_cart",
    "user_prior_views",
    "user_prior_carts",
    "session_duration_sec",
    "hour_of_day",
    "is_night",
    "user_profile",
    "is_abandoned",
]
TRAINING = T.StructType(
    [
        T.StructField("session_id", T.StringType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("total_cart_value", T.DoubleType()),
        T.StructField("num_cart_items", T.IntegerType()),
        T.StructField("num_views_before_cart", T.IntegerType()),
        T.StructField("user_prior_views", T.LongType()),
        T.StructField("user_prior_carts", T.LongType()),
        T.StructField("session_duration_sec", T.LongType()),
        T.StructField("hour_of_day", T.IntegerType()),
        T.StructField("is_night", T.IntegerType()),
        T.StructField("user_profile", T.StringType()),
        T.StructField("is_abandoned", T.IntegerType()),
    ]
)
