"""Scores and offers for cart tables."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlake.functions import offers, profiles, risk

# What a missing cart value counts as in a re-scored matrix.
MATRIX_DEFAULTS = {
    "total_cart_value": 100.0,
    "num_cart_items": 1,
    "num_views_before_cart": 1,
    "view_to_cart_ratio": 1.0,
    "session_duration_sec": 60,
    "is_night": 0,
    "is_abandoned": 1,
}


def fill_defaults(carts: DataFrame, defaults: dict[str, float | int]) -> DataFrame:
    """Named defaults first, then 0 for any other number."""
    return carts.fillna(defaults).fillna(0)


def with_logistic_risk(carts: DataFrame) -> DataFrame:
    labelled = carts.withColumn("user_profile", profiles.rule_c())
    return labelled.withColumn("p_abandonment", risk.logistic_risk(F.col("user_profile")))


def with_heuristic_risk(carts: DataFrame) -> DataFrame:
    return carts.withColumn("p_abandonment", risk.heuristic_risk())


def with_coupon(scored: DataFrame) -> DataFrame:
    """Choose the offer and attach its record. The offers are seven fixed rows."""
    spark = scored.sparkSession
    catalogue = spark.createDataFrame(offers.COUPON_OFFERS, offers.OFFER_SCHEMA)
    code = offers.matrix_code(F.col("p_abandonment"), F.col("total_cart_value"))
    chosen = scored.withColumn("coupon_code", code)
    return chosen.join(F.broadcast(catalogue), "coupon_code", "left")


def with_prescription(carts: DataFrame, profile: Column) -> DataFrame:
    """The offer by buyer profile. The offers are five fixed rows."""
    spark = carts.sparkSession
    catalogue = spark.createDataFrame(offers.PROFILE_OFFERS, offers.PROFILE_OFFER_SCHEMA)
    chosen = carts.withColumn("user_profile", profile).withColumn(
        "coupon_code", offers.profile_code(F.col("user_profile"), F.col("total_cart_value"))
    )
    return chosen.join(F.broadcast(catalogue), ["user_profile", "coupon_code"], "left")


def with_recovery(offered: DataFrame) -> DataFrame:
    value, discount = F.col("total_cart_value"), F.col("discount_pct")
    return offered.withColumns(
        {
            "estimated_recovered_gmv": offers.recovered_gmv(F.col("coupon_code"), value, discount),
            "recovered_money": offers.recovered_money(F.col("coupon_code"), value, discount),
            "discount_value": value * discount,
        }
    )


def score(carts: DataFrame, p: Column | None = None) -> DataFrame:
    """Risk, coupon and expected recovery of each cart. ``p`` is the risk to use,
    such as a model's probability column; without it the heuristic is used."""
    scored = with_heuristic_risk(carts) if p is None else carts.withColumn("p_abandonment", p)
    return with_recovery(with_coupon(scored))


def validated_matrix(carts: DataFrame) -> DataFrame:
    """Re-score a layer whose rows may lack values."""
    scored = score(fill_defaults(carts, MATRIX_DEFAULTS))
    return scored.select(
        F.col("user_session").alias("session_id"),
        "user_id",
        F.round("total_cart_value", 2).alias("total_val"),
        "num_cart_items",
        "num_views_before_cart",
        "hour_of_day",
        F.round("p_abandonment", 4).alias("p_abandonment"),
        "is_abandoned",
        "coupon_code",
        F.col("recovered_money").cast("double").alias("recovered_gmv"),
    )


def priority_queue(scored: DataFrame) -> DataFrame:
    """Abandoned carts with an offer, most urgent and most valuable first."""
    eligible = scored.where((F.col("is_abandoned") == 1) & (F.col("coupon_code") != offers.NO_COUPON))
    ranked = eligible.withColumn("urgency_rank", offers.urgency_rank(F.col("urgency_level")))
    return ranked.orderBy("urgency_rank", F.desc("total_cart_value"), "user_session")
