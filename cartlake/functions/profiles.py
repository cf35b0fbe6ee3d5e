"""Buyer profiles as rules: high_intent, bargain_hunter or browser."""

from pyspark.sql import Column
from pyspark.sql import functions as F

HIGH_INTENT = "high_intent"
BARGAIN_HUNTER = "bargain_hunter"
BROWSER = "browser"
PROFILES = (HIGH_INTENT, BARGAIN_HUNTER, BROWSER)

FEW_VIEWS = 3
MANY_VIEWS = 6


def few_views() -> Column:
    return F.col("num_views_before_cart") <= FEW_VIEWS


def many_views() -> Column:
    return F.col("num_views_before_cart") >= MANY_VIEWS


def at_night() -> Column:
    return F.col("is_night") == 1


def rule_a() -> Column:
    """One-hour trigger: night carts count as bargain hunting, few views win."""
    return (
        F.when(few_views(), HIGH_INTENT)
        .when(many_views() | at_night(), BARGAIN_HUNTER)
        .otherwise(BROWSER)
    )


def rule_b() -> Column:
    """Streaming path: views alone."""
    return (
        F.when(many_views(), BARGAIN_HUNTER)
        .when(few_views(), HIGH_INTENT)
        .otherwise(BROWSER)
    )


def rule_c() -> Column:
    """Label of the training table: also needs a quick decision or a high value."""
    quick = F.col("session_duration_sec") < 90
    dear_night = at_night() & (F.col("total_cart_value") >= 400)
    return (
        F.when(few_views() & quick, HIGH_INTENT)
        .when(many_views() | dear_night, BARGAIN_HUNTER)
        .otherwise(BROWSER)
    )
