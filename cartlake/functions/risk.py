"""Abandonment risk as rules."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartlake.functions.events import night_flag

# Tiers of the decision rules.
LOW_RISK_BELOW = 0.40
MODERATE_RISK_BELOW = 0.65
HIGH_RISK_BELOW = 0.85
PREDICTED_ABANDONED_FROM = 0.50


def real(value: float) -> Column:
    return F.lit(float(value))


def clip(x: Column, low: float, high: float) -> Column:
    return F.greatest(real(low), F.least(real(high), x))


def logistic(x: Column) -> Column:
    return real(1) / (real(1) + F.exp(-x))


def points(condition: Column, value: float) -> Column:
    return F.when(condition, real(value)).otherwise(real(0))


def heuristic_risk() -> Column:
    """The risk used while no model is trained."""
    raised = (
        real(0.45)
        + points(F.col("total_cart_value") > 400, 0.20)
        + points(F.col("is_night") == 1, 0.10)
    )
    return clip(raised - points(F.col("num_views_before_cart") > 4, 0.15), 0.10, 0.95)


def logistic_risk(profile: Column) -> Column:
    """A hand-set logistic model over value, views, hour, duration and profile."""
    views = F.col("num_views_before_cart")
    at_night = night_flag(F.col("hour_of_day")) == 1
    log_odds = (
        real(-0.3)
        + F.col("total_cart_value") / real(1000) * real(1.2)
        - views / real(5) * real(0.75)
        + points(views <= 2, 0.55)
        + points(at_night, 0.85)
        + points(F.col("session_duration_sec") < 45, 0.45)
        + F.when(profile == "bargain_hunter", real(0.65))
        .when(profile == "high_intent", real(-1.0))
        .otherwise(real(0))
    )
    return clip(F.round(logistic(log_odds), 3), 0.05, 0.95)


def stream_risk() -> Column:
    """The two-level risk of the streaming path without a model."""
    keen = (F.col("num_views_before_cart") >= 5) | (F.col("total_cart_value") > 250)
    return F.when(keen, real(0.72)).otherwise(real(0.42))


def risk_band(p: Column) -> Column:
    return (
        F.when(p < LOW_RISK_BELOW, "BAIXO RISCO")
        .when(p < MODERATE_RISK_BELOW, "RISCO MODERADO")
        .otherwise("ALTO RISCO")
    )


def predicted_abandoned(p: Column) -> Column:
    return F.when(p >= PREDICTED_ABANDONED_FROM, 1).otherwise(0)
