"""Registered queries that train a model. Fits depend on the order of rows in
partitions, so these are checked by shape and range."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlake.operators import learning, metrics, scoring, triggers
from cartlake.operators.gold import gold_carts
from cartlake.plans.layers import Layers
from cartlake.schemas import (
    CATEGORICAL_FEATURES,
    GOLD_COLUMNS,
    HISTORY_FEATURE_NAMES,
    NUMERIC_FEATURES,
    SESSION_FEATURE_NAMES,
    TARGET,
    TRAINING_COLUMNS,
)
from cartlake.session import stage


def parts(x: Layers) -> tuple[DataFrame, DataFrame]:
    frame = learning.feature_frame(x.gold, keep=["user_session", TARGET])
    split = stage(learning.with_split(frame), "split")
    return split.where(F.col("split") == "train"), split.where(F.col("split") == "test")


def model_comparison(x: Layers) -> DataFrame:
    return learning.train_models(x.gold).comparison


def feature_set_gain(x: Layers) -> DataFrame:
    """What the buyer's history adds to a forest, on one and the same split."""
    train, test = parts(x)
    names = ["accuracy", "precision", "recall", "f1", "roc_auc"]
    quality = {}
    for kind, numeric in (("session_only", SESSION_FEATURE_NAMES), ("with_history", NUMERIC_FEATURES)):
        model = learning.fit(train, learning.random_forest(), numeric)
        quality[kind] = learning.evaluate(model, test).first()
    rows = [
        (n, quality["session_only"][n], quality["with_history"][n], quality["with_history"][n] - quality["session_only"][n])
        for n in names
    ]
    return x.spark.createDataFrame(rows, "metric string, session_only double, with_history double, gain double")


def feature_importance(x: Layers, n: int = 7) -> DataFrame:
    train, _ = parts(x)
    model = learning.fit(train, learning.random_forest())
    shares = learning.importances(model, NUMERIC_FEATURES, CATEGORICAL_FEATURES)[:n]
    rows = [(i, name, value * 100, name in HISTORY_FEATURE_NAMES) for i, (name, value) in enumerate(shares, 1)]
    return x.spark.createDataFrame(rows, "rank int, feature string, importance_pct double, is_history boolean")


def profile_report(x: Layers) -> DataFrame:
    """The profile forest on the rows it was not trained on."""
    gold = stage(x.gold.select(*GOLD_COLUMNS), "gold")
    table = learning.with_split(gold).drop("view_to_cart_ratio")
    train = learning.training_table(table.where(F.col("split") == "train"))
    test = learning.training_table(table.where(F.col("split") == "test"))
    model = learning.fit_profile_forest(train)
    said = model.transform(learning.with_ratio(test))
    return metrics.per_class_report(said, "user_profile", "predicted_profile")


def model_scored_carts(x: Layers) -> DataFrame:
    """All carts scored by a forest instead of a rule."""
    gold = stage(x.gold, "gold")
    frame = learning.feature_frame(gold, keep=["user_session", TARGET])
    model = learning.fit(learning.with_split(frame).where("split = 'train'"), learning.random_forest())
    scored = scoring.with_recovery(scoring.with_coupon(learning.predict(model, gold)))
    return scored.select(
        "user_session",
        "user_id",
        "total_cart_value",
        "is_abandoned",
        "p_abandonment",
        "coupon_code",
        "urgency_level",
        "estimated_recovered_gmv",
    )


# What gold and the triggers read of silver.
SILVER_READ = [
    "user_session", "user_id", "event_type", "event_time_ts", "event_id", "price", "category_code", "brand",
]


def forest_decisions(x: Layers) -> DataFrame:
    """The one-hour decisions by forests that are trained on the training rows of gold. Gold and
    triggers read one staged silver, so the log is split into sessions and cleaned once."""
    silver = stage(x.silver.select(*SILVER_READ), "silver")
    carts = stage(gold_carts(silver).select(*GOLD_COLUMNS), "gold")
    table = learning.training_table(learning.with_split(carts).where("split = 'train'"))
    forests = learning.fit_forests(stage(table.select(*TRAINING_COLUMNS), "training"))
    due = triggers.fired(triggers.clocks(silver), [triggers.ONE_HOUR], triggers.last_event_sec(silver))
    return triggers.forest_decisions(stage(due, "due"), triggers.buyer_seconds(silver), forests)
