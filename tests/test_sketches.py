import json

from pyspark.sql import functions as F

from cartlake.operators import sketches
from cartlake.operators.silver import silver_events
from cartlake.plans import dashboard
from tests.conftest import event
from tests.test_gold import hot_log


def test_days_merge_to_the_whole(bronze):
    silver = silver_events(bronze(hot_log(900)))
    days = sketches.daily_sketches(silver)
    merged = sketches.estimates(sketches.merged(days.withColumn("all", F.lit(1)), ["all"])).first()
    whole = silver.agg(
        F.count(F.lit(1)).alias("events"), F.count_distinct("user_id").alias("buyers"), F.count_distinct("user_session").alias("sessions")
    ).first()
    assert merged.events == whole.events
    for name in ("buyers", "sessions"):
        assert abs(merged[name] - whole[name]) <= sketches.COUNT_ERROR * whole[name]
    prices = sorted(r.price for r in silver.where("event_type = 'cart'").collect())
    rank = sum(p <= merged.median_price for p in prices) / len(prices)
    assert abs(rank - 0.5) <= sketches.RANK_ERROR + 1 / len(prices)


def test_a_day_without_carts_has_no_median(bronze):
    silver = silver_events(bronze([event("2024-01-01 10:00:00", "view")]))
    row = sketches.estimates(sketches.daily_sketches(silver)).first()
    assert (row.events, row.buyers, row.sessions, row.median_price) == (1, 1, 1, None)


def test_best_model_in_the_document(spark):
    rows = [("a", 0.5, 0.6, 0.7, 0.8, 0.9, 1, 2, 3, 4, False), ("b", 0.1, 0.2, 0.3, 0.4, 0.5, 5, 6, 7, 8, True)]
    names = "model string, accuracy double, roc_auc double, precision double, recall double, f1 double"
    comparison = spark.createDataFrame(rows, f"{names}, tn long, fp long, fn long, tp long, is_best boolean")
    body = json.loads(dashboard.model_metrics(comparison).first().body)
    assert body == {
        "bestModelName": "b", "accuracy": 0.1, "rocAuc": 0.2, "precision": 0.3, "recall": 0.4, "f1": 0.5,
        "confusionMatrix": {"tn": 5, "fp": 6, "fn": 7, "tp": 8},
    }
