"""Values at the edge: ids of 64 bits, prices that are no amounts, half cents."""

from pyspark.sql import functions as F

from cartlake.functions.events import event_order, to_cents
from cartlake.operators import gold, silver
from tests.conftest import by


def test_a_later_second_comes_after_any_id(spark):
    low, high = -(2**63), 2**63 - 1
    rows = [(10, high), (11, low), (11, high), (12, low), (12, 0)]
    table = spark.createDataFrame(rows, "sec long, id long")
    placed = [(r["sec"], r["id"]) for r in table.orderBy(F.desc(event_order(F.col("sec"), F.col("id")))).collect()]
    assert placed == sorted(rows, reverse=True)


def test_owner_of_a_session_with_extreme_ids(spark, bronze):
    events = bronze(
        [
            ("2019-10-01 05:00:00", "cart", 1, "a.b", "x", 5.0, 7, "s"),
            ("2019-10-01 05:00:01", "cart", 1, "a.b", "x", 5.0, 8, "s"),
        ]
    )
    extreme = events.withColumn("event_id", F.when(F.col("user_id") == 7, F.lit(2**63 - 1)).otherwise(F.lit(-(2**63))))
    carts = gold.gold_carts(silver.silver_events(extreme))
    assert [r["user_id"] for r in carts.select("user_id").collect()] == [7]


def test_prices_that_are_no_amounts(spark, bronze):
    prices = [1.0, float("nan"), float("inf"), float("-inf"), -1.0, 0.0, None]
    events = bronze([(f"2019-10-01 05:00:0{i}", "cart", 1, "a.b", "x", p, 7, "s") for i, p in enumerate(prices)])
    assert silver.silver_events(events).count() == 1
    report = by(silver.quality_report(events), "outcome")
    assert (report["accepted"]["events"], report["bad_price"]["events"]) == (1, 6)
    assert gold.gold_carts(silver.silver_events(events)).count() == 1


def test_half_cents_round_as_decimals(spark):
    table = spark.createDataFrame([(1.005,), (0.285,), (2.0,)], "price double")
    assert [r["c"] for r in table.select(to_cents(F.col("price")).alias("c")).collect()] == [101, 29, 200]
