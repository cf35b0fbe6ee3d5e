from pyspark.sql import functions as F

from cartlake.operators import silver
from cartlake.sources.sinks import write_layer
from tests.conftest import event

GOOD = "2024-01-02 03:04:05"


def bad_rows(bronze):
    return bronze(
        [
            event(GOOD, "view"),
            event("2024-13-02 03:04:05", "view"),
            event("2024-01-02T03:04:05", "view"),
            event("soon", "view"),
            event(None, "view"),
            event(GOOD, "view", product=None),
            event(GOOD, "view", user=None),
            event(GOOD, "view", session=None),
            event(GOOD, "view", price=0.0),
            event(GOOD, "view", price=-1.0),
            event(GOOD, "view", price=None),
            event(GOOD, "remove_from_cart"),
            event(GOOD, " VIEW "),
            event(GOOD, None),
            event(GOOD, "view"),
        ]
    )


def test_each_rule_rejects(bronze):
    report = {r.outcome: r.events for r in silver.quality_report(bad_rows(bronze)).collect()}
    assert report == {"accepted": 2, "bad_time": 4, "missing_key": 3, "bad_price": 3, "bad_type": 3}


def test_silver_keeps_what_the_report_accepts(bronze):
    assert silver.silver_events(bad_rows(bronze)).count() == 2


def test_normalize_and_dedup(bronze):
    kept = silver.silver_events(bad_rows(bronze), normalize=True, dedup=True).collect()
    assert [(r.event_id, r.event_type) for r in kept] == [(0, "view")]
    assert silver.silver_events(bad_rows(bronze), normalize=True).count() == 3


def test_derived_columns(bronze):
    rows = silver.silver_events(
        bronze([event(f"2024-01-02 {h:02d}:00:00", "view", category=None, brand=None) for h in range(24)])
    ).collect()
    assert {r.hour_of_day for r in rows if r.is_night} == {22, 23, 0, 1, 2, 3, 4, 5}
    assert {(r.category_code, r.brand) for r in rows} == {("outros.desconhecido", "generico")}
    assert rows[0].event_time_clean == "2024-01-02 00:00:00"


def test_event_id_comes_from_content(bronze):
    plain = bronze([event(GOOD, "view"), event(GOOD, "cart")]).drop("event_id")
    first = {r.event_id for r in silver.silver_events(plain).collect()}
    again = {r.event_id for r in silver.silver_events(plain.repartition(3)).collect()}
    assert first == again and len(first) == 2


def test_month_columns(bronze):
    row = silver.with_month(silver.silver_events(bronze([event(GOOD, "view")]))).first()
    assert (row.year, row.month) == (2024, 1)


def test_fact_price_is_decimal(bronze):
    facts = silver.fact_events(silver.silver_events(bronze([event(GOOD, "view")])))
    assert facts.schema["price"].dataType.simpleString() == "decimal(10,2)"
    assert facts.select(F.sum("price")).first()[0] == 10


def test_month_partitions_are_written_and_pruned(spark, bronze, tmp_path):
    rows = [event("2019-10-31 23:59:59", "view"), event("2019-11-01 00:00:00", "view"), event("2019-11-02 00:00:00", "cart")]
    path = str(tmp_path / "silver")
    write_layer(silver.with_month(silver.silver_events(bronze(rows))), path, ["year", "month"])
    back = spark.read.parquet(path)
    assert {(r.year, r.month, r["count"]) for r in back.groupBy("year", "month").count().collect()} == {(2019, 10, 1), (2019, 11, 2)}
    november = back.filter("year = 2019 and month = 11")
    scan = november._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in scan
    assert november.count() == 2
