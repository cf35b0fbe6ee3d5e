"""Loads into a database: the statements run in DuckDB, within this process. The connection
itself needs a driver that is not installed here."""

import duckdb
import pytest

from cartlake.operators import gold
from cartlake.operators.silver import silver_events
from cartlake.plans import medallion
from cartlake.sources import jdbc, sinks
from tests.conftest import golden_events
from tests.test_gold import hot_log


class InProcess(jdbc.Database):
    """Stages and runs statements in a DuckDB of its own."""

    def __init__(self):
        super().__init__("jdbc:none")
        object.__setattr__(self, "duck", duckdb.connect())

    def stage(self, rows, staged):
        held = rows.toPandas()  # noqa: F841
        self.duck.execute(f"create or replace table {staged} as select * from held")
        table = staged.rsplit("_load_", 1)[0]
        self.duck.execute(f"create table if not exists {table} as select * from {staged} limit 0")

    def run(self, spark, statements):
        self.duck.execute("begin")
        try:
            for text in statements:
                self.duck.execute(text)
            self.duck.execute("commit")
        except Exception:
            self.duck.execute("rollback")
            raise

    def rows(self, table):
        return sorted(self.duck.execute(f"select * from {table}").fetchall())


def test_a_load_replaces_its_keys_and_a_second_one_changes_nothing(spark):
    database = InProcess()
    first = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    second = spark.createDataFrame([("b", 2), ("c", 2)], "k string, v int")
    database.replace(first, "t", "k", "0")
    for _ in range(2):
        database.replace(second, "t", "k", "1")
        assert database.rows("t") == [("a", 1), ("b", 2), ("c", 2)]
    assert database.duck.execute("show tables").fetchall() == [("t",)]


def test_a_failed_load_leaves_the_table(spark):
    database = InProcess()
    database.replace(spark.createDataFrame([("a", 1)], "k string, v int"), "t", "k", "0")
    with pytest.raises(duckdb.Error):
        database.run(spark, [*jdbc.replace_statements("t", "t", "k", ["k", "v"])[:1], "insert into nowhere values (1)"])
    assert database.rows("t") == [("a", 1)]


def test_statements_take_plain_names_only():
    with pytest.raises(ValueError):
        jdbc.replace_statements("t; drop table t", "s", "k", ["k"])
    with pytest.raises(ValueError):
        jdbc.bounds_query("t", "a b")
    assert jdbc.staging_name("public.t", "7") == "public.t_load_7"


def test_ranges_come_from_the_table():
    assert jdbc.range_options("id", None, 8) == {} == jdbc.range_options("id", (None, None), 8)
    few = jdbc.range_options("id", (5, 7), 8)
    assert few == {"partitionColumn": "id", "lowerBound": "5", "upperBound": "8", "numPartitions": "3"}
    duck = duckdb.connect()
    duck.execute("create table t as select * from (values (3), (null), (11)) v(id)")
    assert duck.execute(f"select * from {jdbc.bounds_query('t', 'id')}").fetchall() == [(3, 11)]


def test_read_asks_for_bounds_first(spark, monkeypatch):
    asked = []

    class Reader:
        def __init__(self, options):
            self.options = options

        def load(self):
            asked.append(self.options)
            return spark.createDataFrame([(10, 90)], "lo long, hi long")

    def reader(self, spark, table, **more):
        return Reader({"dbtable": table, **self.options, **more})

    monkeypatch.setattr(jdbc.Database, "reader", reader)
    jdbc.Database("jdbc:none", {"user": "u"}).read(spark, "t", "id", 4)
    assert asked == [
        {"dbtable": "(select min(id) as lo, max(id) as hi from t) bounds", "user": "u"},
        {"dbtable": "t", "user": "u", "partitionColumn": "id", "lowerBound": "10", "upperBound": "91", "numPartitions": "4"},
    ]


def test_serving_tables_go_to_the_database_as_well(spark, bronze, tmp_path):
    lake = medallion.Lake(str(tmp_path))
    database = InProcess()
    for log in (hot_log(150), hot_log(150) + golden_events()):
        sinks.write_layer(gold.gold_carts(silver_events(bronze(log))), lake.gold)
        for _ in range(2):
            features, prescribed = medallion.populate_serving(spark, lake, 3, database=database)
        for table, rows in zip(medallion.SERVING_TABLES, (features, prescribed), strict=True):
            held = {r[0] for r in database.duck.execute(f"select session_id from {table}").fetchall()}
            count = database.duck.execute(f"select count(*) from {table}").fetchone()[0]
            assert count == len(held) == rows.count()
            assert held == {r.session_id for r in rows.collect()}
