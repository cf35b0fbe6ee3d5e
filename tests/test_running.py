import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartlake.operators import running, skew
from cartlake.operators.running import exact_quantiles, running_totals
from cartlake.operators.skew import salted_join
from cartlake.sources.sessions import sessionize


def test_running_totals_equal_a_plain_window(spark):
    rng = random.Random(1)
    rows = [(1 if rng.random() < 0.4 else rng.randint(2, 9), rng.randint(0, 5000), i, rng.randint(0, 9)) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, t long, id long, n long")
    got = running_totals(
        df, ["k"], F.floor(F.col("t") / 100), ["t", "id"], {"before": "n"}, {"first": "t"}, {"total": "before"}
    )
    w = Window.partitionBy("k").orderBy("t", "id")
    want = df.withColumns(
        {
            "before": F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "first": F.min("t").over(Window.partitionBy("k")),
            "total": F.sum("n").over(Window.partitionBy("k")),
        }
    )
    columns = ["k", "t", "id", "n", "before", "first", "total"]
    assert sorted(got.select(columns).collect()) == sorted(want.select(columns).collect())


def test_running_totals_without_partition(spark):
    df = spark.range(1000).withColumn("n", F.col("id") % 7)
    got = running_totals(df, [], F.floor(F.col("id") / 64), ["id"], {"before": "n"})
    total = 0
    for row in got.orderBy("id").collect():
        assert row.before == total
        total += row.n


def test_exact_quantiles(spark):
    rng = random.Random(2)
    groups = {"a": [rng.randint(-5, 10) for _ in range(500)], "b": [rng.randint(0, 2**33) for _ in range(77)], "c": [4]}
    df = spark.createDataFrame(
        [(k, v) for k, vs in groups.items() for v in vs] + [("a", None)], "k string, v long"
    )
    shares = [0.0, 0.25, 0.5, 0.9, 1.0]
    for row in exact_quantiles(df, F.col("v"), shares, ["k"]).collect():
        assert np.allclose(list(row)[1:], np.quantile(groups[row.k], shares), rtol=1e-12)
    single = exact_quantiles(df.where("k = 'a'"), F.col("v"), [0.5]).first()
    assert single.q0 == np.median(groups["a"])


def test_salted_join_equals_join(spark):
    large = spark.range(2000).withColumn("k", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50))
    small = spark.range(40).withColumnRenamed("id", "k").withColumn("x", F.col("k") * 2)
    for how in ("inner", "left"):
        got = salted_join(large, small, "k", F.col("id"), 8, how).select("id", "k", "x")
        want = large.join(small, "k", how).select("id", "k", "x")
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_sessionize_equals_gap_rule(spark):
    rng = random.Random(3)
    rows = [(rng.choice([1, 1, 2, 3]), rng.randint(0, 40 * 86400) * 1_000_000 + rng.choice([0, 1, 999_999])) for _ in range(400)]
    # Exactly the gap apart is the same session, a microsecond more is not.
    gap = 12 * 3600 * 1_000_000
    rows += [(9, 0), (9, gap), (9, 2 * gap + 1), (9, 2 * gap + 1)]
    df = spark.createDataFrame(rows, "user long, us long").withColumn("ts", F.timestamp_micros("us"))
    got = sorted((r.user, r.us, r.session_no) for r in sessionize(df, "user", "ts", 12).collect())
    want, last, number = [], {}, {}
    for user, us in sorted(rows):
        if user in last and us - last[user] > gap:
            number[user] += 1
        number.setdefault(user, 0)
        last[user] = us
        want.append((user, us, number[user]))
    assert got == sorted(want)


@pytest.mark.parametrize("start,stop", [(0, 7), (40, 65), (190, 260)])
def test_ranks_by_ranges(spark, start, stop):
    rows = [(i, None if i % 5 == 0 else f"k{i % 3}") for i in range(200)]
    df = spark.createDataFrame(rows, "id int, k string").repartition(5)
    order = [F.desc_nulls_last("k"), F.asc("id")]
    wanted = [r.id for r in df.orderBy(*order).collect()][start:stop]
    found = running.ranked_between(df, order, start, stop, top_rows=0)
    assert sorted(r.id for r in found.collect()) == sorted(wanted)
    assert "TakeOrdered" not in found._jdf.queryExecution().executedPlan().toString()
    assert running.ranked_between(df.limit(0), order, start, stop, top_rows=0).count() == 0


def test_spread_join_splits_only_hot_keys(spark):
    large = spark.createDataFrame([(i, 0 if i % 3 else i) for i in range(90)], "id int, k int")
    small = spark.createDataFrame([(k, f"v{k}") for k in range(0, 90, 2)], "k int, x string")
    got = skew.spread_join(large, small, "k", F.col("id"), rows_per_task=7).select("id", "k", "x")
    assert sorted(got.collect()) == sorted(large.join(small, "k").select("id", "k", "x").collect())
