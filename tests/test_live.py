"""Tables that are kept up to date batch by batch."""

import random

import pytest
from pyspark.sql import functions as F

from cartlake.operators import gold, learning, triggers
from cartlake.operators.silver import silver_events, with_month
from cartlake.schemas import BRONZE_WITH_ID
from cartlake.session import stage
from cartlake.sources import sinks, topics
from cartlake.sources.log import TieredLog
from cartlake.streaming import clock, jobs
from cartlake.streaming.views import GOLD_OUTPUT, LiveGold
from tests.conftest import by, event
from tests.test_gold import hot_log
from tests.test_streaming import END, stream, write_files
from tests.test_triggers import edges, seconds


def summed(rows):
    return rows.groupBy("k").agg(F.sum("n").alias("n"))


def small_log(spark, tmp_path, fan):
    schema = spark.createDataFrame([], "k string, n long").schema
    return TieredLog(spark, str(tmp_path / "log"), schema, "k", summed, buckets=3, fan=fan)


def table(spark, rows):
    return spark.createDataFrame(rows, "k string, n long").coalesce(1)


def totals(log, last):
    return {r.k: r.n for r in summed(log.read(last)).collect()}


@pytest.mark.parametrize("fan", [2, 3])
def test_log_holds_each_batch_once(spark, tmp_path, fan):
    log = small_log(spark, tmp_path, fan)
    want = {}
    for n in range(8):
        rows = [("a", 1), (f"b{n % 3}", 10 + n)] if n != 4 else []
        log.append(table(spark, rows), n)
        if n % 3 == 1:
            log.append(table(spark, rows), n)  # Once more, as after a failure.
        for k, v in rows:
            want[k] = want.get(k, 0) + v
        assert totals(log, n) == want
        assert log.last() == n
        spans = sorted((start, start + fan**tier) for tier, start in log.cover(n))
        assert spans[0][0] == 0 and spans[-1][1] == n + 1
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
        assert len(spans) <= (fan - 1) * 4
    assert totals(log, 8 - fan) is not None


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_path):
    log = small_log(spark, tmp_path, 2)
    rows = spark.range(0, 200_000, 1, 8).selectExpr("'a' as k", "id as n")
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "64k")
    try:
        log.append(rows, 0)
    finally:
        spark.conf.unset(size)
    assert len(list((tmp_path / "log" / "tier=0").glob("start=0/bucket=*/*.parquet"))) > 1
    assert totals(log, 0) == {"a": sum(range(200_000))}


def test_unfinished_merge_is_not_read(spark, tmp_path):
    log = small_log(spark, tmp_path, 2)
    for n in range(3):
        log.append(table(spark, [("a", 1)]), n)
    log.save(table(spark, [("a", 1)]), 0, 3)
    # The merges of batch 3 have not come about, or only half of one.
    (tmp_path / "log" / "tier=1" / "start=2" / "bucket=0").mkdir(parents=True)
    assert totals(log, 3) == {"a": 4}
    assert sorted(log.cover(3)) == [(0, 2), (0, 3), (1, 0)]
    log.append(table(spark, [("a", 1)]), 3)
    assert log.cover(3) == [(2, 0)]
    assert totals(log, 3) == {"a": 4}


def test_few_buckets_are_read(spark, tmp_path):
    log = small_log(spark, tmp_path, 4)
    log.append(table(spark, [(f"k{i}", i) for i in range(50)]), 0)
    asked = log.touched(table(spark, [("k7", 0)]))
    assert len(asked) == 1
    rows = log.read(0, asked)
    assert 0 < rows.count() < 50 and rows.where("k = 'k7'").count() == 1
    assert "bucket" in rows._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1].split("]")[0]


def all_rows(df):
    return sorted(tuple(r) for r in df.select(*GOLD_OUTPUT).collect())


def awkward_log():
    """A hot buyer, sessions of two buyers, and a last batch of first events."""
    log = hot_log(500, seed=8)
    log += [event("2024-02-01 10:00:00", "cart", "shared", 3), event("2024-02-01 12:00:00", "cart", "shared", 4)]
    log += [event("2024-02-02 10:00:00", "cart", "later", 3), event("2024-02-02 10:00:00", "cart", "later too", 4)]
    return log


LATE = [
    # The session passes to buyer 4 and then to 5, and others start before what came first.
    [event("2024-02-01 09:00:00", "view", "shared", 4)],
    [event("2024-02-01 08:00:00", "view", "shared", 5), event("2023-12-01 08:00:00", "cart", "1-hot", 1)],
    [event("2024-02-01 07:00:00", "view", "shared", 4), event("2024-02-02 11:00:00", "purchase", "later", 3)],
]


def test_live_gold_equals_gold_of_all_events(spark, bronze, tmp_path):
    log = awkward_log()
    silver = silver_events(bronze([*log, *[e for batch in LATE for e in batch]]))
    rng = random.Random(2)
    number = {i: rng.randrange(2) for i in range(len(log))}
    at = len(log)
    for batch in LATE:
        number |= {at + i: 2 + LATE.index(batch) for i in range(len(batch))}
        at += len(batch)
    marks = spark.createDataFrame(list(number.items()), "event_id long, batch int")
    marked = stage(silver.join(marks, "event_id"), "marked")
    views = LiveGold(spark, str(tmp_path / "live"), silver.schema, buckets=3, fan=2)
    for n in range(2 + len(LATE)):
        part = marked.where(F.col("batch") == n).select(*silver.columns)
        changed = views.update(part, n)
        if n == 3:
            changed = views.update(part, n)
        if n in (1, 3):
            so_far = marked.where(F.col("batch") <= n).select(*silver.columns)
            assert all_rows(views.read(n)) == all_rows(gold.gold_carts(so_far))
    # The last batch touches two buyers only, from their changed carts on.
    assert {r.user_session for r in changed.collect()} <= {"shared", "later", "later too"} | {
        r.user_session for r in gold.gold_carts(silver).where("user_id in (3, 4)").collect()
    }
    assert changed.where("user_id = 1").count() == 0
    assert views.update(silver.limit(0), 2 + len(LATE)).count() == 0
    assert all_rows(views.read()) == all_rows(gold.gold_carts(silver))


def brute_history(events):
    """(prior carts, prior views) of each session at its deadline, by loops."""
    out = {}
    rows = [(seconds(e[0]), e[1], e[6], e[7]) for e in events]
    for name in {s for *_, s in rows}:
        mine = sorted((sec, i, u) for i, (sec, _, u, s) in enumerate(rows) if s == name)
        carts = [sec for sec, kind, _, s in rows if s == name and kind == "cart"]
        if carts:
            due, user = min(carts) + 3600, mine[0][2]
            begun = {s for sec, kind, u, s in rows if u == user and s != name and kind == "cart" and sec <= due}
            views = sum(kind == "view" and u == user and s in begun and sec <= due for sec, kind, u, s in rows)
            out[name] = (len(begun), views)
    return out


def test_history_as_of_the_deadline(bronze):
    events = awkward_log()
    silver = silver_events(bronze(events))
    got = {r.user_session: (r.user_prior_carts, r.user_prior_views) for r in triggers.decision_features(silver).collect()}
    want = brute_history(events)
    assert got and got == {name: want[name] for name in got}


def test_nothing_after_the_deadline_leaks(spark, bronze):
    """Whatever comes later, also in the buyer's other sessions, changes no feature."""
    events = [
        event("2024-01-01 10:00:00", "view", "old"), event("2024-01-01 10:01:00", "cart", "old"),
        event("2024-01-02 10:00:00", "cart", "now"), event("2024-01-02 11:00:00", "view", "old"),
    ]
    later = [
        event("2024-01-02 11:00:01", "view", "old"), event("2024-01-02 11:00:01", "cart", "new"),
        event("2024-01-02 11:30:00", "cart", "now", price=900.0),
    ]
    end = F.lit(seconds("2024-01-02 11:00:00"))
    rows = [by(triggers.decision_features(silver_events(bronze(e)), end), "user_session")["now"] for e in (events, events + later)]
    assert rows[0] == rows[1]
    assert (rows[0].user_prior_carts, rows[0].user_prior_views) == (1, 2)


def test_act_reads_the_time_of_its_sessions(spark, bronze, tmp_path):
    """Two months of silver; the sessions of March do not read February."""
    events = [*edges(), END, event("2024-02-01 10:00:00", "cart", "february", 5)]
    silver = silver_events(bronze(events))
    path = str(tmp_path / "silver")
    sinks.write_layer(with_month(silver), path, ["year", "month"])
    views = LiveGold(spark, str(tmp_path / "live"), silver.schema, buckets=3)
    views.update(silver, 0)
    fired = triggers.fired(triggers.clocks(silver), list(triggers.TRIGGERS), triggers.last_event_sec(silver))
    fired = fired.where("user_session <> 'february'").select("user_session", "user_id", "trigger", "t0", "fires_at_sec")
    got = jobs.act(fired, spark.read.parquet(path), views)
    want = triggers.trigger_chain(silver).where("user_session <> 'february'")
    assert sorted(got.select(want.columns).collect()) == sorted(want.collect())
    for rows in (got, jobs.between(spark.read.parquet(path), 0, seconds("2024-01-01 12:00:00"))):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "month" in plan.split("PartitionFilters")[1].split("]")[0]
    read = jobs.between(spark.read.parquet(path), seconds("2024-01-01 09:00:00"), seconds("2024-01-01 12:00:00"))
    assert read.count() == sum("2024-01-01 09:00:00" <= e[0] <= "2024-01-01 12:00:00" for e in events)


def test_a_retry_repeats_only_what_is_missing(spark, tmp_path):
    seen, broken = [], [True]

    def sink(name):
        return lambda rows, n: seen.append((name, n, rows.count()))

    def fails(rows, n):
        if n == 1 and broken[0]:
            raise RuntimeError("sink down")
        seen.append(("b", n, rows.count()))

    write = jobs.fan_out(str(tmp_path / "held"), sink("a"), fails, sink("c"))
    rows = spark.range(5).withColumnRenamed("id", "n")
    write(rows, 0)
    with pytest.raises(RuntimeError):
        write(rows, 1)
    broken[0] = False
    write(rows, 1)
    write(rows, 1)
    assert seen == [(s, n, 5) for n in (0, 1) for s in "abc"]


def test_live_writer_lands_everything_once(spark, tmp_path):
    folder = write_files(tmp_path / "in", [hot_log(200, seed=4), edges()])
    raw = topics.read_event_files(spark, folder, BRONZE_WITH_ID, files_per_batch=1)
    silver = silver_events(raw)
    views = LiveGold(spark, str(tmp_path / "live"), silver.schema, buckets=2)
    write = jobs.live_writer(
        str(tmp_path / "bronze"), str(tmp_path / "silver"), views,
        jobs.scored(jobs.serving_writer(str(tmp_path / "serving"))), jobs.scored(jobs.recent_writer(str(tmp_path / "recent"), 10)),
        ledger=str(tmp_path / "ledger"),
    )
    jobs.drain(jobs.start(raw, write, str(tmp_path / "state")))
    landed = spark.read.parquet(str(tmp_path / "silver")).select(*silver.columns)
    want = gold.gold_carts(landed)
    assert all_rows(views.read()) == all_rows(want)
    served = sinks.read_latest(spark, str(tmp_path / "serving" / "session_features"), "session_id")
    assert {(r.session_id, r.user_prior_carts, r.is_abandoned) for r in served.collect()} == {
        (r.user_session, r.user_prior_carts, r.is_abandoned) for r in want.collect()
    }
    newest = spark.read.parquet(str(tmp_path / "recent")).where("batch_id = 1").collect()
    assert len(newest) == 10 and len({r.user_session for r in newest}) == 10


def test_forests_decide_on_the_stream(spark, bronze, tmp_path):
    """The stream's decisions are those of the batch form, history and forests included."""
    log = [*hot_log(300, seed=11), END]
    silver = silver_events(bronze(log))
    training = learning.training_table(gold.gold_carts(silver))
    table = stage(training, "training").coalesce(1)
    forests = learning.Forests(learning.fit_risk_forest(table, 5, 4), learning.fit_profile_forest(table, 5, 4))
    forests.save(str(tmp_path / "models"))
    forests = learning.Forests.load(str(tmp_path / "models"))
    views = LiveGold(spark, str(tmp_path / "live"), silver.schema, buckets=3)
    marked = silver.withColumn("part", F.col("event_id") % 3)
    for n in range(3):
        views.update(marked.where(F.col("part") == n).drop("part"), n)
    path = str(tmp_path / "silver")
    sinks.write_layer(with_month(silver), path, ["year", "month"])
    folder = write_files(tmp_path / "in", [sorted(log[:-1]), [END]])
    act = jobs.action_writer(path, str(tmp_path / "fired"), str(tmp_path / "actions"), views, forests)
    jobs.drain(jobs.start(clock.fired_triggers(stream(spark, folder)), act, str(tmp_path / "state")))
    got = spark.read.parquet(str(tmp_path / "actions")).drop("batch_id")
    due = triggers.fired(triggers.clocks(silver), list(triggers.TRIGGERS), triggers.last_event_sec(silver))
    want = triggers.actions(due, triggers.buyer_seconds(silver), forests)
    assert sorted(got.select(want.columns).collect()) == sorted(want.collect())
    decided = triggers.forest_decisions(due.where("delay = 3600"), triggers.buyer_seconds(silver), forests)
    assert decided.where("p_abandonment between 0 and 1").count() == decided.count() > 0
