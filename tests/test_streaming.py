import json
import random

import pytest
from pyspark.sql import functions as F

from cartlake.operators import gold, kpis, scoring, triggers
from cartlake.operators.silver import silver_events
from cartlake.schemas import BRONZE_WITH_ID
from cartlake.sources import sinks, topics
from cartlake.streaming import clock, jobs, totals
from tests.conftest import event, golden_events
from tests.test_gold import hot_log
from tests.test_triggers import edges


def write_files(folder, batches):
    """One JSON-lines file per micro-batch, with rising modification times."""
    import os

    folder.mkdir()
    number = 0
    for i, batch in enumerate(batches):
        lines = []
        for time, kind, product, category, brand, price, user, session in batch:
            row = (number, f"{time} UTC", kind, product, 1, category, brand, price, user, session)
            lines.append(json.dumps(dict(zip(BRONZE_WITH_ID.names, row, strict=True))))
            number += 1
        path = folder / f"{i:03d}.json"
        path.write_text("\n".join(lines))
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    return str(folder)


def stream(spark, folder):
    return silver_events(topics.read_event_files(spark, folder, BRONZE_WITH_ID, files_per_batch=1))


def run_stream(spark, tmp_path, batches):
    folder = write_files(tmp_path / "in", batches)
    out = str(tmp_path / "out")
    fired = jobs.run_triggers(spark, stream(spark, folder), out, str(tmp_path / "state"))
    return {(r.user_session, r.trigger, r.fires_at_sec) for r in fired.collect()}


def batch_triggers(bronze, events, as_of=None):
    silver = silver_events(bronze(events))
    rows = triggers.trigger_chain(silver, as_of)
    return {(r.user_session, r.trigger, r.fires_at_sec) for r in rows.collect()}


END = event("2024-03-01 00:00:00", "view", "far future", user=99)


def test_edges_equal_batch(spark, bronze, tmp_path):
    events = edges()
    got = run_stream(spark, tmp_path, [events, [END]])
    assert got == batch_triggers(bronze, [*events, END])


def test_files_out_of_order_within_lateness(spark, bronze, tmp_path):
    rng = random.Random(4)
    log = sorted(e for e in hot_log(300, seed=11) if e[0] < "2024-01-04")
    # Neighbours swap places across file borders; none is ten minutes late.
    minutes = [(i, e) for i, e in enumerate(log)]
    batches = [[e for _, e in minutes[i : i + 9]] for i in range(0, len(minutes), 9)]
    for batch in batches:
        rng.shuffle(batch)
    got = run_stream(spark, tmp_path, [*batches, [END]])
    assert got == batch_triggers(bronze, [*log, END])


def test_late_cart_moves_the_clock_back(spark, tmp_path):
    got = run_stream(
        spark,
        tmp_path,
        [
            [event("2024-01-01 10:08:00", "cart", "s"), event("2024-01-01 10:04:30", "purchase", "s")],
            # Eight minutes late: the clock now starts before the purchase.
            [event("2024-01-01 10:00:00", "cart", "s")],
            [END],
        ],
    )
    assert got == set()


def test_no_second_clock_for_a_session(spark, tmp_path):
    got = run_stream(
        spark,
        tmp_path,
        [
            [event("2024-01-01 10:00:00", "cart", "s")],
            [event("2024-01-01 12:00:00", "cart", "s")],
            [event("2024-01-01 12:30:00", "view", "x")],
            [event("2024-01-01 14:00:00", "cart", "s")],
            [END],
        ],
    )
    assert len(got) == 2


def test_repeats_within_a_second_count_once(spark, tmp_path):
    hot = [event("2024-01-01 10:00:00", "cart", "s") for _ in range(500)]
    assert len(run_stream(spark, tmp_path, [hot, hot[:50], [END]])) == 2


def test_purchases_kept_are_the_ones_needed():
    assert clock.needed_purchases(None, [5, 10, 20], 9) == [10, 20]
    assert clock.needed_purchases(15, [5, 10, 20, 30], 9) == [10, 20]
    assert clock.needed_purchases(15, [5, 10, 20, 30], 100) == [20]


def test_actions_equal_batch(spark, bronze, tmp_path):
    events = [*edges(), END]
    folder = write_files(tmp_path / "in", [events[:-1], [END]])
    silver = silver_events(bronze(events))
    silver.write.parquet(str(tmp_path / "silver"))
    query = jobs.start(
        clock.fired_triggers(stream(spark, folder)),
        jobs.action_writer(str(tmp_path / "silver"), str(tmp_path / "fired"), str(tmp_path / "actions")),
        str(tmp_path / "state"),
    )
    jobs.drain(query)
    got = spark.read.parquet(str(tmp_path / "actions")).drop("batch_id")
    want = triggers.trigger_chain(silver)
    assert sorted(got.select(want.columns).collect()) == sorted(want.collect())


def test_lake_writer_is_idempotent(spark, tmp_path):
    folder = write_files(tmp_path / "in", [golden_events()[:3], golden_events()[3:]])
    raw = topics.read_event_files(spark, folder, BRONZE_WITH_ID, files_per_batch=1)
    write = jobs.lake_writer(str(tmp_path / "bronze"), str(tmp_path / "silver"))
    jobs.drain(jobs.start(raw, write, str(tmp_path / "state")))
    landed = spark.read.schema(BRONZE_WITH_ID).json(str(tmp_path / "bronze"))
    assert landed.count() == 5
    # The same batch again replaces its folder.
    write(spark.read.schema(BRONZE_WITH_ID).json(f"{folder}/000.json"), 0)
    assert spark.read.schema(BRONZE_WITH_ID).json(str(tmp_path / "bronze")).count() == 5
    silver = spark.read.parquet(str(tmp_path / "silver"))
    assert silver.select("year", "month").distinct().collect() == [(2019, 10)]
    assert gold.gold_carts(silver).first().session_duration_sec == 108


@pytest.mark.parametrize("parts", [1, 2, 5])
def test_kpis_do_not_depend_on_the_split(spark, bronze, tmp_path, parts):
    scored = scoring.score(gold.session_base(silver_events(bronze(hot_log(600)))))
    whole = kpis.cart_kpis(scored).first()
    path = str(tmp_path / "scored")
    scored.repartition(parts).write.parquet(path)
    reader = spark.readStream.schema(scored.schema).option("maxFilesPerTrigger", 1)
    result = jobs.run_totals(
        spark, totals.running_kpis(reader.parquet(path)), str(tmp_path / "out"), str(tmp_path / "state")
    ).first()
    for name in whole.asDict():
        assert result[name] == whole[name]


def test_topic_round_trip(spark, bronze):
    raw = bronze(golden_events())
    messages = topics.encode(raw)
    decoded = topics.decode(messages, F.col("value"), BRONZE_WITH_ID)
    assert sorted(decoded.collect()) == sorted(raw.collect())


def test_newest_batch_wins(spark, tmp_path):
    path = str(tmp_path / "table")
    first = spark.createDataFrame([("a", 1), ("b", 1)], "session_id string, v int")
    second = spark.createDataFrame([("b", 2), ("c", 2)], "session_id string, v int")
    sinks.append_batch(first, path, 0)
    sinks.append_batch(second, path, 1)
    sinks.append_batch(second, path, 1)
    rows = sinks.read_latest(spark, path, "session_id").collect()
    assert {(r.session_id, r.v) for r in rows} == {("a", 1), ("b", 2), ("c", 2)}


def test_one_batch_feeds_all_sinks(spark, bronze, tmp_path):
    log = hot_log(600)
    scored = scoring.score(gold.gold_carts(silver_events(bronze(log))))
    path = str(tmp_path / "scored")
    scored.repartition(3).write.parquet(path)
    source = spark.readStream.schema(scored.schema).option("maxFilesPerTrigger", 1).parquet(path)
    serve, recent = str(tmp_path / "serving"), str(tmp_path / "recent")
    writers = jobs.fan_out(str(tmp_path / "carts"), jobs.serving_writer(serve), jobs.recent_writer(recent, 10))
    jobs.drain(jobs.start(source, writers, str(tmp_path / "state")))

    carts = {r.user_session: r.last_cart_sec for r in scored.collect()}
    table = sinks.read_latest(spark, f"{serve}/session_features", "session_id")
    assert {r.session_id for r in table.collect()} == set(carts)
    lists = {}
    for r in spark.read.parquet(recent).collect():
        lists.setdefault(r.batch_id, []).append(r)
    assert {len(rows) for rows in lists.values()} == {10}
    last = lists[max(lists)]
    assert all(r.is_new for r in last)
    sessions = {r.user_session for r in last}
    batch = spark.read.parquet(path).count()
    assert len(sessions) == 10 and batch == len(carts)


def test_stream_job(spark, bronze, tmp_path):
    """Two runs: the second takes up where the first stopped."""
    from cartlake import __main__ as job

    folder = write_files(tmp_path / "in", [edges()])
    lake = str(tmp_path / "lake")
    arguments = ["stream", "--lake", lake, "--folder", folder, "--once"]
    job.main(arguments)
    first = spark.read.parquet(f"{lake}/actions").count()
    (tmp_path / "in" / "999.json").write_text(
        json.dumps(
            {
                "event_time": END[0] + " UTC", "event_type": "view", "product_id": 1, "category_id": 1,
                "price": 1.0, "user_id": 99, "user_session": "far future",
            }
        )
    )
    job.main(arguments)
    got = spark.read.parquet(f"{lake}/actions").drop("batch_id")
    want = triggers.trigger_chain(silver_events(bronze([*edges(), END])))
    assert 0 < first <= got.count()
    assert sorted(got.select(want.columns).collect()) == sorted(want.collect())


def test_no_state_is_left_of_closed_sessions(spark, tmp_path):
    """Bought, decided and view-only sessions are forgotten after their time, not before."""
    folder = write_files(
        tmp_path / "in",
        [
            [event("2024-01-01 10:00:00", "cart", "s"), event("2024-01-01 10:00:00", "cart", "t"), event("2024-01-01 10:01:00", "purchase", "t")],
            [event("2024-01-01 12:00:00", "view", "x")],
            [event("2024-01-02 09:00:00", "cart", "s")],
        ],
    )

    def known():
        fired = clock.fired_triggers(stream(spark, folder))
        jobs.drain(jobs.start(fired, jobs.to_folder(str(tmp_path / "out")), str(tmp_path / "state")))
        # The clock is the second of the two stateful operators from the sink.
        store = spark.read.format("statestore").option("stateVarName", "clock").option("operatorId", 0)
        return {r.key.user_session for r in store.load(str(tmp_path / "state")).collect()}

    assert known() == {"s", "t"}
    write_files(tmp_path / "more", [[END], [END]])
    import os

    for i in range(2):
        os.rename(tmp_path / "more" / f"{i:03d}.json", tmp_path / "in" / f"9{i:02d}.json")
    assert known() == set()
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r.user_session, r.trigger) for r in rows) == [("s", "CART_PLUS_1_HOUR"), ("s", "CART_PLUS_5_MINUTES")]


class Calls:
    """Stands for a session's state and timers; counts the messages they would be."""

    def __init__(self):
        self.value, self.timers, self.calls, self.watermark, self.expiry = None, set(), 0, 0, 0

    def counted(self, result=None):
        self.calls += 1
        return result

    def getValueState(self, *_):  # noqa: N802
        return self

    def exists(self):
        return self.counted(self.value is not None)

    def get(self):
        return self.counted(self.value)

    def update(self, value):
        self.value = self.counted(value)

    def clear(self):
        self.value = self.counted()

    def listTimers(self):  # noqa: N802
        return self.counted(iter(sorted(self.timers)))

    def registerTimer(self, ms):  # noqa: N802
        self.counted(self.timers.add(ms))

    def deleteTimer(self, ms):  # noqa: N802
        self.counted(self.timers.discard(ms))

    def getCurrentWatermarkInMs(self):  # noqa: N802
        return self.watermark

    def getExpiryTimeInMs(self):  # noqa: N802
        return self.expiry

    def pass_to(self, machine, sec):
        """Event time moves on: what fires, and how often the clock woke."""
        self.watermark, found, woke = sec * 1000, [], 0
        for ms in sorted(t for t in self.timers if t < self.watermark):
            self.expiry, woke = ms, woke + 1
            found += [(r.trigger, r.fires_at_sec) for r in machine.handleExpiredTimer(("s",), self, self)]
            self.timers.discard(ms)
        return found, woke


@pytest.mark.parametrize("keep", [86_400, None])
def test_a_clock_sets_one_timer_and_wakes_once_for_all_that_has_passed(keep):
    from pyspark.sql import Row

    both = [("CART_PLUS_5_MINUTES", 1300), ("CART_PLUS_1_HOUR", 4600)]
    rows = [Row(event_type="cart", sec=sec, user_id=1) for sec in (1020, 1000)]
    for steps in ([(1300, [], 0), (1301, both[:1], 1), (4601, both[1:], 1), (200_000, [], 1)], [(200_000, both, 1)]):
        calls = Calls()
        machine = clock.Clock(keep)
        machine.init(calls)
        assert list(machine.handleInputRows(("s",), iter(rows), calls)) == []
        assert calls.calls == 3 and calls.timers == {1_300_001}
        for sec, fires, wakes in steps:
            before = calls.calls
            found, woke = calls.pass_to(machine, sec)
            assert found == fires and woke == (0 if keep is None and sec == 200_000 and not fires else wakes)
            assert calls.calls - before <= 3 * woke and len(calls.timers) <= 1
        assert calls.timers == set() and (calls.value is None) == (keep is not None)
