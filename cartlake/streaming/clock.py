"""The reminder clock of a session as a streaming state.

Spark hands each session its new cart and purchase events, and calls again when
event time passes one of its timers. The state holds times rather than flags, as
a late cart event can still move the start of the clock.
"""

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from cartlake.functions.events import CART, PURCHASE
from cartlake.operators.triggers import ONE_HOUR, TRIGGERS

LATENESS = "10 minutes"
# A finished clock stays known for so long, so that later carts of the same
# session do not start a second one. None: for good, as the batch form has it, at
# the price of a state that grows with the number of sessions.
KEEP_SECONDS = 86_400

FIRED_SCHEMA = "user_session string, user_id long, trigger string, t0 long, fires_at_sec long"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_SCHEMA = "t0 long, owner long, purchases array<long>, done_sec long, last_sec long"


def merge_events(t0, owner, purchases, last_sec, rows: Iterator[Row]):
    """Take a session's new events into its clock."""
    bought = set(purchases)
    for row in rows:
        last_sec = max(last_sec, row.sec)
        if row.event_type == PURCHASE:
            bought.add(row.sec)
        elif t0 is None or row.sec < t0:
            t0, owner = row.sec, row.user_id
    return t0, owner, sorted(bought), last_sec


def needed_purchases(t0, purchases, watermark_sec):
    """Drop the purchases no clock can need: those before the start, unless a late
    cart may still move it, and all but the first since the start."""
    if t0 is None:
        return [p for p in purchases if p > watermark_sec]
    since = [p for p in purchases if p >= t0]
    return [p for p in purchases if watermark_sec < p < t0] + since[:1]


class Clock(StatefulProcessor):
    """One session's clock: a value with its times, and one timer, for the next time at which
    there is something to do. Spark wakes it when event time has passed the timer.

    Each call to the state is a message between Python and the JVM, and these set the time of a
    batch. So a clock that wakes takes all deadlines that event time has passed, and sets its
    timer anew only where one lies ahead."""

    def __init__(self, keep_seconds: int | None):
        self.keep_seconds = keep_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("clock", STATE_SCHEMA)

    def close(self) -> None:
        pass

    def next_wake(self, t0, purchases, done_sec, last_sec) -> int | None:
        """The millisecond at which this clock has to wake: just after a deadline, not at it.
        None: never again."""
        if t0 is None:
            end = max(purchases, default=last_sec)
        elif ahead := [d for d in TRIGGERS if d > done_sec]:
            end = t0 + min(ahead)
        elif self.keep_seconds is None:
            return None
        else:
            end = max(t0 + ONE_HOUR, last_sec) + self.keep_seconds
        return end * 1000 + 1

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        before = None
        t0, owner, purchases, done_sec, last_sec = None, None, [], 0, 0
        if self.state.exists():
            t0, owner, purchases, done_sec, last_sec = self.state.get()
            purchases = purchases or []
            before = self.next_wake(t0, purchases, done_sec, last_sec)
        t0, owner, purchases, last_sec = merge_events(t0, owner, purchases, last_sec, rows)
        watermark_sec = timerValues.getCurrentWatermarkInMs() // 1000
        needed = needed_purchases(t0, purchases, watermark_sec) if done_sec < ONE_HOUR else []
        self.state.update((t0, owner, needed, done_sec, last_sec))
        after = self.next_wake(t0, needed, done_sec, last_sec)
        if before != after:
            if before is not None:
                self.handle.deleteTimer(before)
            if after is not None:
                self.handle.registerTimer(after)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        held = self.state.get()
        if held is None:
            return
        t0, owner, purchases, done_sec, last_sec = held
        purchases = purchases or []
        now = expiredTimerInfo.getExpiryTimeInMs()
        passed = max(now, timerValues.getCurrentWatermarkInMs() - 1)
        while (wake := self.next_wake(t0, purchases, done_sec, last_sec)) is not None and wake <= passed:
            if t0 is None or done_sec >= ONE_HOUR:
                self.state.clear()
                return
            delay = min(d for d in TRIGGERS if d > done_sec)
            done_sec = delay
            if not any(t0 <= p <= t0 + delay for p in purchases):
                yield Row(user_session=key[0], user_id=owner, trigger=TRIGGERS[delay], t0=t0, fires_at_sec=t0 + delay)
        self.state.update((t0, owner, purchases if done_sec < ONE_HOUR else [], done_sec, last_sec))
        if wake is not None:
            self.handle.registerTimer(wake)


def use_rocksdb(spark: SparkSession) -> None:
    """Timers need the state store on disk; it also keeps many sessions out of the heap."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def fired_triggers(
    silver: DataFrame, lateness: str = LATENESS, keep_seconds: int | None = KEEP_SECONDS
) -> DataFrame:
    """The triggers that fire on a stream of silver events.

    Every event moves event time on, views too, so a reminder is not held back
    until somebody fills a cart. Hence the filter follows the watermark and names
    the event time, or the optimizer would push it below.

    Repeats of a session's event within one second are dropped first. That
    spreads a session with very many events over many tasks and leaves its clock
    at most one event per second and type. ``keep_seconds``: how long a finished
    session is remembered; None for good.
    """

    use_rocksdb(silver.sparkSession)
    counts = F.when(F.col("event_time_ts").isNotNull(), F.col("event_type").isin(CART, PURCHASE))
    steps = (
        silver.select(
            "user_session",
            "user_id",
            "event_type",
            "event_time_ts",
            F.unix_seconds("event_time_ts").alias("sec"),
        )
        .withWatermark("event_time_ts", lateness)
        .where(counts)
        .dropDuplicatesWithinWatermark(["user_session", "event_type", "sec"])
    )
    return steps.groupBy("user_session").transformWithState(
        Clock(keep_seconds), FIRED_SCHEMA, outputMode="append", timeMode="eventTime"
    )
