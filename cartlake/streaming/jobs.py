"""Starting, feeding and draining streaming queries."""

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartlake.operators import scoring, serving, triggers
from cartlake.operators.learning import Forests
from cartlake.operators.silver import silver_events, with_month
from cartlake.session import stage
from cartlake.sources import files, sinks
from cartlake.streaming import clock
from cartlake.streaming.views import LiveGold

Writer = Callable[[DataFrame, int], None]


def start(
    stream: DataFrame,
    write_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    every: str | None = None,
) -> StreamingQuery:
    """Run ``write_batch`` per micro-batch, at an interval or - without one -
    over everything available and then stop. A batch may run again after a
    failure, so writers must replace what an earlier try left."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write_batch)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def to_folder(path: str) -> Callable[[DataFrame, int], None]:
    """Each batch in a folder of its own, replaced when the batch runs again."""

    def write(batch: DataFrame, batch_id: int) -> None:
        sinks.append_batch(batch, path, batch_id)

    return write


def lake_writer(bronze_path: str, silver_path: str) -> Callable[[DataFrame, int], None]:
    """Land a batch of raw events: bronze as JSON lines, silver as Parquet by
    month, both idempotent per batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        sinks.write_json_lines(batch, f"{bronze_path}/batch_id={batch_id}", mode="overwrite")
        landed = batch.sparkSession.read.schema(batch.schema).json(f"{bronze_path}/batch_id={batch_id}")
        sinks.write_layer(
            with_month(silver_events(landed)), f"{silver_path}/batch_id={batch_id}", ["year", "month"]
        )

    return write


def live_writer(
    bronze_path: str, silver_path: str, views: LiveGold, *writers: Writer, ledger: str
) -> Callable[[DataFrame, int], None]:
    """``lake_writer`` that keeps gold up to date as well, and hands the changed carts to ``writers``.

    Silver is landed after gold and the buyers' seconds, so a trigger that its events fire finds
    both. The batch's silver is read from its bronze files, which a lost executor reads again."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folder = f"{bronze_path}/batch_id={batch_id}"

        def bronze(rows: DataFrame, _: int) -> None:
            sinks.write_json_lines(rows, folder, mode="overwrite")

        def gold(_: DataFrame, n: int) -> None:
            views.update(silver_events(spark.read.schema(batch.schema).json(folder)), n)

        def silver(_: DataFrame, n: int) -> None:
            landed = silver_events(spark.read.schema(batch.schema).json(folder))
            sinks.write_layer(with_month(landed), f"{silver_path}/batch_id={n}", ["year", "month"])

        def changed(writer: Writer) -> Writer:
            return lambda _, n: writer(views.gold.load([(0, n)]), n)

        steps = {"bronze": bronze, "gold": gold, "silver": silver}
        steps |= {f"sink-{i}": changed(w) for i, w in enumerate(writers)}
        each_once(ledger, steps)(batch, batch_id)

    return write


def action_writer(
    silver_path: str, fired_path: str, actions_path: str, views: LiveGold | None = None, forests: Forests | None = None
) -> Callable[[DataFrame, int], None]:
    """Turn a batch of fired triggers into reminders and decisions. The batch is
    written first: reading it twice would run its stateful operators twice. With ``views`` silver
    is read for the time of the fired sessions only; ``forests`` need them for the history."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        sinks.append_batch(batch, fired_path, batch_id)
        fired = spark.read.schema(batch.schema).parquet(f"{fired_path}/batch_id={batch_id}")
        if fired.isEmpty():
            return
        silver = spark.read.parquet(silver_path)
        sinks.append_batch(act(fired, silver, views, forests), actions_path, batch_id)

    return write


def between(silver: DataFrame, first: int, last: int) -> DataFrame:
    """Events of a stretch of time. Months are named too where they are folders, so others are
    not even listed as files to read."""
    when = F.col("event_time_ts")
    rows = silver.where((when >= F.timestamp_seconds(F.lit(first))) & (when <= F.timestamp_seconds(F.lit(last))))
    if {"year", "month"} <= set(silver.columns):
        months = [t.year * 12 + t.month for t in (datetime.fromtimestamp(s, UTC) for s in (first, last))]
        rows = rows.where((F.col("year") * 12 + F.col("month")).between(*months))
    return rows


def act(
    fired: DataFrame, silver: DataFrame, views: LiveGold | None = None, forests: Forests | None = None
) -> DataFrame:
    """The actions of fired triggers. The features of a decision come from the silver table: only
    sessions that fired, and only events up to the last deadline, get as far as the clocks. With
    ``views`` the first of their events is known as well, so silver is read from there on."""
    sessions = fired.select("user_session").distinct()
    first = views.first_seconds(sessions).agg(F.min("first_sec")).scalar() if views else F.lit(0)
    span = fired.agg(F.max("fires_at_sec").alias("last")).select("last", first.alias("first")).first()
    seen = between(silver, span["first"] or 0, span["last"])
    rows = triggers.clocks(seen.join(sessions, "user_session", "left_semi")).drop("user_id")
    timed = rows.join(fired.select("user_session", "user_id", "trigger", "fires_at_sec"), "user_session")
    if forests is None:
        return triggers.actions(timed)
    timed = stage(timed, "timed")
    return triggers.actions(timed, views.seconds_of(timed), forests)


def serving_writer(path: str) -> Callable[[DataFrame, int], None]:
    """Load a batch of scored carts into the two serving tables."""

    def write(batch: DataFrame, batch_id: int) -> None:
        sinks.append_batch(serving.serving_session_features(batch), f"{path}/session_features", batch_id)
        sinks.append_batch(serving.serving_prescriptions(batch), f"{path}/cart_coupons_prescribed", batch_id)

    return write


def scored(write: Writer) -> Writer:
    """Gives a writer of scored carts the carts of gold with their risk and offer."""
    return lambda carts, batch_id: write(scoring.score(carts), batch_id)


def recent_writer(path: str, n: int = 60) -> Callable[[DataFrame, int], None]:
    """Keep the newest ``n`` carts: those of the batch, then those kept before.
    Only earlier batches are read, so a batch that runs again gives the same list."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        new = batch.orderBy(F.desc("last_cart_sec"), "user_session").limit(n).withColumn("is_new", F.lit(True))
        if batch_id > 0:
            kept = spark.read.schema(new.schema).parquet(f"{path}/batch_id={batch_id - 1}")
            # A cart that has changed is shown as it is now.
            kept = kept.join(batch.select("user_session"), "user_session", "left_anti")
            new = new.unionByName(kept.withColumn("is_new", F.lit(False)))
        newest = new.orderBy(F.desc("is_new"), F.desc("last_cart_sec"), "user_session").limit(n)
        sinks.append_batch(newest, path, batch_id)

    return write


def each_once(ledger: str, steps: dict[str, Writer]) -> Writer:
    """Run the named steps of a batch in order, each once: a step that is done leaves a mark
    (batch, step), and a batch that runs again after a failure takes up at the first without one.

    A step that fails half-way runs again in full, so each must replace what it left."""

    def write(batch: DataFrame, batch_id: int) -> None:
        for name, step in steps.items():
            mark = f"{ledger}/batch_id={batch_id}/{name}"
            if not files.exists(batch.sparkSession, mark):
                step(batch, batch_id)
                files.put_mark(batch.sparkSession, mark)

    return write


def fan_out(path: str, *writers: Writer, ledger: str | None = None) -> Callable[[DataFrame, int], None]:
    """Give one micro-batch to several writers. It is written once and each reads the files:
    a lost executor must not run its stateful operators again. A batch that runs again goes only
    to the writers that have not had it."""

    def held(writer: Writer) -> Writer:
        return lambda b, n: writer(b.sparkSession.read.schema(b.schema).parquet(f"{path}/batch_id={n}"), n)

    steps = {"held": lambda batch, n: sinks.append_batch(batch, path, n)}
    steps |= {f"sink-{i}": held(w) for i, w in enumerate(writers)}
    return each_once(ledger or f"{path}-ledger", steps)


def drain(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def run_triggers(spark: SparkSession, silver: DataFrame, out: str, checkpoint: str) -> DataFrame:
    drain(start(clock.fired_triggers(silver), to_folder(out), checkpoint))
    return spark.read.parquet(out)


def run_totals(spark: SparkSession, totals: DataFrame, out: str, checkpoint: str) -> DataFrame:
    """Drain a complete-mode aggregation; the last batch holds the totals."""
    drain(start(totals, to_folder(out), checkpoint, mode="complete"))
    batches = spark.read.parquet(out)
    last = batches.agg(F.max("batch_id")).scalar()
    return batches.where(F.col("batch_id") == last).drop("batch_id")
