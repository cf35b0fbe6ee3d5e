"""Registered queries that run as streams over the given tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlake.plans.layers import Layers
from cartlake.schemas import GOLD_COLUMNS
from cartlake.session import new_path, stage, write_stage
from cartlake.streaming import jobs, totals
from cartlake.streaming.views import LiveGold


def as_stream(table: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """A table written once, as a table and as a stream of its files."""
    path = write_stage(table, label)
    spark = table.sparkSession
    return (
        spark.read.schema(table.schema).parquet(path),
        spark.readStream.schema(table.schema).parquet(path),
    )


def stream_trigger_chain(x: Layers) -> DataFrame:
    """The reminders as they fire up to the last watermark."""
    silver, stream = as_stream(x.silver, "silver")
    fired = jobs.run_triggers(x.spark, stream, new_path(x.spark, "fired"), new_path(x.spark, "fired-state"))
    return jobs.act(fired, silver)


def stream_gold(x: Layers) -> DataFrame:
    """Gold kept up to date over three micro-batches that split every session's events."""
    path, state = new_path(x.spark, "silver-parts"), new_path(x.spark, "live-state")
    silver = stage(x.silver, "silver")
    views = LiveGold(x.spark, new_path(x.spark, "live"), silver.schema, buckets=4, fan=2)
    for part in range(3):
        # What has arrived since the last run is one micro-batch, in as many files as tasks wrote it.
        silver.where(F.pmod("event_id", F.lit(3)) == part).write.mode("append").parquet(path)
        jobs.drain(jobs.start(x.spark.readStream.schema(silver.schema).parquet(path), views.update, state))
    return views.read().select(*GOLD_COLUMNS)


def stream_funnel_daily(x: Layers) -> DataFrame:
    _, stream = as_stream(x.silver, "silver")
    counts = totals.daily_funnel(stream)
    return jobs.run_totals(x.spark, counts, new_path(x.spark, "funnel"), new_path(x.spark, "funnel-state"))


def stream_kpis(x: Layers) -> DataFrame:
    _, stream = as_stream(x.logistic, "scored")
    running = totals.running_kpis(stream)
    return jobs.run_totals(x.spark, running, new_path(x.spark, "kpis"), new_path(x.spark, "kpis-state"))
