"""Session numbers for logs that have none."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sessionize(events: DataFrame, user: str, time: str, gap_hours: int) -> DataFrame:
    """Add ``session_no``: it grows by one after each pause longer than the gap.

    Time is cut into slots as long as the gap. Two events of one slot can never
    lie further apart than the gap, so a slot never spans two sessions and only
    (user, slot) rows need ordering - not the events, of which one user may have
    a third.
    """
    gap = gap_hours * 3600 * 1_000_000
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    slot = F.floor(micros / F.lit(gap)).cast("long")
    slots = (
        events.select(user, slot.alias("_slot"), micros.alias("_us"))
        .groupBy(user, "_slot")
        .agg(F.min("_us").alias("_first"), F.max("_us").alias("_last"))
    )
    by_user = Window.partitionBy(user).orderBy("_slot")
    starts = F.when(F.col("_first") - F.lag("_last").over(by_user) > gap, 1).otherwise(0)
    numbered = (
        slots.withColumn("_starts", starts)
        .withColumn("session_no", F.sum("_starts").over(by_user.rowsBetween(Window.unboundedPreceding, 0)))
        .select(user, "_slot", "session_no")
    )
    return events.withColumn("_slot", slot).join(numbered, [user, "_slot"]).drop("_slot")
