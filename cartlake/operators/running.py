"""Running totals and exact quantiles that no single hot key can stall."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartlake.session import stage


def running_totals(
    rows: DataFrame,
    partition: list[str],
    chunk: Column,
    order: list[str],
    sums: dict[str, str],
    firsts: dict[str, str] | None = None,
    totals: dict[str, str] | None = None,
) -> DataFrame:
    """For each row, the totals of all rows *before* it, per ``partition``.

    ``sums`` maps a new column to the long column it totals, ``totals`` maps one
    to the entry of ``sums`` whose total over the whole partition it repeats, and
    ``firsts`` maps one to the leading order column whose first value it repeats.
    ``chunk`` must not decrease along ``order``. A plain window would sort a whole partition key in
    one task; here the rows are sorted per (key, chunk), and only one row per
    chunk is ordered per key. The caller picks chunks so that both stay small.
    Partition columns and ``chunk`` must not be null.
    """
    firsts, totals = firsts or {}, totals or {}
    keyed = rows.withColumn("_chunk", chunk)
    keys = [*partition, "_chunk"]
    chunk_totals = keyed.groupBy(*keys).agg(
        *[F.sum(source).alias(f"_{name}") for name, source in sums.items()],
        *[F.min(source).alias(name) for name, source in firsts.items()],
    )
    by_chunk = Window.partitionBy(*partition).orderBy("_chunk")
    earlier_chunks = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
    chunks_so_far = by_chunk.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = chunk_totals.select(
        *keys,
        *[
            F.coalesce(F.sum(f"_{name}").over(earlier_chunks), F.lit(0)).alias(f"_{name}")
            for name in sums
        ],
        *[F.min(name).over(chunks_so_far).alias(name) for name in firsts],
        *[
            F.sum(f"_{source}").over(Window.partitionBy(*partition)).alias(name)
            for name, source in totals.items()
        ],
    )
    earlier_rows = (
        Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = keyed.select(
        "*",
        *[
            F.coalesce(F.sum(source).over(earlier_rows), F.lit(0)).alias(name)
            for name, source in sums.items()
        ],
    )
    columns = [
        (F.col(name) + F.col(f"_{name}")).cast("long").alias(name)
        if name in sums
        else F.col(name)
        for name in inside.columns
        if name != "_chunk"
    ]
    return inside.join(offsets, keys).select(*columns, *firsts, *totals)


def range_totals(
    rows: DataFrame, order: list[str], sums: dict[str, str], totals: dict[str, str] | None = None
) -> DataFrame:
    """``running_totals`` over a whole table in ``order``, in chunks of about equal numbers of rows.

    Spark samples the bounds of the chunks from the rows; a second pass totals inside each. The
    rows are written once between the passes, so both see the same bounds. Rows equal in
    ``order`` must be merged before: they fall into one chunk."""
    dealt = stage(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    return running_totals(dealt, [], F.col("_range"), order, sums, totals=totals).drop("_range")


# Width of a value chunk: 2^16 values are ordered in a task, and long values up
# to 2^32 give at most 2^16 chunks to order.
CHUNK_BITS = 16


def exact_quantiles(
    df: DataFrame, value: Column, shares: list[float], by: list[str] | None = None
) -> DataFrame:
    """``q0, q1, ...`` per group: linearly interpolated quantiles of a long.

    Equal to ``percentile``, which would hold every distinct value of a group in
    one task's memory. Scaled decimals (cents, hundredths of an hour) count as
    longs. Nulls are ignored.
    """
    by = by or []
    values = df.select(*by, value.cast("long").alias("value")).where("value is not null")
    counts = values.groupBy(*by, "value").agg(F.count(F.lit(1)).alias("n"))
    ranked = running_totals(
        counts,
        by,
        F.shiftright("value", CHUNK_BITS),
        ["value"],
        sums={"before": "n"},
        totals={"total": "before"},
    )
    picks = []
    for i, share in enumerate(shares):
        rank = (F.col("total") - 1) * F.lit(float(share))
        for side, position in (("lo", F.floor(rank)), ("hi", F.ceil(rank))):
            holds = (F.col("before") <= position) & (position < F.col("before") + F.col("n"))
            picks.append(F.max(F.when(holds, F.col("value"))).alias(f"{side}{i}"))
        picks.append(F.max(rank - F.floor(rank)).alias(f"part{i}"))
    found = ranked.groupBy(*by).agg(*picks)
    return found.select(
        *by,
        *[
            (
                F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * F.col(f"part{i}")
            ).alias(f"q{i}")
            for i in range(len(shares))
        ],
    )


# Up to so many rows a top-k is kept in each task's memory; beyond it rows are ranked by ranges.
TOP_ROWS = 10_000


def ranked_between(df: DataFrame, order: list[Column], start: int, stop: int, top_rows: int = TOP_ROWS) -> DataFrame:
    """The rows ``start`` to ``stop - 1`` of a total order, in any order.

    A top-k keeps ``stop`` rows in each task and then in one. Where these are more than
    ``top_rows``, the rows are dealt by ranges of the order and written, the ranges are
    counted (one row each), and only those that hold wanted rows are sorted.
    """
    if stop <= top_rows:
        return df.orderBy(*order).offset(start).limit(stop - start)
    dealt = stage(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy().orderBy("_range")) - F.col("_n")
    wanted = sizes.withColumn("_before", before).where(
        (F.col("_before") < stop) & (F.col("_before") + F.col("_n") > start)
    )
    rank = F.col("_before") + F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    held = dealt.join(F.broadcast(wanted.select("_range", "_before")), "_range").withColumn("_rank", rank)
    return held.where((F.col("_rank") >= start) & (F.col("_rank") < stop)).select(*df.columns)
