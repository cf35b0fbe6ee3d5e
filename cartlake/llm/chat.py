"""Logged conversations collapsed to the longest of each line, then rendered.

Chat logs often hold a snapshot after every turn. A conversation is dropped if its steps
are the first steps of a longer one, or equal those of one with a smaller id.

A step is a turn number of a conversation; rows that repeat exactly count once, and
different rows under one number form one step, in the order (role, text). A step's hash
is taken with its place, so the hash of the first n steps is the running sum of step
hashes: it rolls forward by one addition, and can be summed in two levels. No task holds
a whole conversation until it is rendered, and then no more than ``PART`` steps of it.
Two pairs of 64-bit hashes tell prefixes apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartlake.session import stage

PART = 1024
#: The bucket of rows without a turn number.
LAST = 1 << 60
LIMBS = ("h0", "h1", "h2", "h3")


def turn_hash(seed: int) -> Column:
    parts = [F.lit(seed)]
    for name in ("role", "text"):
        parts += [F.col(name).isNull(), F.coalesce(F.col(name), F.lit(""))]
    return F.xxhash64(*parts)


def limbs(seed: int, *columns: Column) -> list[Column]:
    """A 64-bit hash in two halves, whose sums cannot overflow."""
    whole = F.xxhash64(F.lit(seed), *columns)
    return [F.shiftrightunsigned(whole, 32), whole.bitwiseAND(F.lit(0xFFFFFFFF))]


def steps(conversations: DataFrame) -> DataFrame:
    """(conv_id, bucket, place, n_steps, h0..h3): every step with the hash of the steps up to it."""
    rows = (
        conversations.filter("conv_id is not null").select("conv_id", "turn", "role", "text")
        .withColumn("a", turn_hash(1)).withColumn("b", turn_hash(2))
        .select("conv_id", "turn", "a", "b").distinct()
    )
    halves = [F.shiftrightunsigned("a", 32), F.col("a").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("b", 32), F.col("b").bitwiseAND(F.lit(0xFFFFFFFF))]
    step = rows.groupBy("conv_id", "turn").agg(*[F.sum(h).alias(f"t{i}") for i, h in enumerate(halves)])
    step = step.withColumn("bucket", F.coalesce(F.floor(F.col("turn") / PART), F.lit(LAST)))
    inner = Window.partitionBy("conv_id", "bucket").orderBy(F.asc_nulls_last("turn"))
    step = step.withColumn("inner", F.row_number().over(inner))
    sizes = step.groupBy("conv_id", "bucket").agg(F.count("*").alias("size"))
    across = Window.partitionBy("conv_id").orderBy("bucket")
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        "conv_id", "bucket", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"),
        F.sum("size").over(Window.partitionBy("conv_id")).alias("n_steps"),
    )
    placed = step.join(sizes, ["conv_id", "bucket"]).select(
        "conv_id", "bucket", "turn", (F.col("before") + F.col("inner")).alias("place"), "n_steps",
        *[f"t{i}" for i in range(4)],
    )
    with_place = [F.col("place"), *[F.col(f"t{i}") for i in range(4)]]
    hashed = placed.select(
        "conv_id", "bucket", "turn", "place", "n_steps",
        *[h.alias(n) for n, h in zip(LIMBS, limbs(3, *with_place) + limbs(4, *with_place))],
    )
    hashed = stage(hashed, "chat-steps")
    running = Window.partitionBy("conv_id", "bucket").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    sums = hashed.groupBy("conv_id", "bucket").agg(*[F.sum(n).alias(n) for n in LIMBS])
    sums = sums.select("conv_id", "bucket", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"{n}_before") for n in LIMBS])
    rolled = hashed.select("conv_id", "bucket", "turn", "place", "n_steps", *[F.sum(n).over(running).alias(n) for n in LIMBS])
    return rolled.join(sums, ["conv_id", "bucket"]).select(
        "conv_id", "bucket", "turn", "place", "n_steps", *[(F.col(n) + F.col(f"{n}_before")).alias(n) for n in LIMBS]
    )


def maximal(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations to keep (conv_id, n_steps), and all steps."""
    all_steps = stage(steps(conversations), "chat-prefixes")
    whole = all_steps.filter("place = n_steps").groupBy("place", *LIMBS).agg(F.min("conv_id").alias("conv_id"))
    prefixes = all_steps.filter("place < n_steps").select("place", *LIMBS).distinct()
    kept = whole.join(prefixes, ["place", *LIMBS], "left_anti")
    return kept.select("conv_id", F.col("place").alias("n_steps")), all_steps


def render(conversations: DataFrame, opening: str = "<|", closing: str = "|>", part: int = PART) -> DataFrame:
    """The kept conversations: conv_id, part, n_steps, n_turns, rendered.

    A turn is "<|role|>", a line break, its text and a line break; null roles and texts are
    empty. A conversation of over ``part`` steps is rendered in parts 0, 1, ..., which
    follow each other. Rows without conv_id are dropped; rows without a turn number form
    one step at the end. Exact repeats of a row count once. An empty table gives an empty
    result. Other columns are not read.
    """
    kept, all_steps = maximal(conversations)
    places = all_steps.join(kept.select("conv_id"), "conv_id", "left_semi").select(
        "conv_id", "turn", "n_steps", "place", F.floor((F.col("place") - 1) / part).cast("int").alias("part")
    )
    rows = conversations.select("conv_id", "turn", "role", "text").distinct().alias("rows")
    same = F.expr("rows.conv_id = places.conv_id AND rows.turn <=> places.turn")
    joined = rows.join(places.alias("places"), same).select(
        "rows.conv_id", "part", "n_steps",
        F.struct(
            "place", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
        ).alias("said"),
    )
    turns = F.array_sort(F.collect_list("said"))
    lines = F.transform(turns, lambda t: F.concat(F.lit(opening), t["role"], F.lit(f"{closing}\n"), t["text"], F.lit("\n")))
    return joined.groupBy("conv_id", "part", "n_steps").agg(
        F.count("*").alias("n_turns"), F.array_join(lines, "").alias("rendered")
    )


#: The same rows from DuckDB, comparing the turns themselves; turn numbers are not null there.
SQL = """
WITH rows AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
step AS (
  SELECT conv_id, turn, list({'role': role, 'text': text} ORDER BY coalesce(role, ''), coalesce(text, '')) AS said
  FROM rows GROUP BY ALL),
conv AS (SELECT conv_id, count(*) AS n, list(said ORDER BY turn) AS steps FROM step GROUP BY ALL),
prefix AS (SELECT DISTINCT steps[1:k] AS steps FROM (SELECT steps, unnest(range(1, n)) AS k FROM conv)),
kept AS (
  SELECT min(conv_id) AS conv_id, n FROM conv
  WHERE steps NOT IN (SELECT steps FROM prefix) GROUP BY steps, n)
SELECT r.conv_id, CAST(0 AS INTEGER) AS part, CAST(k.n AS BIGINT) AS n_steps, count(*) AS n_turns,
  string_agg('<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || chr(10), ''
             ORDER BY turn, coalesce(role, ''), coalesce(text, '')) AS rendered
FROM rows r JOIN kept k USING (conv_id) GROUP BY r.conv_id, k.n
"""
