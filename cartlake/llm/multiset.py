"""Fingerprints of documents that do not depend on the order of paragraphs.

A paragraph is the shortest piece that ends at a line break, or at a full stop, comma,
exclamation or question mark before a blank. Each is hashed to a wide vector of ``DIMENSIONS`` bits, and a
document's fingerprint is the number of its paragraphs and the sum of their vectors; it is
written with each component modulo 2^16. Adding or taking away a paragraph is an addition or subtraction of
its vector (``combined``), so equal multisets have equal fingerprints, in any order.

Sums of -1 and 1 (two bits minus the count) also measure likeness: the product of two
fingerprints is, on average, ``DIMENSIONS`` times the number of common paragraphs, so twice
the product over the two squared lengths estimates the common share of paragraphs.

While summing, two components share a 64-bit number, 32 bits each, which is more than the
paragraphs that an array can hold, so no sum wraps. All of it is SQL functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEEDS = (11, 12)
DIMENSIONS = 64 * len(SEEDS)
LANES = 32
LANE_MASK = 1 | 1 << 32
COMPONENT, MODULUS = (1 << 32) - 1, 1 << 16
BREAK = r"\n+|(?<=[.,!?])[ \t\r]+"


def vector(text: Column) -> Column:
    """The hashes of a text's paragraphs for each seed, and their count."""
    def hashed(seed: int) -> Column:
        return F.transform(parts, lambda p: F.xxhash64(F.lit(seed), p))

    parts = F.filter(F.split(text, BREAK), lambda p: p != "")
    hashes = [hashed(seed) for seed in SEEDS]
    return F.struct(F.size(parts).alias("n"), *[h.alias(f"h{i}") for i, h in enumerate(hashes)])


def summed(hashes: Column) -> Column:
    """The sums of the hashes' bits, two to a number: lane j holds those of bits j and j + 32."""
    def lane(j: int) -> Column:
        return F.aggregate(
            hashes, F.lit(0).cast("long"), lambda total, h: total + F.shiftrightunsigned(h, j).bitwiseAND(F.lit(LANE_MASK))
        )

    return F.array(*[lane(j) for j in range(LANES)])


def components(lanes: Column) -> Column:
    """64 components, whole, out of the lanes."""

    def half(shift: int) -> Column:
        return F.transform(lanes, lambda v: F.shiftrightunsigned(v, shift).bitwiseAND(F.lit(COMPONENT)).cast("int"))

    return F.concat(half(0), half(32))


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds ``name``: struct (n, v) of the text's fingerprint; null texts are empty."""
    done = df.withColumn("_hashed", vector(F.coalesce(F.col(text), F.lit(""))))
    for i in range(len(SEEDS)):
        done = done.withColumn(f"_l{i}", summed(F.col(f"_hashed.h{i}")))
    parts = F.concat(*[components(F.col(f"_l{i}")) for i in range(len(SEEDS))])
    done = done.withColumn(name, F.struct(F.col("_hashed.n").alias("n"), parts.alias("v")))
    return done.drop("_hashed", *[f"_l{i}" for i in range(len(SEEDS))])


def combined(a: Column, b: Column, sign: int = 1) -> Column:
    """The fingerprint of two multisets together (sign 1), or of a without b (sign -1)."""
    return F.struct(
        (a["n"] + sign * b["n"]).alias("n"),
        F.zip_with(a["v"], b["v"], lambda x, y: x + sign * y).alias("v"),
    )


def as_text(print_: Column) -> Column:
    """The number of paragraphs, then every component modulo 2^16 as four hex digits."""
    digits = F.transform(print_["v"], lambda x: F.lpad(F.lower(F.hex(F.pmod(x, F.lit(MODULUS)))), 4, "0"))
    return F.concat(F.hex(print_["n"]), F.lit(":"), F.array_join(digits, ""))


def likeness(a: Column, b: Column) -> Column:
    """From 0 to 1: 1 for equal fingerprints, else the estimated share of common paragraphs."""

    def centred(x: Column, n: Column) -> Column:
        return 2 * x.cast("double") - n

    def product(p: Column, q: Column) -> Column:
        both = F.zip_with(p["v"], q["v"], lambda x, y: centred(x, p["n"]) * centred(y, q["n"]))
        return F.aggregate(both, F.lit(0.0), lambda total, x: total + x)

    lengths = product(a, a) + product(b, b)
    shared = F.when(lengths > 0, 2 * product(a, b) / lengths).otherwise(0.0)
    return F.when((a["n"] == b["n"]) & (a["v"] == b["v"]), 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), shared)))


def range_of(value: Column, cuts: list[int]) -> Column:
    """How many of the sorted cuts are below the value, by bisection; -1 for a null."""
    table = F.expr(f"array({', '.join(f'{c}L' for c in cuts)})") if cuts else None
    if table is None:
        return F.when(value.isNull(), -1).otherwise(0)

    def halve(state: Column, _: Column) -> Column:
        middle = F.shiftright(state["low"] + state["high"], 1)
        beyond = F.coalesce(F.get(table, middle) < value, F.lit(False))
        step = F.struct(
            F.when(beyond, middle + 1).otherwise(state["low"]).alias("low"),
            F.when(beyond, state["high"]).otherwise(middle).alias("high"),
        )
        return F.when(state["low"] < state["high"], step).otherwise(state)

    start = F.struct(F.lit(0).alias("low"), F.lit(len(cuts)).alias("high"))
    steps = F.sequence(F.lit(1), F.lit(len(cuts).bit_length() + 1))
    return F.when(value.isNull(), -1).otherwise(F.aggregate(steps, start, halve, lambda state: state["low"]))


def first_of_next_range(texts: DataFrame) -> DataFrame:
    """(range, text): for each range the text that follows its last document. Only the first
    document of each range is read for it, one row per range."""
    tops = texts.groupBy("range").agg(F.max("doc_id").alias("doc_id")).collect()
    order = sorted((r["range"] for r in tops), reverse=True)
    follows = [(b, a) for a, b in zip(order, order[1:] + order[:1])]
    spark = texts.sparkSession
    top = spark.createDataFrame([(r["range"], r["doc_id"]) for r in tops], "range int, doc_id long").alias("top")
    same = F.expr("texts.range = top.range AND texts.doc_id <=> top.doc_id")
    first = texts.alias("texts").join(F.broadcast(top), same).groupBy("texts.range").agg(F.min("text").alias("text"))
    follows = spark.createDataFrame(follows, "range int, before int")
    return first.join(F.broadcast(follows), "range").select(F.col("before").alias("range"), "text")


def edits(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.

    The edited text has the first floor(n_chars / 2) code points, or all, of the next
    document in place of as many at its end. Documents stand in descending order of
    doc_id, rows without one last, rows with one id by text; after the last comes the
    first. Null texts are empty. A single document is its own next. An empty table gives
    an empty result. Other columns are not read.

    Ids are dealt by ranges with as many documents each, so texts move once; each range
    also gets the first text of the one that follows.
    """
    ranges = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = [i / ranges for i in range(1, ranges)]
    cuts = docs.select(F.percentile_approx(F.col("doc_id").cast("long"), share, 100_000)).first()[0] or []
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).withColumn("range", range_of(F.col("doc_id"), sorted(set(cuts))))
    after = first_of_next_range(texts).select(F.lit(None).cast("long").alias("doc_id"), "text", "range", F.lit(1).alias("extra"))
    every = with_fingerprint(texts.withColumn("extra", F.lit(0)).unionByName(after), "text", "print")
    line = Window.partitionBy("range").orderBy("extra", F.desc_nulls_last("doc_id"), "text")
    follows = every.withColumn("next", F.lead(F.struct("text", "print")).over(line)).filter("extra = 0")
    joined = follows.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), "print", F.col("next.print").alias("next_print"),
        F.expr("concat(left(text, length(text) - length(text) div 2), left(next.text, int(length(text) div 2)))").alias("edited"),
    )
    done = with_fingerprint(joined, "edited", "edited_print")
    return done.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("print")).alias("fingerprint"), as_text(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("print"), F.col("next_print")).alias("near_next"),
    )
