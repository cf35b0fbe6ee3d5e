"""A corpus from raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept, which
was written to the shared folder and read again. All but the last return the columns of
documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlake.llm import blocks, bpe, mixing, simhash, suffix, toxicity
from cartlake.session import stage


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the threshold of the toxicity score."""
    lexicon = toxicity.learn(docs, labels(spark, sf_dir))
    names = docs.columns
    whole = blocks.free_name(names, "_text")
    held = docs.withColumn(whole, F.col("text"))
    scored = toxicity.scores(held, lexicon, [c for c in names if c != "text"] + [whole])
    kept = scored.filter(F.col("score") < toxicity.THRESHOLD)
    return kept.select(*[F.col(f"row.{whole}").alias("text") if c == "text" else F.col(f"row.{c}") for c in names])


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each group of near-equal fingerprints; rows without id stay.

    Rows of one id but different texts are judged by their own groups; repeated rows go or stay together."""
    key = blocks.free_name(docs.columns, "_hash")
    hashed = docs.withColumn(key, F.xxhash64("text"))
    found = simhash.near_duplicates(hashed, keep=["doc_id", key])
    gone = found.filter("row.doc_id <> component_id").select("row.doc_id", f"row.{key}").distinct()
    return hashed.join(gone, ["doc_id", key], "left_anti").select(*docs.columns)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 50 bytes or more that an earlier document has.

    Bytes of a character that was cut in two go as well, and so do replacement characters. A document of which nothing is
    left goes; n_chars, if there, is counted again."""
    names = docs.columns
    done = suffix.dedup_passages(docs, keep=names).filter("n_removed = 0 or n_removed < n_bytes")
    kept = F.col("kept").cast("string")
    text = F.when(F.col("n_removed") > 0, F.regexp_replace(F.make_valid_utf8(kept), "\ufffd", "")).otherwise(kept)
    columns = {"text": text, "n_chars": F.when(F.col("n_removed") > 0, F.length(text)).otherwise(F.col("row.n_chars") if "n_chars" in names else None)}
    return done.select(*[columns[c].alias(c) if c in columns else F.col(f"row.{c}") for c in names])


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that the expected tokens of the domains meet the targets; the
    floor of one copy keeps every document, and half of all tokens is added at most."""
    return mixing.resampled(docs, labels(spark, sf_dir))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and the token ids as little-endian 32-bit integers."""
    keep = [c for c in ("doc_id", "lang", "source") if c in docs.columns]
    return bpe.encode(docs, keep=keep).select("row.*", "n_tokens", "ids")


STAGES = [
    ("toxicity", remove_toxic),
    ("simhash_near_dedup", one_of_near_copies),
    ("suffix_array_dedup", without_repeats),
    ("mixing", mix_to_targets),
    ("bpe_encoding", encode),
]

#: No SQL: the stages learn models and hash texts.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
