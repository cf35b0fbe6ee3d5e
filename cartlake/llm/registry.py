"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cartlake.llm import bpe, chat, hnsw, license, mixing, multiset, periodic, quality, repair, simhash, suffix, toxicity, urls


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_chat_formatting": lambda s, d: chat.render(table(s, d, "conversations")),
        "op2_suffix_array_dedup": lambda s, d: suffix.digest(table(s, d, "documents")),
        "op3_toxicity": lambda s, d: toxicity.digest(table(s, d, "documents"), table(s, d, "labels")),
        "op4_simhash_near_dedup": lambda s, d: simhash.digest(table(s, d, "documents")),
        "op5_document_fingerprints": lambda s, d: multiset.edits(table(s, d, "documents")),
        "op6_source_mixing": lambda s, d: mixing.mixed(table(s, d, "documents"), table(s, d, "labels")),
        "op7_byte_bpe": lambda s, d: bpe.digest(table(s, d, "documents")),
        "op8_license_scan": lambda s, d: license.scan(table(s, d, "documents")),
        "op9_url_filter": lambda s, d: urls.judge(table(s, d, "pages"), urls.fixed_rules(s)),
        "op10_nearest_neighbours": lambda s, d: hnsw.digest(table(s, d, "embeddings")),
        "op11_conversation_repair": lambda s, d: repair.repaired(table(s, d, "conversations")),
        "op12_quality_classifier": lambda s, d: quality.digest(table(s, d, "documents"), table(s, d, "labels")),
        "op13_periodic_runs": lambda s, d: periodic.digest(table(s, d, "documents")),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_chat_formatting": chat.SQL,
        "op8_license_scan": license.SQL,
        "op9_url_filter": urls.SQL,
    }
