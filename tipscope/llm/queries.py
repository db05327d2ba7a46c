"""Registered queries of the corpus operators, and their SQL."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tipscope.llm import (
    cuckoo, hard_negatives, jaccard, langid, maxscore, mixing, packing, periodic, quality, token_counts, token_files,
    url_filter, warc,
)
from tipscope.llm.oracle import ORACLE_SQL
from tipscope.llm.tables import table
from tipscope.session import configure

__all__ = ["ORACLE_SQL", "QUERIES"]


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.Mix(table(configure(spark), sf_dir, "documents")).stream()


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(configure(spark), sf_dir, "pages"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(configure(spark), sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, _ = warc.write_archives(table(configure(spark), sf_dir, "pages"), min_revisit_bytes=0)
    records = warc.read_archives(spark, folder, payload="check").where("record_type IN ('response', 'revisit')")  # pushed to the reader
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload_ok")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pieces(table(configure(spark), sf_dir, "documents"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(configure(spark), sf_dir, "documents")
    return jaccard.near_duplicate_components(docs, width=4, threshold=85)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cuckoo.duplicate_groups(table(configure(spark), sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(configure(spark), sf_dir, "documents"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.write_token_files(table(configure(spark), sf_dir, "documents"))
    return token_files.read_documents(manifest)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_of(table(configure(spark), sf_dir, "documents"))


def op11_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxscore.top_k(table(configure(spark), sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    turned = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(configure(spark), sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label=turned)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.periodic_runs(table(configure(spark), sf_dir, "documents"), planted=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_url_filters": op2_url_filters,
    "op3_quality_rules": op3_quality_rules,
    "op4_warc": op4_warc,
    "op5_packing": op5_packing,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_token_counts": op8_token_counts,
    "op9_token_files": op9_token_files,
    "op10_language_id": op10_language_id,
    "op11_maxscore": op11_maxscore,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_periodic_runs": op13_periodic_runs,
}
