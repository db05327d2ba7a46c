"""The corpus pipeline: documents through the corpus operators, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes what a stage returns as Parquet in the shared checkpoint folder and
rereads it as the next stage's ``docs``.  All stages but the last return the
columns of ``documents``.  Their edge cases are those of their operators:
NULL and empty texts go in the first stage, an empty table gives no pieces.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tipscope.llm import cuckoo, jaccard, mixing, packing, quality
from tipscope.llm.tables import Workspace, table
from tipscope.session import configure


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every rule."""
    return quality.quality_filter(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return cuckoo.drop_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of 0.8 over five-word shingles."""
    return jaccard.keep_one_per_component(docs, width=5, threshold=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, those of small sources up to 1.5 times on average."""
    return mixing.Mix(docs).mixed()


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 ids."""
    return packing.pieces(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("pack", pack),
]

#: Packing needs a tokenizer, which SQL has not; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over ``documents`` of ``sf_dir``."""
    docs = table(configure(spark), sf_dir, "documents")
    workspace = Workspace(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        docs = workspace.save(stage(spark, docs, sf_dir), f"{k}-{name}")
    return docs
