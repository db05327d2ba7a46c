"""Extra columns named like those used inside, repeated rows, and bytes that are not UTF-8."""
import random

import pytest
from pyspark.sql import functions as F

from llm_frames import make_docs, prose
from tipscope.llm import jaccard, langid, packing, periodic, token_counts, token_files

NAMES = ["n", "k", "k2", "ids", "curve", "tie", "row", "start", "length", "offset", "sequence_id", "n_tokens", "n_bytes", "part", "base", "key",
         "held_out", "lang_pred", "score", "hash", "level", "label", "component", "component_id", "n_shingles", "chunk", "at", "shard", "digest", "rid"]

OPERATORS = {
    "op5": lambda docs: packing.pieces(docs).drop("sequence_id", "offset", "sequence_length"),
    "op6": lambda docs: jaccard.near_duplicate_components(docs, 4, 85),
    "op8": token_counts.token_counts,
    "op9": lambda docs: token_files.read_documents(token_files.write_token_files(docs)),
    "op10": langid.language_of,
    "op13": lambda docs: periodic.periodic_runs(docs, planted=True),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_extra_columns_change_nothing(spark, name):
    rng = random.Random(1)
    base = prose(rng, 60)
    texts = [None, "", "a b", base, base + " end", "la la " * 30, *(prose(rng, rng.randrange(1, 80)) for _ in range(20))]
    docs = make_docs(spark, texts, langs=["en" if i % 2 else "de" for i in range(len(texts))]).coalesce(1)
    extra = docs.select("*", *[F.lit(f"x{i}").alias(c) for i, c in enumerate(NAMES)])
    rows = [sorted(map(str, OPERATORS[name](df).collect())) for df in (docs, extra)]
    if name == "op5":  # where a document is cut depends on the sequences alone, which depend on the order of ranges
        rows = [sorted((r.doc_id, r.doc_tokens) for r in packing.pieces(df).where("start = 0").collect()) for df in (docs, extra)]
    assert rows[0] == rows[1] and len(rows[0]) > 10


@pytest.mark.parametrize("name", ["op5", "op9"])
def test_one_row_repeated_often_fills_many_ranges(spark, name):
    docs = make_docs(spark, ["the same text"] * 3000, ids=[7] * 3000).repartition(4)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # such small ranges would be put together
    try:
        check_ranges(docs, name)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def check_ranges(docs, name):
    out = OPERATORS[name](docs) if name == "op9" else packing.pieces(docs)
    assert out.count() >= 3000
    if name == "op9":
        manifest = token_files.write_token_files(docs).collect()
        assert len(manifest) >= 4 and max(r.n_docs for r in manifest) < 1500 and sum(r.n_docs for r in manifest) == 3000
        rows = sorted(out.collect(), key=lambda r: r.start)
        assert [r.start for r in rows] == [i * rows[0].n_tokens for i in range(3000)]
    else:
        ranges = {r.sequence_id >> 40 for r in out.select("sequence_id").distinct().collect()}
        assert len(ranges) >= 4
        assert out.agg(F.sum("length")).first()[0] == 3000 * out.first().doc_tokens


@pytest.mark.parametrize("name", ["op5", "op9"])
def test_bytes_that_are_not_utf8_become_replacement_characters(spark, name):
    docs = spark.sql("SELECT 1L AS doc_id, cast(unhex('FF2041') AS string) AS text UNION ALL SELECT 2L, '� A'")
    rows = {r.doc_id: r.ids_crc32 if name == "op9" else r.doc_tokens for r in OPERATORS[name](docs).collect()}
    assert rows[1] == rows[2] > 1
