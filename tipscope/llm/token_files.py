"""Token ids of a corpus as flat binary files.

Format, per part: ``*.ids`` holds the ids of its documents one after another,
little-endian unsigned 16-bit (32-bit for vocabularies above 65,536), each
document ended by the end id; ``*.idx`` holds little-endian 64-bit integers:
the number n of documents, n + 1 offsets into the ids, n document ids, and n
flags (1: the id is NULL).  Documents ascend by id over all parts; a part's
base, the number of ids before it, is the prefix sum over the manifest.

Rows are dealt by ranges of the id (rows of one id by a hash of the text and
the row number, so one id or row with very many copies is still split), sorted
inside the task and encoded as they stream into the file.

Edge cases: NULL and empty texts are one end id; NULL ids come first; rows
that share an id stand in any order; an empty table gives an empty manifest;
extra columns are not read; bytes that are not UTF-8 count as replacement
characters.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tipscope.llm.pieces import encoder_of, vocabulary_path
from tipscope.llm.shared_files import mapped, new_folder, open_store
from tipscope.llm.tables import Workspace

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
_MANIFEST = "part int, ids_uri string, idx_uri string, dtype string, n_docs long, n_tokens long"
_DOCS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _write(path: str, folder: str, end_id: int):
    """Map function: one pair of files per task, one manifest row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        name = f"{folder}/part-{task.partitionId():06d}-{task.taskAttemptId()}"
        encoder = encoder_of(path)
        dtype = "<u2" if encoder.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"
        store, ids_path = open_store(f"{name}.ids")
        end = end_id.to_bytes(4, "little")
        lengths: list[int] = []
        doc_ids: list[int | None] = []
        with store.open_output_stream(ids_path) as out:
            for batch in batches:
                doc_ids += batch["doc_id"].to_pylist()
                for text in batch["text"].to_pylist():
                    ids = np.frombuffer(encoder.encode(text) + end, "<u4").astype(dtype)
                    lengths.append(len(ids))
                    out.write(ids.tobytes())
        if not lengths:
            store.delete_file(ids_path)
            return
        n = len(lengths)
        offsets = np.concatenate(([0], np.cumsum(lengths)))
        index = np.concatenate(([n], offsets, [d or 0 for d in doc_ids], [d is None for d in doc_ids])).astype("<i8")
        with store.open_output_stream(ids_path.removesuffix("ids") + "idx") as out:
            out.write(index.tobytes())
        yield pa.RecordBatch.from_pylist([{
            "part": task.partitionId(), "ids_uri": f"{name}.ids", "idx_uri": f"{name}.idx", "dtype": dtype, "n_docs": n, "n_tokens": int(offsets[-1])}],
            schema=pa.schema([("part", pa.int32()), ("ids_uri", pa.string()), ("idx_uri", pa.string()), ("dtype", pa.string()),
                              ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

    return run


def write_token_files(docs: DataFrame, vocabulary: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write the corpus; returns its manifest: a row per part, with its base."""
    spark = docs.sparkSession
    folder = new_folder(spark, "token-files")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.make_valid_utf8(F.col("text").cast("string")).alias("text"))
    # the row number keeps a row that is repeated very often from being one range
    numbered = rows.withColumn("tie", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    ranged = numbered.repartitionByRange("doc_id", "tie", "row").sortWithinPartitions("doc_id", "tie", "row")
    written = Workspace(spark, "token-manifest").save(ranged.select("doc_id", "text").mapInArrow(
        _write(vocabulary or vocabulary_path(VOCABULARY), folder, end_id), _MANIFEST), "manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over one row per part
    return written.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in batch.to_pylist():
            n = part["n_docs"]
            index = mapped(part["idx_uri"], "<i8")
            offsets, doc_ids, null = index[1:n + 2], index[n + 2:2 * n + 2], index[2 * n + 2:3 * n + 2]
            size = np.dtype(part["dtype"]).itemsize
            for at in range(0, n, 4096):
                to = min(n, at + 4096)
                ids = mapped(part["ids_uri"], part["dtype"], int(offsets[at]) * size, int(offsets[to] - offsets[at]))
                cut = offsets[at:to + 1] - offsets[at]
                crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(cut, cut[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids[at:to].astype(np.int64), pa.int64(), mask=null[at:to].astype(bool)),
                     pa.array(offsets[at:to].astype(np.int64) + part["base"]), pa.array(np.diff(cut).astype(np.int64)), pa.array(crc, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_documents(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: its id, the ids before it, its length, their crc32."""
    spark: SparkSession = manifest.sparkSession
    parts = Workspace(spark, "token-bases").save(manifest, "bases")
    return parts.repartition(max(1, parts.count())).mapInArrow(_read, _DOCS)
