"""Token counts of whole texts; huge ones by overlapping chunks.

A text above HUGE characters becomes rows of overlapping chunks, dealt evenly
over tasks.  Each chunk is encoded on its own and reports, inside its overlap
with the neighbour, the stable token boundaries it sees (a boundary before
white space after another character, where the library's tokens begin) with
the number of tokens before them.  Neighbours are spliced at a boundary that
both report: the left one counts up to it, the right one from it.  Where two
neighbours share none (a word longer than the overlap), alignment fails; the
text is cut again with overlaps four times as wide, until all neighbours align
or one chunk covers the text.

Edge cases: NULL and empty texts have 0 bytes and 0 tokens; repeated rows and
ids are counted one by one; extra columns are not read.
"""
from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tipscope.llm.pieces import PIECE, PieceEncoder, encoder_of, vocabulary_path
from tipscope.llm.tables import Workspace

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 512
#: Characters from which a text is cut, of a chunk's own part, and of an overlap.
HUGE, CHUNK, OVERLAP = 1 << 16, 1 << 15, 256

_CHUNK = ("rid long, doc_id long, n_bytes long, chunk int, chunks int, chars int, start int, overlap int, text string")
_SEEN = ("rid long, doc_id long, n_bytes long, chunk int, chunks int, chars int, overlap int, n_tokens long, "
         "left_at array<int>, left_before array<int>, right_at array<int>, right_before array<int>")


def chunk_rows(rid: int, doc_id: int | None, text: str, overlap: int) -> Iterator[tuple]:
    """Chunks of one text: each reaches ``overlap`` characters past its own part, both ways."""
    own = max(CHUNK, 2 * overlap)
    starts = range(0, max(1, len(text)), own)
    n_bytes = len(text.encode("utf-8", "surrogatepass"))
    for k, at in enumerate(starts):
        begin = max(0, at - overlap)
        yield (rid, doc_id, n_bytes, k, len(starts), len(text), begin, overlap, text[begin:at + own + overlap])


def boundaries(encoder: PieceEncoder, text: str, first: bool) -> tuple[list[int], list[int], int]:
    """Offsets of the stable boundaries of a chunk, tokens before each, all tokens.

    The start of a text is a boundary; the start of a later chunk is not, and
    the first piece of such a chunk proves nothing, as it may be cut.
    """
    encoder.make_room()
    pieces = PIECE.findall(text)
    at, before, offset, tokens = [], [], 0, 0
    for k, piece in enumerate(pieces):
        if k or first:
            at.append(offset)
            before.append(tokens)
        offset += len(piece)
        tokens += len(encoder.ids_of(piece)) // 4
    return at, before, tokens


def splice(chunks: list[dict]) -> int | None:
    """Tokens of a text from its chunks in order; None if two neighbours do not align."""
    total, begin = 0, 0
    for left, right in zip(chunks, chunks[1:]):
        seen = dict(zip(left["right_at"], left["right_before"]))
        both = [(a, n) for a, n in zip(right["left_at"], right["left_before"]) if a in seen]
        if not both:
            return None
        place, before = both[len(both) // 2]
        if seen[place] < begin:
            return None
        total += seen[place] - begin
        begin = before
    return total + chunks[-1]["n_tokens"] - begin


def _ordinary(path: str):
    """Map function: counts of ordinary texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        for batch in batches:
            texts = batch["text"].to_pylist()
            n_bytes = [len((t or "").encode("utf-8", "surrogatepass")) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(n_bytes, pa.int64()), pa.array(map(encoder.count, texts), pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"])

    return run


def _cut(overlap: int):
    """Map function: chunk rows of huge texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        rid = TaskContext.get().partitionId() << 40
        schema = pa.schema([("rid", pa.int64()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("chunk", pa.int32()),
                            ("chunks", pa.int32()), ("chars", pa.int32()), ("start", pa.int32()), ("overlap", pa.int32()), ("text", pa.string())])
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                rows = list(chunk_rows(rid, doc_id, text, overlap))
                rid += 1
                for at in range(0, len(rows), 64):
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[at:at + 64]), schema)], schema=schema)

    return run


def _encode_chunks(path: str):
    """Map function: each chunk's tokens and the boundaries in its overlaps."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        schema = pa.schema([("rid", pa.int64()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("chunk", pa.int32()), ("chunks", pa.int32()),
                            ("chars", pa.int32()), ("overlap", pa.int32()), ("n_tokens", pa.int64())]
                           + [(n, pa.list_(pa.int32())) for n in ("left_at", "left_before", "right_at", "right_before")])
        for batch in batches:
            for row in batch.to_pylist():
                at, before, n = boundaries(encoder, row["text"], row["chunk"] == 0)
                at = [a + row["start"] for a in at]
                lead, tail = row["start"] + 2 * row["overlap"], row["start"] + len(row["text"]) - 2 * row["overlap"]
                left = [k for k, a in enumerate(at) if a <= lead] if row["chunk"] else []
                right = [k for k, a in enumerate(at) if a >= tail] if row["chunk"] + 1 < row["chunks"] else []
                out = {**row, "n_tokens": n, "left_at": [at[k] for k in left], "left_before": [before[k] for k in left],
                       "right_at": [at[k] for k in right], "right_before": [before[k] for k in right]}
                yield pa.RecordBatch.from_pylist([{f.name: out[f.name] for f in schema}], schema=schema)

    return run


def _splice_groups(_key, chunks):
    import pandas as pd

    rows = chunks.sort_values("chunk").to_dict("records")
    total = splice(rows)
    return pd.DataFrame({"rid": [rows[0]["rid"]], "doc_id": pd.array([rows[0]["doc_id"]], dtype="Int64"),
                         "n_bytes": [rows[0]["n_bytes"]], "n_tokens": pd.array([total], dtype="Int64")})


def token_counts(docs: DataFrame, vocabulary: str | None = None, limit: int = LIMIT, huge: int = HUGE,
                 overlap: int = OVERLAP) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens``, ``over_limit`` of every row.

    ``vocabulary`` is the path of a byte-level vocabulary file; texts above
    ``huge`` characters take the way over chunks.
    """
    path = vocabulary or vocabulary_path(VOCABULARY)
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordinary = rows.where(F.col("text").isNull() | (F.length("text") <= huge)).mapInArrow(
        _ordinary(path), "doc_id long, n_bytes long, n_tokens long")

    ws = Workspace(spark, "token-counts")
    spliced: list[DataFrame] = []
    large = ws.save(rows.where(F.length("text") > huge).mapInArrow(_cut(overlap), _CHUNK), "chunks-0")
    number = 0
    while True:
        n_chunks = large.count()
        if not n_chunks:
            break
        # chunks are dealt evenly, so one huge text is not one long task
        dealt = large.repartition(max(spark.sparkContext.defaultParallelism, n_chunks // 512))
        seen = ws.save(dealt.mapInArrow(_encode_chunks(path), _SEEN), f"seen-{number}")
        done = ws.save(seen.groupBy("rid").applyInPandas(_splice_groups, "rid long, doc_id long, n_bytes long, n_tokens long"), f"spliced-{number}")
        spliced.append(done.where("n_tokens IS NOT NULL").select("doc_id", "n_bytes", "n_tokens"))
        failed = done.where("n_tokens IS NULL").select("rid")
        again = large.join(failed, "rid", "left_semi")
        number += 1
        large = ws.save(again.groupBy("rid").applyInPandas(_widen, _CHUNK), f"chunks-{number}")
    out = ordinary
    for part in spliced:
        out = out.unionByName(part)
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


def _widen(_key, chunks):
    """Cut one text anew with overlaps four times as wide."""
    import pandas as pd

    rows = chunks.sort_values("chunk").to_dict("records")
    text, overlap = "", rows[0]["overlap"]
    for row in rows:
        text += row["text"][len(text) - row["start"]:]
    doc_id = None if pd.isna(rows[0]["doc_id"]) else int(rows[0]["doc_id"])
    names = ["rid", "doc_id", "n_bytes", "chunk", "chunks", "chars", "start", "overlap", "text"]
    out = pd.DataFrame(list(chunk_rows(rows[0]["rid"], doc_id, text, 4 * overlap)), columns=names)
    return out.astype({"doc_id": "Int64"})
