"""Packing documents into sequences along a space-filling curve.

A document's token ids are hashed into a term vector, projected to three
dimensions by fixed random directions, and placed on a Hilbert curve; documents
are range-sorted by that key, and each range is packed in curve order: a
sequence takes documents one after another and cuts the one that does not fit,
so neighbours on the curve share sequences and only the end of a range is not
full.  That end is cut into sequences of a power of two, which need no padding.

Documents of equal key (copies) are ordered by a hash and by row number, so a
group of copies, or one row repeated over and over, is dealt over many ranges.

Edge cases: NULL and empty texts are one end id; NULL and repeated ids are
packed row by row; an empty table gives no sequences; extra columns are not
read; bytes that are not UTF-8 count as replacement characters.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tipscope.llm.pieces import encoder_of, vocabulary_path
from tipscope.llm.tables import Workspace

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
SEQUENCE = 2048
DIMENSIONS, BITS, HASHED = 3, 16, 256
_TOKENS = "doc_id long, curve long, n long, ids binary"
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_length int, ids binary"


def directions(seed: int = 7) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((HASHED, DIMENSIONS))


def project(ids: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Unit-length hashed term vector of the ids, projected."""
    hashed = (ids.astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(24)
    vector = np.bincount(hashed, minlength=HASHED).astype(float)
    length = np.sqrt(vector @ vector)
    return vector @ axes / length if length else np.zeros(axes.shape[1])


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of integer points (rows) below 2 ** bits."""
    x = points.astype(np.int64).copy()
    n, dims = x.shape
    q = 1 << (bits - 1)
    while q > 1:  # undo the rotations of ever smaller cubes
        p = q - 1
        for d in range(dims):
            flip = (x[:, d] & q) != 0
            swap = (x[:, 0] ^ x[:, d]) & p
            x[:, 0] ^= np.where(flip, p, swap)
            x[:, d] ^= np.where(flip, 0, swap)
        q >>= 1
    for d in range(1, dims):
        x[:, d] ^= x[:, d - 1]
    turn = np.zeros(n, np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[:, dims - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= turn[:, None]
    key = np.zeros(n, np.int64)
    for b in range(bits - 1, -1, -1):
        for d in range(dims):
            key = (key << 1) | ((x[:, d] >> b) & 1)
    return key


def curve_keys(vectors: np.ndarray) -> np.ndarray:
    """Curve places of projected vectors; the cube spans four deviations each way."""
    scaled = (vectors / 8 + 0.5) * (1 << BITS)
    return hilbert_key(np.clip(scaled, 0, (1 << BITS) - 1).astype(np.int64))


def _tokenise(path: str, end_id: int):
    """Map function: each document's ids (16-bit where they fit) and curve place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, axes = encoder_of(path), directions()
        end = end_id.to_bytes(4, "little")
        for batch in batches:
            vectors, lengths, stored = [], [], []
            for text in batch["text"].to_pylist():
                ids = np.frombuffer(encoder.encode(text) + end, "<u4")
                vectors.append(project(ids[:-1], axes))
                lengths.append(len(ids))
                stored.append((ids.astype("<u2") if ids.max() < 1 << 16 else ids).tobytes())
            if stored:
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"], pa.array(curve_keys(np.array(vectors))), pa.array(lengths, pa.int64()), pa.array(stored, pa.binary())],
                    ["doc_id", "curve", "n", "ids"])

    return run


class Packer:
    """Packs a stream of documents; ``place`` gives the pieces that became final."""

    def __init__(self, first_sequence: int, length: int = SEQUENCE) -> None:
        self.length, self.sequence, self.used = length, first_sequence, 0
        self.open: list[tuple] = []

    def place(self, doc_id: int | None, ids: np.ndarray) -> list[tuple]:
        out, at, n = [], 0, len(ids)
        while at < n:
            take = min(n - at, self.length - self.used)
            self.open.append((doc_id, at, ids[at:at + take], n, self.used))
            at += take
            self.used += take
            if self.used == self.length:
                out += self._close(self.open, self.length)
                self.open, self.used = [], 0
        return out

    def _close(self, pieces: list[tuple], length: int) -> list[tuple]:
        out = [(doc_id, at, len(ids), n, self.sequence, offset, length, ids) for doc_id, at, ids, n, offset in pieces]
        self.sequence += 1
        return out

    def finish(self) -> list[tuple]:
        """Cut what is left into sequences of powers of two."""
        out, rest, begin = [], self.open, 0
        for bit in range(self.length.bit_length() - 1, -1, -1):
            size = 1 << bit
            if not self.used & size:
                continue
            part = []
            for doc_id, at, ids, n, offset in rest:
                a, b = max(offset, begin), min(offset + len(ids), begin + size)
                if a < b:
                    part.append((doc_id, at + a - offset, ids[a - offset:b - offset], n, a - begin))
            out += self._close(part, size)
            begin += size
        self.open, self.used = [], 0
        return out


def _pack(length: int):
    """Map function over one range in curve order."""
    def rows(pieces: list[tuple]) -> pa.RecordBatch:
        raw = [p[7].astype("<u4").tobytes() for p in pieces]
        column = lambda k, kind=None: pa.array([p[k] for p in pieces], kind or pa.int64())
        return pa.RecordBatch.from_arrays(
            [column(0), column(1), column(2), pa.array([zlib.crc32(r) for r in raw], pa.int64()), column(3), column(4), column(5),
             column(6, pa.int32()), pa.array(raw, pa.binary())],
            ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_length", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        packer = Packer(TaskContext.get().partitionId() << 40, length)
        done: list[tuple] = []
        for batch in batches:
            for doc_id, n, raw in zip(*(batch[c].to_pylist() for c in ("doc_id", "n", "ids"))):
                done += packer.place(doc_id, np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4"))
                if len(done) >= 4096:
                    yield rows(done)
                    done = []
        done += packer.finish()
        if done:
            yield rows(done)

    return run


def pack_documents(docs: DataFrame, vocabulary: str | None = None, end_id: int = END_ID, length: int = SEQUENCE) -> DataFrame:
    """One row per piece: the document, its part of the ids, and its place in a sequence.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit integers;
    the pieces of a ``sequence_id`` in order of ``offset`` are the sequence.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.make_valid_utf8(F.col("text").cast("string")).alias("text"))
    encoded = rows.mapInArrow(_tokenise(vocabulary or vocabulary_path(VOCABULARY), end_id), _TOKENS)
    ws = Workspace(spark, "packing")
    encoded.write.option("compression", "zstd").parquet(f"{ws.path}/tokens")
    tokens = spark.read.schema(encoded.schema).parquet(f"{ws.path}/tokens")
    # the row number keeps a row that is repeated very often from being one range
    numbered = tokens.withColumn("tie", F.xxhash64("doc_id", "n")).withColumn("row", F.monotonically_increasing_id())
    ordered = numbered.repartitionByRange("curve", "tie", "row").sortWithinPartitions("curve", "tie", "row")
    return ordered.select("doc_id", "n", "ids").mapInArrow(_pack(length), _PIECES)


def pieces(docs: DataFrame, **options: object) -> DataFrame:
    """``pack_documents`` without the ids themselves."""
    return pack_documents(docs, **options).drop("ids")
