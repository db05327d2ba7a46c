"""Exact duplicates through a sharded cuckoo-filter index of live digests.

Rows are signed (SHA-256 of the text without white space), combined inside
each input partition, and sent to the shard of their digest.  A shard keeps a
cuckoo filter of 16-bit fingerprints and, per home bucket, the stored keys.  A
digest that misses the filter is new; a hit is verified against the stored
keys of its bucket and merged only if they are equal; a filter that overflows
is rebuilt at twice the size from the stored keys.  Digests leave the index by
deletion when their last row goes.

Edge cases: a NULL text counts as empty; NULL ids rank after all others; of
rows alike in digest, length and id exactly one is kept; empty input gives an
empty result; extra columns are carried by ``drop_duplicates`` only; ids are
exact over all 64 bits, beside NULL too; text that is not valid UTF-8 is
signed as the bytes it has.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tipscope.llm.pieces import release_encoders
from tipscope.llm.tables import Workspace, maybe_broadcast

SPACE = b" \t\n\x0b\x0c\r"
#: Bytes of UTF-8 that begin no code point.
CONTINUED = bytes(range(0x80, 0xC0))
#: Live digests that a shard is planned for; more shards come with more rows.
KEYS_PER_SHARD = 50_000
MIN_SHARDS = 48
#: Rows that a map task combines before it passes them on.
COMBINE_ROWS = 100_000
#: Texts that a task signs at once.
SIGN_ROWS = 1024

_ROW = "rid long, doc_id long, digest binary, n_points long"
_SIGNED = "doc_id long, rid long, digest binary, n_points long"
_PARTIAL = "digest binary, n long, best_points long, best_id long, best_rid long"
_STATE = f"shard int, {_PARTIAL}, buckets long, slots binary"


class CuckooFilter:
    """Fingerprints of 16 bits, four to a bucket, two candidate buckets each."""

    SLOTS, KICKS = 4, 500

    def __init__(self, buckets: int, slots: bytes | None = None) -> None:
        self.buckets = buckets  # a power of two
        flat = np.zeros(buckets * self.SLOTS, np.uint16) if slots is None else np.frombuffer(slots, np.uint16)
        self.table: list[list[int]] = [[f for f in row if f] for row in flat.reshape(buckets, self.SLOTS).tolist()]

    @staticmethod
    def fingerprint(digest: bytes) -> int:
        return int.from_bytes(digest[8:10], "little") or 1

    def home(self, digest: bytes) -> int:
        return int.from_bytes(digest[:8], "little") & (self.buckets - 1)

    def other(self, bucket: int, fingerprint: int) -> int:
        return (bucket ^ (fingerprint * 0x5BD1E995)) & (self.buckets - 1)

    def __contains__(self, digest: bytes) -> bool:
        f, b = self.fingerprint(digest), self.home(digest)
        return f in self.table[b] or f in self.table[self.other(b, f)]

    def add(self, digest: bytes) -> bool:
        """False on overflow; the filter must then be rebuilt larger."""
        f, b = self.fingerprint(digest), self.home(digest)
        for _ in range(self.KICKS):
            for place in (b, self.other(b, f)):
                if len(self.table[place]) < self.SLOTS:
                    self.table[place].append(f)
                    return True
            victim = self.table[b]
            victim.append(f)
            f = victim.pop(0)
            b = self.other(b, f)
        return False

    def remove(self, digest: bytes) -> None:
        f, b = self.fingerprint(digest), self.home(digest)
        for place in (b, self.other(b, f)):
            if f in self.table[place]:
                self.table[place].remove(f)
                return

    def packed(self) -> bytes:
        out = np.zeros((self.buckets, self.SLOTS), np.uint16)
        for b, row in enumerate(self.table):
            out[b, :len(row)] = row
        return out.tobytes()


class Shard:
    """Filter and bucketed stored keys of one shard."""

    def __init__(self, buckets: int = 64, slots: bytes | None = None) -> None:
        self.filter = CuckooFilter(buckets, slots)
        self.keys: dict[int, list[list]] = {}  # home bucket -> [digest, n, points, id, rid]

    def _find(self, digest: bytes) -> list | None:
        for key in self.keys.get(self.filter.home(digest), ()):
            if key[0] == digest:
                return key
        return None

    def load(self, key: list) -> None:
        """A stored key whose fingerprint the given slots already hold."""
        self.keys.setdefault(self.filter.home(key[0]), []).append(key)

    def insert(self, key: list) -> None:
        if key[0] in self.filter:  # a hit proves nothing until the stored key is equal
            held = self._find(key[0])
            if held is not None:
                merge(held, key)
                return
        self.load(key)
        if not self.filter.add(key[0]):
            self._grow()

    def _grow(self) -> None:
        live = [key for row in self.keys.values() for key in row]
        buckets = self.filter.buckets
        while True:
            buckets *= 2
            self.filter, self.keys = CuckooFilter(buckets), {}
            for key in live:
                self.load(key)
            if all(self.filter.add(key[0]) for key in live):
                return

    def delete(self, digest: bytes) -> None:
        if digest in self.filter and (held := self._find(digest)) is not None:
            self.keys[self.filter.home(digest)].remove(held)
            self.filter.remove(digest)


def _rank(key: list) -> tuple:
    """Smaller is better: most code points, smallest id (NULL last), first row."""
    return (-key[2], key[3] is None, key[3] or 0, key[4])


def merge(held: list, key: list) -> None:
    n = held[1] + key[1]
    if _rank(key) < _rank(held):
        held[2:] = key[2:]
    held[1] = n


def _raw(column: pa.Array) -> list[bytes | None]:
    """The bytes of a text column, valid UTF-8 or not."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Map function: id and row number with digest and code points of the text; the
    row number is made from the task's place unless there is one already."""
    from pyspark import TaskContext

    release_encoders()
    next_rid = TaskContext.get().partitionId() << 33
    for batch in batches:
        for at in range(0, batch.num_rows, SIGN_ROWS):
            part = batch.slice(at, SIGN_ROWS)
            texts = _raw(part["text"])
            digests = [hashlib.sha256((t or b"").translate(None, SPACE)).digest() for t in texts]
            points = [len((t or b"").translate(None, CONTINUED)) for t in texts]
            rid = part["rid"] if "rid" in part.schema.names else pa.array(np.arange(next_rid, next_rid + len(texts)), pa.int64())
            next_rid += len(texts)
            yield pa.RecordBatch.from_arrays([part["doc_id"], rid, pa.array(digests, pa.binary()), pa.array(points, pa.int64())],
                                             ["doc_id", "rid", "digest", "n_points"])


def shard_of(digest: Column, shards: int) -> Column:
    return (F.conv(F.substring(F.hex(digest), 21, 8), 16, 10).cast("long") % shards).cast("int")


_FIELDS = {"digest": pa.binary(), "n": pa.int64(), "best_points": pa.int64(), "best_id": pa.int64(), "best_rid": pa.int64()}


def _columns(keys: list[list]) -> list[pa.Array]:
    return [pa.array([key[i] for key in keys], kind) for i, kind in enumerate(_FIELDS.values())]


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Map function: one row per digest and at most COMBINE_ROWS input rows."""
    held: dict[bytes, list] = {}
    seen = 0
    for batch in batches:
        for digest, points, doc_id, rid in zip(*(batch[c].to_pylist() for c in ("digest", "n_points", "doc_id", "rid"))):
            key = [digest, 1, points, doc_id, rid]
            if (old := held.get(digest)) is None:
                held[digest] = key
            else:
                merge(old, key)
        seen += batch.num_rows
        if seen >= COMBINE_ROWS:
            yield pa.RecordBatch.from_arrays(_columns(list(held.values())), list(_FIELDS))
            held, seen = {}, 0
    if held:
        yield pa.RecordBatch.from_arrays(_columns(list(held.values())), list(_FIELDS))


def _keys(table: pa.Table) -> list[list]:
    """Rows as lists; whole numbers stay whole, beside NULL too."""
    return [list(row) for row in zip(*(table.column(c).to_pylist() for c in _FIELDS))]


def _update_shard(key: tuple, state: pa.Table, changes: pa.Table) -> pa.Table:
    """The new state of a shard: digests that go, then those that come."""
    stored, filters = _keys(state), [s for s in zip(state.column("buckets").to_pylist(), state.column("slots").to_pylist()) if s[1]]
    shard = Shard(*filters[0]) if filters else Shard()
    for row in stored:
        if row[0] is not None:
            shard.load(row) if filters else shard.insert(row)  # without a filter (a new shard count) it is made from the keys
    gone = changes.column("gone").to_pylist()
    rows = _keys(changes)
    for row, out in zip(rows, gone):
        if out:
            shard.delete(row[0])
    for row, out in zip(rows, gone):
        if not out:
            shard.insert(row)
    live = [row for bucket in shard.keys.values() for row in bucket]
    n = len(live)
    return pa.table([pa.array([key[0].as_py()] * (n + 1), pa.int32()), *_columns([*live, [None] * len(_FIELDS)]),
                     pa.array([None] * n + [shard.filter.buckets], pa.int64()), pa.array([None] * n + [shard.filter.packed()], pa.binary())],
                    names=["shard", *_FIELDS, "buckets", "slots"])


class DigestIndex:
    """Index of live rows.  ``insert`` and ``delete`` write a new version of its
    two tables in the shared folder: ``rows`` (a narrow row per live document)
    and ``state`` (per shard: its stored keys and its packed filter).  The
    number of shards follows the number of live rows; when it changes, filters
    are made anew from the stored keys."""

    def __init__(self, spark: SparkSession, workspace: Workspace | None = None, keys_per_shard: int = KEYS_PER_SHARD,
                 min_shards: int = MIN_SHARDS) -> None:
        self.spark, self.ws = spark, workspace or Workspace(spark, "digest-index")
        self.keys_per_shard, self.shards = keys_per_shard, min_shards
        self.version, self.next_rid = 0, 0
        self.rows = spark.createDataFrame([], _ROW)
        self.state = spark.createDataFrame([], _STATE)

    def _write(self, rows: DataFrame, new: DataFrame, gone: DataFrame | None = None) -> None:
        """A new version: ``rows`` live now, digests ``gone`` taken out, then partial keys ``new`` put in."""
        wanted = -(-rows.count() // self.keys_per_shard)
        if wanted > 2 * self.shards:
            self.shards = wanted
            keys = self.state.where("digest IS NOT NULL")
            self.state = keys.withColumn("shard", shard_of(F.col("digest"), wanted))
        changes = new.withColumn("gone", F.lit(False))
        if gone is not None:
            changes = changes.unionByName(gone.withColumn("gone", F.lit(True)), allowMissingColumns=True)
        changes = changes.withColumn("shard", shard_of(F.col("digest"), self.shards))
        state = self.state.groupBy("shard").cogroup(changes.groupBy("shard")).applyInArrow(
            lambda key, held, some: _update_shard(key, held, some), _STATE)
        self.version += 1
        self.state, self.rows = self.ws.save(state, f"state-{self.version}"), rows

    def insert(self, docs: DataFrame, text: str = "text") -> DigestIndex:
        """Add the rows of ``docs`` (``doc_id`` and the text column)."""
        return self.insert_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")))

    def insert_rows(self, docs: DataFrame) -> DigestIndex:
        """Add rows of ``doc_id`` and ``text``, and with a row number of their own if there is a column ``rid``."""
        signed = docs.mapInArrow(_sign, _SIGNED)
        rows = signed.select((F.col("rid") + F.lit(self.next_rid)).alias("rid"), "doc_id", "digest", "n_points")
        rows = self.ws.save(rows, f"rows-{self.version + 1}")
        self.next_rid = max(self.next_rid, (rows.agg(F.max("rid")).first()[0] or 0) + 1)
        self._write(self.rows.unionByName(rows) if self.version else rows, rows.mapInArrow(_combine, _PARTIAL))
        return self

    def delete(self, doc_ids: DataFrame) -> DigestIndex:
        """Take the rows with these ids out; digests without rows leave the filter."""
        ids = doc_ids.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
        left = self.ws.save(self.rows.join(ids, "doc_id", "left_anti").select(*self.rows.columns), f"rows-{self.version + 1}")
        touched = self.rows.join(ids, "doc_id", "left_semi").select("digest").distinct()
        gone = self.ws.save(touched, f"gone-{self.version + 1}")
        # touched digests are deleted; those with rows left come back with their new best row
        again = left.join(gone, "digest", "left_semi").select(*left.columns).mapInArrow(_combine, _PARTIAL)
        self._write(left, again, gone)
        return self

    def keys(self) -> DataFrame:
        """One row per live digest."""
        return self.state.where("digest IS NOT NULL").drop("buckets", "slots", "shard")

    def lookup(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """``doc_id``, ``found`` and the ``keep_id`` of the live equal text, per row of ``docs``."""
        signed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(_sign, _SIGNED)
        hit = signed.join(self.keys(), "digest", "left")
        return hit.select("doc_id", F.col("n").isNotNull().alias("found"), F.col("best_id").alias("keep_id"))

    def members(self) -> DataFrame:
        """One row per live row: the row that stays for its text, and the group's size.

        A plain shuffle join of two written tables with nothing grouped behind
        it, so adaptive execution splits a digest with very many rows."""
        both = self.rows.join(self.keys(), "digest")
        return both.select("rid", "doc_id", F.col("best_id").alias("keep_id"), F.col("n").alias("group_size"),
                           (F.col("rid") == F.col("best_rid")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def duplicate_groups(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row."""
    return DigestIndex(docs.sparkSession).insert(docs).members().drop("rid")


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns.

    The rows are written once with a row number; what goes is decided by row
    number, of which no two rows share one."""
    spark = docs.sparkSession
    ws = Workspace(spark, "exact-dedup")
    names = [f"c{i}" for i in range(len(docs.columns))]
    text, doc_id = (names[docs.columns.index(c)] for c in ("text", "doc_id"))
    numbered = ws.save(docs.toDF(*names).withColumn("rid", F.monotonically_increasing_id()), "numbered")
    index = DigestIndex(spark, ws).insert_rows(numbered.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), "rid"))
    gone = ws.save(index.members().where(~F.col("kept")).select("rid"), "gone")
    return numbered.join(maybe_broadcast(gone, gone.count(), 16), "rid", "left_anti").select(*names).toDF(*docs.columns)
