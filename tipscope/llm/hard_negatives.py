"""Hard negatives by Strassen products of integer tiles and mergeable heaps.

Rows are sorted by label into tiles, anchors into blocks.  A cell is a block of
anchors and a tile of candidates; its scores are one int64 matrix product by
Strassen's recursion (operands filled up with zeros to even sizes, seven half
products, exact integer sums, a plain product at LEAF).

1. Positives: cells whose block and tile share a label multiply the rows of
   that label only.  Each keeps the best ``positives`` rows of an anchor; these
   heaps are merged by rank.
2. Windows: every positive score asks for negatives between ``low`` and
   ``high`` percent of it.  In all cells with different labels each anchor and
   positive keeps its best ``negatives`` rows of the window; merged by rank.

Blocks and tiles have a bounded number of rows (the order by label is cut every
so many rows, so a label with very many rows has many tiles), and heaps a
bounded size.  Anchors are sent to every tile, tiles to every block.

Edge cases: rows with a NULL label or vector or a NULL or non-finite component
take no part; shorter vectors count as filled up with zeros; equal rows and
ids are rows of their own, only the anchor's own row is no positive of it; ties
go to the smaller id, NULL ids last (a NULL id is never an anchor); anchors
without positives, and positives whose window is empty (all scores below 0
among them), give no rows; an empty table gives none; extra columns are not
read; components beyond 2**25 after scaling are an error.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tipscope.llm.tables import Workspace, maybe_broadcast
from tipscope.llm.vectors import integer_vectors, matrix, nullable_ids, one_chunk

#: Rows of a tile of candidates and of a block of anchors.
TILE, BLOCK = 4096, 1024
#: Products with a side of at most this many are done plainly.
LEAF = 32

_POSITIVE = "anchor_rid long, anchor_id long, rid long, positive_id long, positive_score long"
_NEGATIVE = "anchor_rid long, positive_place int, rid long, negative_id long, negative_score long"


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` of int64 matrices.  Sums wrap around alike on both sides, so the
    product is exact wherever it fits 64 bits."""
    (n, m), p = a.shape, b.shape[1]
    if min(n, m, p) <= LEAF:
        return a @ b
    if n % 2 or m % 2 or p % 2:
        a = np.pad(a, ((0, n % 2), (0, m % 2)))
        b = np.pad(b, ((0, m % 2), (0, p % 2)))
        return strassen(a, b)[:n, :p]
    n, m, p = n // 2, m // 2, p // 2
    a11, a12, a21, a22 = a[:n, :m], a[:n, m:], a[n:, :m], a[n:, m:]
    b11, b12, b21, b22 = b[:m, :p], b[:m, p:], b[m:, :p], b[m:, p:]
    out = np.zeros((2 * n, 2 * p), np.int64)
    for left, right, parts in (
        (a11 + a22, b11 + b22, ((0, 0, 1), (1, 1, 1))),
        (a21 + a22, b11, ((1, 0, 1), (1, 1, -1))),
        (a11, b12 - b22, ((0, 1, 1), (1, 1, 1))),
        (a22, b21 - b11, ((0, 0, 1), (1, 0, 1))),
        (a11 + a12, b22, ((0, 0, -1), (0, 1, 1))),
        (a21 - a11, b11 + b12, ((1, 1, 1),)),
        (a12 - a22, b21 + b22, ((0, 0, 1),)),
    ):
        product = strassen(left, right)
        for i, j, sign in parts:
            quarter = out[i * n:(i + 1) * n, j * p:(j + 1) * p]
            (np.add if sign > 0 else np.subtract)(quarter, product, out=quarter)
    return out


class _Side:
    """Rows of one side of a cell in numpy."""

    def __init__(self, table: pa.Table, by_id: bool = False) -> None:
        self.vec_id, self.no_id = nullable_ids(one_chunk(table, "vec_id"))
        self.rid = one_chunk(table, "rid").to_numpy(zero_copy_only=False)
        self.label = one_chunk(table, "label").to_numpy(zero_copy_only=False)
        self.v = matrix(one_chunk(table, "v"))
        if by_id:  # ties of a stable sort by score then go to the smaller id
            order = np.lexsort((self.rid, self.vec_id, self.no_id))
            self.vec_id, self.no_id, self.rid, self.label, self.v = (
                x[order] for x in (self.vec_id, self.no_id, self.rid, self.label, self.v))

    def ids(self, rows: np.ndarray) -> pa.Array:
        return pa.array(self.vec_id[rows], pa.int64(), mask=self.no_id[rows])


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    width = max(a.shape[1], b.shape[1])
    a, b = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))
    return strassen(a, np.ascontiguousarray(b.T))


def _rows(parts: list[tuple], tile: _Side | None, schema: list[str]) -> pa.Table:
    """Columns of gathered parts; the last but two is a row of the tile, given by number and by id."""
    if not parts:
        return pa.table({c: pa.array([], pa.int32() if c == "positive_place" else pa.int64()) for c in schema})
    first, second, row, score = (np.concatenate(c) for c in zip(*parts))
    second = pa.array(second, pa.int32() if schema[1] == "positive_place" else pa.int64())
    return pa.table([pa.array(first, pa.int64()), second, pa.array(tile.rid[row], pa.int64()), tile.ids(row),
                     pa.array(score, pa.int64())], names=schema)


def _positives(keep: int):
    """Cell: the best ``keep`` rows of each anchor's own label."""
    names = ["anchor_rid", "anchor_id", "rid", "positive_id", "positive_score"]

    def run(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        if not anchors.num_rows or not candidates.num_rows:
            return _rows([], None, names)
        block, tile, parts = _Side(anchors), _Side(candidates, by_id=True), []
        for label in np.intersect1d(block.label, tile.label):
            mine, theirs = np.flatnonzero(block.label == label), np.flatnonzero(tile.label == label)
            score = _scores(block.v[mine], tile.v[theirs])
            for i, row in zip(mine, score):
                other = np.flatnonzero(tile.rid[theirs] != block.rid[i])
                if len(other) > keep:  # the last score that stays, and its ties
                    least = np.partition(row[other], len(other) - keep)[len(other) - keep]
                    other = other[row[other] >= least]
                best = other[np.argsort(-row[other], kind="stable")[:keep]]
                parts.append((np.full(len(best), block.rid[i]), np.full(len(best), block.vec_id[i]), theirs[best], row[best]))
        return _rows(parts, tile, names)

    return run


def _windows(keep: int, low: int, high: int):
    """Cell: the best ``keep`` rows of other labels in the window of each positive."""
    names = ["anchor_rid", "positive_place", "rid", "negative_id", "negative_score"]

    def run(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        if not anchors.num_rows or not candidates.num_rows:
            return _rows([], None, names)
        block, tile, parts = _Side(anchors), _Side(candidates, by_id=True), []
        score = _scores(block.v, tile.v)
        for i, wanted in enumerate(one_chunk(anchors, "positive_scores").to_pylist()):
            wanted = [s for s in wanted if s >= 0]
            if not wanted:
                continue
            least, most = min(-(-low * s // 100) for s in wanted), max(high * s // 100 for s in wanted)
            other = np.flatnonzero((tile.label != block.label[i]) & (score[i] >= least) & (score[i] <= most))
            other = other[np.argsort(-score[i][other], kind="stable")]
            falling = -score[i][other]
            for place, s in enumerate(wanted):  # positives in order: those with scores below 0 come last
                least, most = -(-low * s // 100), high * s // 100
                begin = np.searchsorted(falling, -most)
                end = np.searchsorted(falling, -least, side="right")
                best = other[begin:min(end, begin + keep)]
                parts.append((np.full(len(best), block.rid[i]), np.full(len(best), place), best, score[i][best]))
        return _rows(parts, tile, names)

    return run


class HardNegatives:
    """One run over ``rows`` of integer vectors with labels (``vec_id``, ``label``, ``v``)."""

    def __init__(self, rows: DataFrame, is_anchor: Column, tile: int = TILE, block: int = BLOCK) -> None:
        self.ws = Workspace(rows.sparkSession, "hard-negatives")
        numbered = self.ws.save(rows.where(F.col("label").isNotNull()).withColumn("rid", F.monotonically_increasing_id()), "rows")
        self.candidates = self._dealt(numbered, "tile", tile)
        self.anchors = self._dealt(numbered.where(is_anchor), "block", block)
        self.tiles, self.blocks = (df.agg(F.max(c)).first()[0] for df, c in ((self.candidates, "tile"), (self.anchors, "block")))

    def _dealt(self, rows: DataFrame, name: str, size: int) -> DataFrame:
        """Rows ordered by label and row number, numbered through, and cut every ``size`` rows."""
        n = max(1, -(-rows.count() // size))
        ordered = rows.repartitionByRange(n, "label", "rid").sortWithinPartitions("label", "rid")
        ordered = self.ws.save(ordered.withColumn("place", F.monotonically_increasing_id()), f"{name}-order")
        part = F.shiftright("place", 33).alias("part")  # the id holds the partition above its 33 bits of row number
        counts = ordered.groupBy(part).agg(F.count("*").alias("n"))
        before = counts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
        row = F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1)
        numbered = ordered.withColumn("part", part).join(maybe_broadcast(before, n, 32), "part")
        return self.ws.save(numbered.withColumn(name, F.floor(row / size).cast("int")).drop("part", "place", "before"), f"{name}s")

    def positives(self, keep: int) -> DataFrame:
        """``anchor_rid``, ``anchor_id``, ``place`` (from 0), ``positive_id``, ``positive_score``."""
        meet = self.anchors.select("block", "label").distinct().join(
            self.candidates.select("tile", "label").distinct(), "label").select("block", "tile").distinct()
        meet = self.ws.save(meet, "meetings")
        left, right = self.anchors.join(meet, "block"), self.candidates.join(meet, "tile")
        found = left.groupBy("block", "tile").cogroup(right.groupBy("block", "tile")).applyInArrow(_positives(keep), _POSITIVE)
        order = Window.partitionBy("anchor_rid").orderBy(F.desc("positive_score"), F.asc_nulls_last("positive_id"), "rid")
        ranked = found.withColumn("place", F.row_number().over(order) - 1).where(F.col("place") < keep).drop("rid")
        return self.ws.save(ranked, "positives")

    def mine(self, positives: int, negatives: int, low: int, high: int) -> DataFrame:
        """``anchor_id``, ``positive_id``, ``rank``, ``negative_id`` and both scores."""
        chosen = self.positives(positives)
        if self.blocks is None:  # no anchor: nothing to pair
            return chosen.select("anchor_id", "positive_id", F.col("place").alias("rank"), F.col("positive_id").alias("negative_id"),
                                 "positive_score", F.col("positive_score").alias("negative_score"))
        asked = chosen.groupBy(F.col("anchor_rid").alias("rid")).agg(F.transform(
            F.array_sort(F.collect_list(F.struct("place", "positive_score"))), lambda s: s["positive_score"]).alias("positive_scores"))
        number = lambda c, n: F.explode(F.sequence(F.lit(0), F.lit(n))).alias(c)
        left = self.anchors.join(asked, "rid").select("*", number("tile", self.tiles))
        right = self.candidates.select("*", number("block", self.blocks))
        found = left.groupBy("block", "tile").cogroup(right.groupBy("block", "tile")).applyInArrow(
            _windows(negatives, low, high), _NEGATIVE)
        order = Window.partitionBy("anchor_rid", "positive_place").orderBy(
            F.desc("negative_score"), F.asc_nulls_last("negative_id"), "rid")
        best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
        named = chosen.withColumnRenamed("place", "positive_place")
        return best.join(named, ["anchor_rid", "positive_place"]).select(
            "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
                   scale: int = 256, label: Column | None = None) -> DataFrame:
    """Negatives of each anchor's positives, from ``low`` to ``high`` percent of the
    positive's score; ``label`` (over ``vec_id``, ``label``) replaces the label."""
    whole = integer_vectors(rows, scale)
    if label is not None:
        whole = whole.withColumn("label", label)
    return HardNegatives(whole, is_anchor).mine(positives, negatives, low, high)
