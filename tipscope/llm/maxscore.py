"""Exact top-k inner products with an inverted index and MaxScore.

Index: candidates are dealt by hash into shards of about SHARD_ROWS rows.  A
shard has two posting lists for each dimension, one of positive and one of
negative components, each with the ordinals of its rows, their weights and the
largest weight.  The index is an ordinary table with a row per posting list.

Search: a block of queries meets a shard in one task.  For a query component
the list of its own sign adds to scores, at most ``|q| * largest weight``; the
list of the other sign only takes away, so its bound is 0.  Ordered by bound,
the longest run of lists whose bounds sum to less than the query's k-th best
score so far is non-essential: a row found in those lists alone cannot enter.
The essential lists are traversed and summed; of the rest, largest
products first, only rows that are still competitive are probed, and rows leave
when sum and remaining bounds fall below the k-th score.  Lists that hold many
rows of their shard are summed as dense rows, for many queries in one matrix
product (every query's non-essential lists having factor 0 in it).  The first k-th score
comes from one shard, searched before the others; each shard returns at most k
rows a query, which are merged by rank.

A block holds QUERY_BLOCK queries at most and a shard a bounded number of rows,
so a task's memory does not grow with the input; queries are sent to every
shard and a shard to every block.  Nothing but a row count reaches the driver.

Edge cases: vectors NULL or with NULL or non-finite components take no part;
shorter vectors count as filled up with zeros, empty ones score 0; every row
but the query's own row is a candidate, equal rows and ids included; ties go to
the smaller id, NULL ids last (a NULL id is never a query); with fewer than k
candidates all are returned; an empty table gives no rows; extra columns are
not read; components beyond 2**25 after scaling are an error, since their
products do not fit 64 bits.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tipscope.llm.tables import Workspace
from tipscope.llm.vectors import integer_vectors, matrix, nullable_ids, one_chunk

SHARD_ROWS = 4096
QUERY_BLOCK = 16_384
#: The k-th score of a query that has fewer than k rows yet.
NONE_YET = -(1 << 62)
#: A list that holds at least one in DENSE rows of its shard is kept as a dense row.
DENSE = 16
#: Non-essential lists probed between two looks at what is still competitive.
PROBED = 8
#: Numbers in the work arrays of a batch of queries.
CELLS = 1 << 20

_POSTING = "shard int, term int, docs array<long>, weights array<long>"
_FOUND = "query_rid long, query_id long, rid long, vec_id long, score long"


def _postings(key: tuple, table: pa.Table) -> pa.Table:
    """Posting lists of a shard; term -1 holds its rows' numbers and ids."""
    vectors = one_chunk(table, "v")
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    weight = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    doc = np.repeat(np.arange(len(lengths)), lengths)
    dim = np.arange(len(weight)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    some = weight != 0
    doc, weight, term = doc[some], weight[some], 2 * dim[some] + (weight[some] < 0)
    order = np.argsort(term, kind="stable")  # rows stay in order within a list
    doc, weight, term = doc[order], weight[order], term[order]
    terms, first = np.unique(term, return_index=True)
    rows = len(lengths)
    ends = np.concatenate(([0, rows], rows + np.append(first, len(term))[1:])) if len(terms) else np.array([0, rows])
    lists = lambda head, rest: pa.ListArray.from_arrays(
        pa.array(ends, pa.int32()), pa.concat_arrays([head, pa.array(rest, pa.int64())]))
    return pa.table({
        "shard": pa.array(np.full(len(terms) + 1, key[0].as_py()), pa.int32()),
        "term": pa.array(np.append(-1, terms), pa.int32()),
        "docs": lists(one_chunk(table, "rid").cast(pa.int64()), doc),
        "weights": lists(one_chunk(table, "vec_id").cast(pa.int64()), np.abs(weight))})


class _Shard:
    """The posting lists of one shard, in memory: those that hold many of its rows
    as dense rows of a matrix, the others as they are."""

    def __init__(self, table: pa.Table) -> None:
        docs, weights = one_chunk(table, "docs"), one_chunk(table, "weights")
        terms = one_chunk(table, "term").to_numpy(zero_copy_only=False)
        head = int(np.flatnonzero(terms == -1)[0])
        self.rid = docs[head].values.to_numpy(zero_copy_only=False)
        self.vec_id, self.no_id = nullable_ids(weights[head].values)
        self.place = {int(r): i for i, r in enumerate(self.rid)}
        rows = len(self.rid)
        held = [i for i in np.argsort(terms, kind="stable").tolist() if i != head]
        self.dim, self.sign = terms[held] >> 1, np.where(terms[held] & 1, -1, 1)
        self.top = np.zeros(len(held), np.int64)
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        dense: list[np.ndarray] = []
        self.line = np.full(len(held), -1)  # row of the matrix, for dense lists
        for t, i in enumerate(held):
            at, w = (c[i].values.to_numpy(zero_copy_only=False) for c in (docs, weights))
            self.top[t] = w.max()
            if len(at) * DENSE >= rows:
                self.line[t] = len(dense)
                dense.append(np.zeros(rows))
                dense[-1][at] = w
            else:
                self.lists[t] = (at, w)
        self.matrix = np.stack(dense) if dense else np.zeros((0, rows))
        self.dense_terms = np.flatnonzero(self.line >= 0)

    def _probed(self, terms: np.ndarray, factors: np.ndarray, found: np.ndarray) -> np.ndarray:
        """What some lists add to the scores of some rows."""
        dense = self.line[terms] >= 0
        out = factors[dense] @ self.matrix[np.ix_(self.line[terms[dense]], found)].astype(np.int64)
        for t, factor in zip(terms[~dense].tolist(), factors[~dense].tolist()):
            docs, w = self.lists[t]
            at = np.minimum(np.searchsorted(docs, found), len(docs) - 1)
            out += np.where(docs[at] == found, factor * w[at], 0)
        return out

    def search(self, rids: list[int], vectors: np.ndarray, k: int, thresholds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ordinals and scores of the best k rows of each query that reach its threshold."""
        width = int(self.dim.max(initial=-1)) + 1
        if vectors.shape[1] < width:
            vectors = np.pad(vectors, ((0, 0), (0, width - vectors.shape[1])))
        factor = vectors[:, self.dim] * self.sign
        bound = np.maximum(factor, 0) * self.top
        order = np.argsort(bound, axis=1, kind="stable")
        sums = np.cumsum(np.take_along_axis(bound, order, 1), axis=1)
        skipped = np.zeros(bound.shape, bool)  # the non-essential lists
        np.put_along_axis(skipped, order, sums < thresholds[:, None], 1)
        rest = np.where(skipped, bound, 0).sum(axis=1)

        essential = np.where(skipped, 0, factor)
        if (np.abs(essential) * self.top).sum(axis=1).max(initial=0) < 1 << 53:  # doubles are exact
            score = (essential[:, self.dense_terms].astype(np.float64) @ self.matrix).astype(np.int64)
        else:
            score = essential[:, self.dense_terms] @ self.matrix.astype(np.int64)
        for t, (docs, w) in self.lists.items():
            asking = np.flatnonzero(essential[:, t])
            score[np.ix_(asking, docs)] += essential[asking, t][:, None] * w
        alive = score + rest[:, None] >= thresholds[:, None]
        for i, rid in enumerate(rids):
            if rid in self.place:
                alive[i, self.place[rid]] = False
            found = np.flatnonzero(alive[i])
            yield self._best(found, score[i, found], *self._others(skipped[i], factor[i]), bound[i], int(rest[i]), k, int(thresholds[i]))

    def _others(self, skipped: np.ndarray, factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Non-essential lists that the query asks for, those of the largest products first."""
        terms = np.flatnonzero(skipped & (factor != 0))
        terms = terms[np.argsort(-np.abs(factor[terms]) * self.top[terms], kind="stable")]
        return terms, factor[terms]

    def _best(self, found, score, terms, factors, bound, rest, k, threshold) -> tuple[np.ndarray, np.ndarray]:
        for at in range(0, len(terms), PROBED):
            if not len(found):
                break
            some = terms[at:at + PROBED]
            score = score + self._probed(some, factors[at:at + PROBED], found)
            rest -= int(bound[some].sum())
            keep = score + rest >= threshold  # still competitive
            found, score = found[keep], score[keep]
        if len(found) > k:  # the k-th score and everything that ties with it
            keep = score >= np.partition(score, len(score) - k)[len(score) - k]
            found, score = found[keep], score[keep]
            order = np.lexsort((self.rid[found], self.vec_id[found], self.no_id[found], -score))[:k]
            found, score = found[order], score[order]
        return found, score


def _search(k: int):
    """Cell of a block of queries and a shard: the best k rows of each query."""
    names = ["query_rid", "query_id", "rid", "vec_id", "score"]

    def run(queries: pa.Table, index: pa.Table) -> pa.Table:
        if not queries.num_rows or not index.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in names})
        shard = _Shard(index)
        rids, ids = one_chunk(queries, "rid").to_pylist(), one_chunk(queries, "vec_id").to_numpy()
        thresholds = one_chunk(queries, "threshold").to_numpy()
        batch, docs, scores = max(1, min(256, CELLS // max(1, len(shard.dim), len(shard.rid)))), [], []
        for at in range(0, len(rids), batch):
            vectors = matrix(one_chunk(queries, "v").slice(at, batch))
            for found, score in shard.search(rids[at:at + batch], vectors, k, thresholds[at:at + batch]):
                docs.append(found)
                scores.append(score)
        sizes, docs = [len(d) for d in docs], np.concatenate(docs)
        return pa.table([
            pa.array(np.repeat(rids, sizes), pa.int64()), pa.array(np.repeat(ids, sizes), pa.int64()), pa.array(shard.rid[docs], pa.int64()),
            pa.array(shard.vec_id[docs], pa.int64(), mask=shard.no_id[docs]), pa.array(np.concatenate(scores), pa.int64())], names=names)

    return run


class MaxScoreIndex:
    """Inverted index of the integer vectors of ``rows`` (``vec_id``, ``embedding``)."""

    def __init__(self, rows: DataFrame, scale: int = 64, shard_rows: int = SHARD_ROWS) -> None:
        self.ws = Workspace(rows.sparkSession, "maxscore")
        numbered = integer_vectors(rows, scale).select(F.monotonically_increasing_id().alias("rid"), "vec_id", "v")
        self.rows = self.ws.save(numbered, "rows")
        self.n = self.rows.count()
        self.shards = max(1, -(-self.n // shard_rows))
        dealt = self.rows.withColumn("shard", F.pmod(F.xxhash64("rid"), F.lit(self.shards)).cast("int"))
        self.index = self.ws.save(dealt.groupBy("shard").applyInArrow(_postings, _POSTING), "index")

    def _cells(self, queries: DataFrame, index: DataFrame, shards: Column, blocks: int, k: int) -> DataFrame:
        """Every block of queries with every shard of ``shards`` (an array)."""
        left = queries.withColumn("shard", F.explode(shards))
        right = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        return left.groupBy("block", "shard").cogroup(right.groupBy("block", "shard")).applyInArrow(_search(k), _FOUND)

    def top_k(self, is_query: Column, k: int) -> DataFrame:
        """``query_id``, ``rank``, ``vec_id``, ``score`` of the k best rows of each query row."""
        queries = self.rows.where(is_query)
        blocks = max(1, -(-queries.count() // QUERY_BLOCK))
        queries = queries.withColumn("block", F.pmod(F.xxhash64("rid", F.lit(1)), F.lit(blocks)).cast("int"))
        best = F.sort_array(F.collect_list("score"), asc=False)  # k rows a query at most
        first = self._cells(queries.withColumn("threshold", F.lit(NONE_YET)), self.index.where("shard = 0"),
                            F.array(F.lit(0)), blocks, k)
        first = self.ws.save(first.groupBy(F.col("query_rid").alias("rid")).agg(
            F.when(F.count("*") >= k, F.element_at(best, k)).alias("threshold")), "thresholds")
        queries = queries.join(first, "rid", "left").withColumn("threshold", F.coalesce("threshold", F.lit(NONE_YET)))
        found = self._cells(queries, self.index, F.sequence(F.lit(0), F.lit(self.shards - 1)), blocks, k)
        order = Window.partitionBy("query_rid").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "rid")
        return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
                .select("query_id", "rank", "vec_id", "score"))


def top_k(rows: DataFrame, is_query: Column, k: int = 20, scale: int = 64) -> DataFrame:
    """The k best rows of each query row by the inner product of floor(scale * x)."""
    return MaxScoreIndex(rows, scale).top_k(is_query, k)
