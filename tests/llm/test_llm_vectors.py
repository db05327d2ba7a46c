"""Top-k search and hard negatives against brute force over small tables."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tipscope.llm import hard_negatives as H
from tipscope.llm import maxscore as M

SCHEMA = "vec_id long, embedding array<float>, label int, rid string, v int, shard string, tile int, block int"


def frame(spark, rows):
    """Rows of (vec_id, embedding, label); the other columns clash with names used inside."""
    return spark.createDataFrame([(*r, "x", 1, "y", 2, 3) for r in rows], SCHEMA)


def some_rows(seed, n=260, dims=9, labels=4):
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(x) for x in np.float32(rng.normal(0, 0.4, dims))], int(rng.integers(labels))) for i in rng.permutation(n)]
    rows += [(int(i), rows[0][1], 1) for i in range(n, n + 60)]  # one very common vector
    rows += rows[:25]  # repeated rows
    rows += [(None, rows[3][1], 2), (None, rows[3][1], 2), (40, [], 1), (400, [0.5, -0.25], 0), (420, [0.0] * dims, 3), (440, rows[5][1], None)]
    rows += [(460, None, 1), (480, [0.1, None], 1), (500, [float("nan")] * dims, 1), (520, [float("inf")] + [0.0] * (dims - 1), 1)]
    return rows


def usable(rows, scale):
    """(id, integer vector, label) of the rows that take part."""
    return [(i, [math.floor(scale * float(np.float32(x))) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]


def product(a, b):
    return sum(x * y for x, y in zip(a, b))


def order(hit):
    return (-hit[1], hit[0] is None, hit[0] or 0)


def best_rows(rows, k, every, scale):
    used, out = usable(rows, scale), []
    for at, (i, v, _) in enumerate(used):
        if i is not None and i % every == 0:
            hits = sorted(((j, product(v, w)) for other, (j, w, _) in enumerate(used) if other != at), key=order)[:k]
            out += [(i, rank, j, s) for rank, (j, s) in enumerate(hits, 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("k,shard_rows", [(20, 4096), (5, 40), (1, 17)])
def test_top_k_against_brute_force(spark, k, shard_rows):
    rows = some_rows(k)
    got = M.MaxScoreIndex(frame(spark, rows), 64, shard_rows).top_k(F.col("vec_id") % 20 == 0, k)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == best_rows(rows, k, 20, 64)


def test_top_k_with_fewer_candidates(spark):
    rows = [(0, [0.5, 0.5], 1), (1, [-0.5, 0.1], 1), (20, [0.0, 0.0], 0)]
    got = M.top_k(frame(spark, rows), F.col("vec_id") % 20 == 0, 20)
    assert sorted(tuple(r) for r in got.collect()) == best_rows(rows, 20, 20, 64) and got.count() == 4
    assert M.top_k(frame(spark, []), F.col("vec_id") % 20 == 0, 20).collect() == []


@pytest.mark.parametrize("filled,size", [(0.9, 30), (0.3, 30), (0.03, 30), (0.3, 1 << 24)])
def test_the_threshold_leaves_lists_out(filled, size):
    """With thresholds, lists of small bounds are not traversed and the hits are the same:
    dense lists, sparse ones, and products beyond what doubles hold."""
    import pyarrow as pa

    rng = np.random.default_rng(3)
    vectors = rng.integers(-size, size, (500, 16)) * (rng.random((500, 16)) < filled)
    table = pa.table({"rid": pa.array(range(500)), "vec_id": pa.array(range(500)), "v": pa.array(vectors.tolist(), pa.list_(pa.int64()))})
    shard = M._Shard(M._postings((pa.scalar(0),), table))
    rids = list(range(0, 500, 25))
    scores = vectors[rids] @ vectors.T
    scores[np.arange(len(rids)), rids] = -1 << 60
    want = [np.lexsort((np.arange(500), -row))[:7] for row in scores]
    kth = np.array([row[w[-1]] for row, w in zip(scores, want)])
    for thresholds in (np.full(len(rids), M.NONE_YET), np.minimum(kth, 0), kth - 50, kth):
        for i, (docs, score) in enumerate(shard.search(rids, vectors[rids], 7, thresholds)):
            by = np.lexsort((docs, -score))[:7]
            assert docs[by].tolist() == want[i].tolist() and score[by].tolist() == scores[i][want[i]].tolist()


def test_a_component_too_large_is_an_error(spark):
    with pytest.raises(Exception, match="do not fit"):
        M.top_k(frame(spark, [(0, [1e30], 1), (1, [1.0], 1)]), F.col("vec_id") % 20 == 0).collect()


@pytest.mark.parametrize("shape", [(1, 1, 1), (33, 33, 33), (70, 41, 97), (128, 64, 200), (5, 300, 5), (0, 40, 40), (40, 0, 40)])
def test_strassen(shape):
    n, m, p = shape
    rng = np.random.default_rng(n)
    a, b = rng.integers(-2 ** 27, 2 ** 27, (n, m)), rng.integers(-2 ** 27, 2 ** 27, (m, p))
    assert (H.strassen(a, b) == a @ b).all() and H.strassen(a, b).shape == (n, p)


def mined(rows, positives, negatives, low, high, every, scale, turn):
    used, out = [(i, v, turn(i, label)) for i, v, label in usable(rows, scale) if label is not None], []
    for at, (i, v, label) in enumerate(used):
        if i is None or i % every:
            continue
        scored = [(j, product(v, w), other) for n, (j, w, other) in enumerate(used) if n != at]
        for positive, p, _ in sorted((h for h in scored if h[2] == label), key=order)[:positives]:
            hits = sorted((h for h in scored if h[2] != label and low * p <= 100 * h[1] <= high * p), key=order)[:negatives]
            out += [(i, positive, rank, j, p, s) for rank, (j, s, _) in enumerate(hits, 1)]
    return sorted(out, key=str)


def turned(i, label):
    return (label + 1) % 10 if i is not None and i % 7 == 0 else label


@pytest.mark.parametrize("tile,block,labels", [(4096, 1024, 4), (64, 16, 3), (31, 3, 60), (50, 50, 1)])
def test_hard_negatives_against_brute_force(spark, tile, block, labels):
    rows = some_rows(tile, labels=labels)
    whole = H.integer_vectors(frame(spark, rows), 256).withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    got = H.HardNegatives(whole, F.col("vec_id") % 10 == 0, tile, block).mine(5, 3, 50, 95)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = mined(rows, 5, 3, 50, 95, 10, 256, turned)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want and len(want) > 20


def test_hard_negatives_of_few_rows(spark):
    assert H.hard_negatives(frame(spark, []), F.col("vec_id") % 50 == 0).collect() == []
    assert H.hard_negatives(frame(spark, [(1, [0.5], 1), (2, [0.4], 0)]), F.col("vec_id") % 50 == 0).collect() == []
    rows = [(0, [0.5], 1), (3, [0.5], 1), (2, [0.4], 0), (5, [-0.9], 0), (6, [0.1], 0)]
    got = H.hard_negatives(frame(spark, rows), F.col("vec_id") % 50 == 0)
    assert [tuple(r) for r in got.collect()] == mined(rows, 5, 3, 50, 95, 50, 256, lambda i, x: x) != []
