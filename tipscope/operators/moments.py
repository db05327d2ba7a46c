"""Pairwise moments of numeric columns and their correlation (A10).

The moments of a column pair are the count, means and co-moments over the rows
where both values are present (NULL and NaN are missing).  They come from one
pass: every task sums the products of present-flags, centred values and their
squares of a batch in Gram matrices, adds the batch's moments to its own, and
returns a row per pair.  The centre only conditions the sums; a pair whose own
spread nearly cancels in them (values far from the column's centre, or equal)
is computed again from its rows of the batch.

Moments of disjoint sets of rows merge exactly (:func:`merge_moments`), so they
can be kept per file and new files added without reading the old ones.
"""
from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MOMENTS = "i int, j int, n long, mean_a double, mean_b double, caa double, cbb double, cab double"

#: A pair's spread below this share of its sum of squares has lost too many digits.
CANCELLED = 1e-4


def _numbers(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    value = lambda c: F.col(f"`{c}`").cast("double")
    return df.select(*[F.when(~F.isnan(value(c)), value(c)).alias(f"c{i}") for i, c in enumerate(cols)])


def _centred(x: np.ndarray) -> tuple[float, np.ndarray]:
    """Mean of some values and their distances from it; exact for equal values."""
    away = x - x[0]
    mean = away.mean()
    return x[0] + mean, away - mean


def _batch_moments(x: np.ndarray) -> tuple[np.ndarray, ...]:
    """n, mean of i, spread of i and co-moment of i and j over the rows of ``x`` (NaN: missing) where both are present."""
    there, finite = ~np.isnan(x), np.isfinite(x)
    centre = np.array([_centred(x[finite[:, i], i])[0] if finite[:, i].any() else 0.0 for i in range(x.shape[1])])
    z = np.where(finite, x - centre, 0.0)
    present, endless = there.astype(float), (there & ~finite).astype(float)
    n, own, squares = present.T @ present, z.T @ present, (z * z).T @ present
    some = np.maximum(n, 1.0)
    mean = np.where(n > 0, centre[:, None] + own / some, 0.0)
    caa, cab = squares - own * own / some, z.T @ z - own * own.T / some
    lost = (n == 1) | (n > 0) & ((caa < CANCELLED * squares) | ~np.isfinite(caa) | (endless.T @ present > 0))
    for i, j in zip(*np.nonzero(np.triu(lost | lost.T))):
        both = there[:, i] & there[:, j]
        (mean[i, j], a), (mean[j, i], b) = _centred(x[both, i]), _centred(x[both, j])
        caa[i, j], caa[j, i], cab[i, j] = a @ a, b @ b, a @ b
        cab[j, i] = cab[i, j]
    return n, mean, caa, cab


def _added(one: tuple[np.ndarray, ...], two: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """Moments of two disjoint sets of rows together."""
    (n1, m1, caa1, cab1), (n2, m2, caa2, cab2) = one, two
    n, d = np.maximum(n1 + n2, 1.0), m2 - m1
    weight = n1 * n2 / n
    mean = np.where(n1 == 0, m2, m1 + d * (n2 / n))
    return n1 + n2, mean, caa1 + caa2 + weight * d * d, cab1 + cab2 + weight * d * d.T


def _task_moments(k: int):
    """Map function: the moments of a task's rows, a row per pair i <= j."""
    i, j = np.triu_indices(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = tuple(np.zeros((k, k)) for _ in range(4))
        with np.errstate(all="ignore"):  # infinite values and overflows give NaN
            for batch in batches:
                if batch.num_rows:
                    total = _added(total, _batch_moments(np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])))
        n, mean, caa, cab = total
        columns = [i.astype(np.int32), j.astype(np.int32), n[i, j].astype(np.int64), mean[i, j], mean[j, i], caa[i, j], caa[j, i], cab[i, j]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["i", "j", "n", "mean_a", "mean_b", "caa", "cbb", "cab"])

    return run


def pair_moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(i, j, n, means, co-moments) of every pair i <= j of ``cols`` (by position).

    One pass over ``df``; only the merged rows, one of each pair, come back.
    """
    k, spark = len(cols), df.sparkSession
    none = spark.createDataFrame([(i, j, 0, *[0.0] * 5) for i in range(k) for j in range(i, k)], MOMENTS)  # without rows there may be no task
    parts = _numbers(df, cols).mapInArrow(_task_moments(k), MOMENTS)
    return spark.createDataFrame(merge_moments(parts.unionByName(none)).collect(), MOMENTS)


def merge_moments(parts: DataFrame) -> DataFrame:
    """Moments of the union of disjoint row sets: n = sum n_g, mean = sum n_g m_g / n
    and C = sum (c_g + n_g (ma_g - ma)(mb_g - mb)).

    Means are taken from the least of them, so equal ones merge without rounding;
    ``parts`` is read once."""
    pair, n = Window.partitionBy("i", "j"), F.col("n")
    least = {f"least_{x}": F.coalesce(F.min(F.when(n > 0, F.col(f"mean_{x}"))).over(pair), F.lit(0.0)) for x in "ab"}
    off = {f"off_{x}": F.when(n > 0, F.col(f"mean_{x}") - F.col(f"least_{x}")).otherwise(0.0) for x in "ab"}
    every = {"tot": F.sum("n").over(pair), **{f"all_{x}": F.coalesce(F.try_divide(F.sum(n * F.col(f"off_{x}")).over(pair), F.sum("n").over(pair)), F.lit(0.0)) for x in "ab"}}
    da, db = F.col("off_a") - F.col("all_a"), F.col("off_b") - F.col("all_b")
    return parts.withColumns(least).withColumns(off).withColumns(every).groupBy("i", "j").agg(
        F.max("tot").alias("n"), *[F.max(F.col(f"least_{x}") + F.col(f"all_{x}")).alias(f"mean_{x}") for x in "ab"],
        F.sum(F.col("caa") + n * da * da).alias("caa"), F.sum(F.col("cbb") + n * db * db).alias("cbb"),
        F.sum(F.col("cab") + n * da * db).alias("cab"))


def correlation_of(moments: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(col_a, col_b, r) of every ordered pair; NULL without two distinct values in both."""
    den = F.sqrt("caa") * F.sqrt("cbb")  # no underflow of tiny spreads
    r = F.when(den > 0, F.nanvl(F.col("cab") / den, F.lit(None)))
    names = F.array(*[F.lit(c) for c in cols])
    pair = lambda a, b: F.struct(F.col(a).alias("a"), F.col(b).alias("b"))
    orders = F.when(F.col("i") == F.col("j"), F.array(pair("i", "j"))).otherwise(F.array(pair("i", "j"), pair("j", "i")))
    full = moments.select(F.explode(orders).alias("p"), r.alias("r"))
    return full.select(*[F.element_at(names, F.col(f"p.{x}") + 1).alias(f"col_{x}") for x in "ab"], "r")


def correlation(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A10: Pearson correlation matrix in long form over all rows, pairwise-complete like pandas."""
    return correlation_of(pair_moments(df, cols), list(cols))
