"""Scaling benchmarks (B1-B6) with results as DataFrames.

* ``time_fit``: wall time of ``estimator.fit`` on an input that is cached and
  materialised first, so reading is not timed.
* ``data_scaling``: fit time for growing fractions at fixed parallelism.  The
  fractions are nested hash samples of a key, so a larger fraction always
  contains the smaller one and the sample survives repartitioning.
* ``timed_run``: the fit time of one submission with the parallelism its
  session really has.  Submissions of different sizes append their rows to one
  metrics table, over which ``speedup`` is computed.
* ``speedup`` / ``linear_reference``: window expressions over a results table.
  Those tables hold one row per timed run (a handful), so their windows
  without a partition key are bounded by construction.
"""
from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from .sampling import hash_sample


def time_fit(estimator, train: DataFrame, materialise: bool = True):
    """B1: (seconds, model).  Caches and counts ``train`` first unless told not to."""
    if materialise:
        if not train.is_cached:
            train = train.cache()
        train.count()
    t0 = time.perf_counter()
    model = estimator.fit(train)
    return time.perf_counter() - t0, model


def iterations(model) -> int | None:
    """Optimiser iterations of a fitted model when it reports them (LR), else None."""
    if not getattr(model, "hasSummary", False):
        return None
    return getattr(model.summary, "totalIterations", None)


DATA_SCALING_SCHEMA = StructType([
    StructField("fraction", DoubleType()),
    StructField("n_rows", LongType()),
    StructField("train_seconds", DoubleType()),
    StructField("iterations", IntegerType()),
])


def data_scaling(estimator, train: DataFrame, fractions: Sequence[float] = (0.05, 0.1, 0.25, 0.5, 1.0),
                 key: str | None = None, seed: int = 42) -> DataFrame:
    """B2: one row per fraction (fraction, n_rows, train_seconds).

    With ``key`` the samples are nested hash samples; without it Bernoulli
    samples with ``seed``.  The caller's frame is never unpersisted here.
    """
    rows = []
    for frac in fractions:
        if frac >= 1.0:
            part = train
        elif key is not None:
            part = hash_sample(train, key, frac)
        else:
            part = train.sample(False, float(frac), seed=seed)
        owned = not part.is_cached
        part = part.cache() if owned else part
        n = part.count()
        secs, model = time_fit(estimator, part, materialise=False)
        rows.append((float(frac), int(n), float(secs), iterations(model)))
        if owned:
            part.unpersist()
    spark = train.sparkSession
    return linear_reference(spark.createDataFrame(rows, DATA_SCALING_SCHEMA))


RUN_SCHEMA = StructType([
    StructField("cores", IntegerType()),
    StructField("n_rows", LongType()),
    StructField("train_seconds", DoubleType()),
    StructField("iterations", IntegerType()),
])


def timed_run(estimator, train: DataFrame, repeats: int = 1) -> DataFrame:
    """One row of this submission: its cores, rows, fastest fit of ``repeats``.

    ``cores`` is the parallelism the session really has (total executor cores);
    the frame is cached as it is, never dealt into fewer partitions.
    """
    spark = train.sparkSession
    owned = not train.is_cached
    data = train.cache() if owned else train
    n = data.count()
    secs, model = min((time_fit(estimator, data, materialise=False) for _ in range(max(1, repeats))), key=lambda r: r[0])
    if owned:
        data.unpersist()
    return spark.createDataFrame([(spark.sparkContext.defaultParallelism, n, float(secs), iterations(model))], RUN_SCHEMA)


def speedup(results: DataFrame, cores_col: str = "cores", secs_col: str = "train_seconds") -> DataFrame:
    """Speed-up against the smallest core count, ideal speed-up and efficiency.

    The baseline is the run with the fewest cores (not whichever row comes
    first), scaled to per-core ideal: ideal = cores / base_cores.
    """
    w = Window.orderBy(cores_col, secs_col).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    base_secs = F.first(secs_col).over(w)
    base_cores = F.first(cores_col).over(w)
    out = results.withColumn("speedup", F.try_divide(base_secs, F.col(secs_col))) \
        .withColumn("ideal", F.col(cores_col) / base_cores)
    return out.withColumn("efficiency", F.try_divide(F.col("speedup"), F.col("ideal")))


def linear_reference(results: DataFrame, n_col: str = "n_rows", secs_col: str = "train_seconds") -> DataFrame:
    """The time a linear law through the smallest run would predict."""
    w = Window.orderBy(n_col, secs_col).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rate = F.try_divide(F.first(secs_col).over(w), F.first(n_col).over(w))
    return results.withColumn("linear_seconds", rate * F.col(n_col))
