"""Train-and-compare sweep and leaderboard operators.

The sweep fits each estimator on one cached training split, scores the test
split once, caches the scores and evaluates every metric from them.  The
leaderboard is a DataFrame (one row per model); best/fastest model, rounded
report rows and the cost/quality frontier are expressions over it.
"""
from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from . import metrics as M
from .models import score as score_model
from ..session import checkpoint_dir
from .scaling import time_fit

METRIC_COLUMNS = ("auc", "accuracy", "f1", "precision_w", "recall_w", "recall_pos")


def train_and_compare(models: Mapping[str, object], train: DataFrame, test: DataFrame,
                      label_col: str = "label", score_source: str = "probability",
                      on_result=None, partitions: int | None = None, buckets: int | None = None,
                      concurrent: int = 1) -> DataFrame:
    """(model, auc, accuracy, f1, precision_w, recall_w, recall_pos, train_seconds).

    ``partitions`` deals the training rows anew before they are cached (a small
    training set in few partitions leaves cores idle); by default their layout
    is left alone.  ``buckets`` is that of :func:`metrics.metric_record`.

    ``on_result(row_df)`` is called after each model (e.g. a sink), so a
    failure later in the sweep keeps the finished results.

    ``concurrent`` models are fitted and scored at the same time, each in its
    own scheduler pool over the one cached split: the many short jobs of small
    fits then fill each other's gaps.  Their ``train_seconds`` include waiting
    for shared cores, so leave it at 1 where times are compared.
    """
    spark = train.sparkSession
    # Iterative learners (GBT, forests with node caching) cut their lineage in
    # the shared checkpoint folder, so a lost executor does not replay every round.
    checkpoint_dir(spark)
    if partitions is not None:
        train = train.repartition(partitions)
    owned = [df for df in (train, test) if not df.is_cached]  # released at the end
    train = train if train.is_cached else train.cache()
    test = test if test.is_cached else test.cache()
    train.count()
    test.count()

    def judged(name: str, est) -> DataFrame:
        if concurrent > 1:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"fit-{name}")
        secs, model = time_fit(est, train, materialise=False)
        scored = score_model(model, test, score_source).select(label_col, "prediction", "score")
        first = M.metric_record(scored, label_col, "prediction", "score", buckets=buckets).first()
        row = first.asDict() if first is not None else {c: None for c in METRIC_COLUMNS}
        values = [name] + [None if row[c] is None else float(row[c]) for c in METRIC_COLUMNS] + [float(secs)]
        one = spark.createDataFrame([values], LEADERBOARD_SCHEMA)
        if on_result is not None:
            on_result(one)
        return one

    if concurrent > 1:
        with ThreadPoolExecutor(concurrent) as pool:  # each worker keeps the caller's local properties
            frames = list(pool.map(inheritable_thread_target(judged), models.keys(), models.values()))
    else:
        frames = [judged(name, est) for name, est in models.items()]
    for df in owned:
        df.unpersist()
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


LEADERBOARD_SCHEMA = StructType(
    [StructField("model", StringType())]
    + [StructField(c, DoubleType()) for c in METRIC_COLUMNS]
    + [StructField("train_seconds", DoubleType())]
)


def leaderboard(pred_long: DataFrame, label_col: str = "label", model_col: str = "model") -> DataFrame:
    """Metrics of several models' predictions in one pass (long form input)."""
    return M.metric_record(pred_long, label_col, "prediction", "score", group_cols=[model_col])


def best_model(board: DataFrame, model_col: str = "model") -> DataFrame:
    """O3: best by AUC, F1 and minority recall, fastest when times are present.

    Of models that tie, the first by name; NULL values never win.
    """
    def first_by(column: str, sign: int):
        ranked = F.when(F.col(column).isNotNull(), F.struct((F.col(column) * sign).alias("v"), F.col(model_col).alias("m")))
        return F.min(ranked)["m"]

    aggs = [
        first_by("auc", -1).alias("best_auc_model"),
        F.max("auc").alias("best_auc"),
        first_by("f1", -1).alias("best_f1_model"),
        first_by("recall_pos", -1).alias("best_recall_pos_model"),
    ]
    if "train_seconds" in board.columns:
        aggs.append(first_by("train_seconds", 1).alias("fastest_model"))
    return board.agg(*aggs)


def report_rows(board: DataFrame) -> DataFrame:
    """Metrics rounded to 3 decimals, seconds to whole numbers."""
    out = board.select(*[F.round(c, 3).alias(c) if c in METRIC_COLUMNS else F.col(c)
                         for c in board.columns])
    if "train_seconds" in board.columns:
        out = out.withColumn("train_seconds", F.round("train_seconds", 0))
    return out


def cost_tradeoff(board: DataFrame, cost_col: str = "train_seconds", model_col: str = "model") -> DataFrame:
    """(model, cost, auc, pareto): pareto when no other model is at least as
    good in both cost and AUC and better in one.  Models equal in both are
    flagged alike; one without a cost or an AUC is not flagged.

    The windows run over the leaderboard, one row per model (a bounded table).
    """
    known = F.col(cost_col).isNotNull() & F.col("auc").isNotNull()
    comparable = F.when(known, F.col("auc"))
    upto = Window.partitionBy(known).orderBy(F.col(cost_col).cast("double"))
    best_upto = F.max(comparable).over(upto.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    cost_of_best = F.min(F.col(cost_col).cast("double")).over(Window.partitionBy(known, "auc"))
    return board.select(model_col, cost_col, "auc", F.coalesce(
        known & (F.col("auc") == best_upto) & (F.col(cost_col) == cost_of_best), F.lit(False)).alias("pareto"))
