"""Imbalance-aware evaluation.

The original evaluation launched about ten jobs per model (four multiclass
evaluator passes, two filtered counts, AUC).  Here the confusion counts
and the exact AUC come from one table of distinct (group, score, prediction)
with its class counts: the input is aggregated once, and every metric is an
expression over that table (see :func:`metric_record`).

All functions accept ``group_cols`` so several models (long form, one
``model`` column) are evaluated in the same pass.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def positive_score(predictions: DataFrame, source: str = "probability", out: str = "score") -> DataFrame:
    """Score of class 1 from an MLlib vector column (``probability`` or ``rawPrediction``)."""
    return predictions.withColumn(out, vector_to_array(F.col(source)).getItem(1))


def confusion(pred: DataFrame, label_col: str = "label", prediction_col: str = "prediction",
              group_cols: Sequence[str] = ()) -> DataFrame:
    """Counts per (label, prediction); rows with a NULL label are left out."""
    g = list(group_cols)
    return (pred.where(F.col(label_col).isNotNull())
            .groupBy(*g, F.col(label_col).cast("int").alias("label"),
                     F.col(prediction_col).cast("int").alias("prediction"))
            .agg(F.count(F.lit(1)).alias("n_rows")))


def _safe(num, den):
    return F.coalesce(F.try_divide(num.cast("double"), den), F.lit(0.0))


def _cell_sums(pos, neg, prediction):
    """Confusion counts as aggregates over class counts per prediction."""
    hit = prediction == 1
    return [F.sum(F.when(hit, pos).otherwise(0)).alias("tp"), F.sum(F.when(hit, neg).otherwise(0)).alias("fp"),
            F.sum(F.when(hit, 0).otherwise(pos)).alias("fn"), F.sum(F.when(hit, 0).otherwise(neg)).alias("tn")]


def _threshold_columns():
    """A13, A14 as expressions over tp, fp, fn, tn.

    Per class c: P_c = tp_c / predicted_c, R_c = tp_c / n_c (0 when undefined),
    F1_c their harmonic mean; weighted x = sum_c (n_c / N) x_c.  This equals
    MLlib's multiclass evaluator for binary labels; weighted recall equals
    accuracy by construction.
    """
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    n1 = tp + fn
    n0 = tn + fp
    n = n0 + n1
    p1, r1 = _safe(tp, tp + fp), _safe(tp, n1)
    p0, r0 = _safe(tn, tn + fn), _safe(tn, n0)
    f1_1 = _safe(2 * p1 * r1, p1 + r1)
    f1_0 = _safe(2 * p0 * r0, p0 + r0)
    w1, w0 = _safe(n1, n), _safe(n0, n)
    return [
        _safe(tp + tn, n).alias("accuracy"),
        (w0 * f1_0 + w1 * f1_1).alias("f1"),
        (w0 * p0 + w1 * p1).alias("precision_w"),
        (w0 * r0 + w1 * r1).alias("recall_w"),
        r1.alias("recall_pos"),
    ]


def threshold_metrics(pred: DataFrame, label_col: str = "label", prediction_col: str = "prediction",
                      group_cols: Sequence[str] = ()) -> DataFrame:
    """A13, A14 for predictions without scores: one grouped aggregate."""
    lab = F.col(label_col)
    src = pred.where(lab.isNotNull())
    cells = src.groupBy(*group_cols).agg(
        *[F.coalesce(c, F.lit(0)).alias(n) for n, c in zip(("tp", "fp", "fn", "tn"), _cell_sums(
            (lab == 1).cast("long"), (lab == 0).cast("long"), F.col(prediction_col)))])
    return cells.select(*group_cols, "tp", "fp", "fn", "tn", *_threshold_columns())


def metric_record(pred: DataFrame, label_col: str = "label", prediction_col: str | None = "prediction",
                  score_col: str = "score", group_cols: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """One row per group with auc, accuracy, f1, precision_w, recall_w,
    recall_pos and n_unscored, all over the same rows.

    Rows whose score is NULL or NaN, or whose prediction is NULL, cannot be
    ranked or judged: they are left out of every metric and counted in
    ``n_unscored``.  Rows without a label count nowhere.

    AUC = sum over positives of (negatives scored lower + half the negatives
    tied) / (P * N).  Rows are first aggregated to one row per distinct
    (group, score, prediction); that table is range-partitioned by score, and
    the negatives below a score are (negatives of earlier ranges) + (a running
    sum inside its own range).  Range bounds come from Spark's bounded sample
    and only group the work, so the result is exact; ``buckets`` sets the number of
    ranges (default: the session's shuffle partitions), so that a range of
    distinct scores fits a task.
    """
    g = list(group_cols)
    lab, score = F.col(label_col), F.col(score_col).cast("double")
    judged = F.col(prediction_col).cast("double") if prediction_col is not None else F.lit(0.0)
    ranked = F.when(~F.isnan(score) & judged.isNotNull(), score)
    counts = pred.where(lab.isin(0, 1)).groupBy(*g, ranked.alias("s"), judged.alias("p")).agg(
        F.count_if(lab == 1).alias("pos"), F.count_if(lab == 0).alias("neg"))
    by = [*g, "s"]
    ranges = counts.repartitionByRange(*([buckets] if buckets else []), *by).withColumn("b", F.spark_partition_id())
    scored = F.col("s").isNotNull()
    pos, neg = F.when(scored, F.col("pos")).otherwise(0), F.when(scored, F.col("neg")).otherwise(0)
    inside = Window.partitionBy(*g, "b").orderBy("s")
    upto = F.sum(neg).over(inside.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    tied = F.sum(neg).over(inside.rangeBetween(Window.currentRow, Window.currentRow))
    per_range = ranges.withColumn("credit", pos * (upto - tied / 2.0)).groupBy(*g, "b").agg(
        F.sum("credit").alias("credit"), F.sum(pos).alias("bpos"), F.sum(neg).alias("bneg"),
        F.sum(F.when(scored, 0).otherwise(F.col("pos") + F.col("neg"))).alias("n_unscored"),
        *_cell_sums(pos, neg, F.col("p")))
    before = Window.partitionBy(*g).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    below = F.coalesce(F.sum("bneg").over(before), F.lit(0))
    sums = ["credit", "bpos", "bneg", "n_unscored", "tp", "fp", "fn", "tn"]
    total = per_range.withColumn("credit", F.col("credit") + F.col("bpos") * below).groupBy(*g).agg(
        *[F.sum(c).alias(c) for c in sums])
    auc_value = F.try_divide(F.col("credit"), F.col("bpos").cast("double") * F.col("bneg")).alias("auc")
    n_unscored = F.coalesce("n_unscored", F.lit(0)).cast("long").alias("n_unscored")
    return total.select(*g, auc_value, *_threshold_columns(), n_unscored)


def auc(pred: DataFrame, label_col: str = "label", score_col: str = "score",
        group_cols: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """Exact area under the ROC curve, distributed (see :func:`metric_record`)."""
    return metric_record(pred, label_col, None, score_col, group_cols, buckets).select(*group_cols, "auc")


def auc_mllib(pred: DataFrame, label_col: str = "label", raw_col: str = "rawPrediction") -> float:
    """Cross-check: MLlib's exact evaluator (``numBins=0``) on a vector or score column."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    ev = BinaryClassificationEvaluator(labelCol=label_col, rawPredictionCol=raw_col,
                                       metricName="areaUnderROC", numBins=0)
    return ev.evaluate(pred.withColumn(label_col, F.col(label_col).cast("double")))


def evaluate_predictions(predictions: DataFrame, label_col: str = "label", score_source: str = "probability",
                         buckets: int | None = None) -> DataFrame:
    """A15 for MLlib output: one-row metric frame from ``model.transform(test)``.

    Takes the class-1 entry of ``score_source`` (``probability`` by default,
    ``rawPrediction`` for the original ranking) as the AUC score.  Lazy: the
    predictions are read once, when the frame is.
    """
    scored = positive_score(predictions, score_source).select(label_col, "prediction", "score")
    return metric_record(scored, label_col, "prediction", "score", buckets=buckets)
