"""Independent recomputation of learned quantities.

* :func:`newton_logistic`: maximum-likelihood logistic regression by Newton
  steps; a step is one global aggregate (gradient and Hessian), so it scales
  like any sum and needs nothing of the learner it checks.
* :func:`root_split`: the best first split of a decision tree from weighted
  class counts per distinct value, a shuffle on (feature, value).
* :func:`linear_coefficients`, :func:`tree_root`: the same quantities of a
  fitted MLlib model.
"""
from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from ..sources.sinks import new_run_id, read_parquet, write_parquet


def _weight(weight_col: str | None) -> Column:
    return F.lit(1.0) if weight_col is None else F.col(weight_col).cast("double")


def newton_logistic(df: DataFrame, features: Sequence[str], label_col: str = "label", weight_col: str | None = None,
                    steps: int = 25, tolerance: float = 1e-12) -> list[float]:
    """Intercept and coefficients of the unpenalised weighted logistic regression.

    Stops when no coefficient moves by more than ``tolerance``; a singular
    Hessian (collinear columns, separable or empty data) raises ``ValueError``.
    Rows with a NULL label or feature are left out.
    """
    x = [F.lit(1.0), *[F.col(c).cast("double") for c in features]]
    y, w, k = F.col(label_col).cast("double"), _weight(weight_col), len(features) + 1
    rows = df.select(*[c.alias(f"x{i}") for i, c in enumerate(x)], y.alias("y"), w.alias("w")).dropna()
    beta = np.zeros(k)
    for _ in range(steps):
        margin = sum((F.col(f"x{i}") * float(beta[i]) for i in range(1, k)), F.lit(float(beta[0])))
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))
        judged = rows.withColumn("p", p).withColumn("h", F.col("w") * F.col("p") * (1 - F.col("p")))
        sums = judged.agg(
            *[F.sum(F.col("w") * (F.col("y") - F.col("p")) * F.col(f"x{i}")).alias(f"g{i}") for i in range(k)],
            *[F.sum(F.col("h") * F.col(f"x{i}") * F.col(f"x{j}")).alias(f"h{i}_{j}") for i in range(k) for j in range(i, k)]).first()
        if sums["g0"] is None:
            raise ValueError("no complete rows")
        gradient = np.array([sums[f"g{i}"] for i in range(k)])
        hessian = np.array([[sums[f"h{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)])
        if np.linalg.cond(hessian) > 1e14:
            raise ValueError("singular Hessian: collinear columns or separable classes")
        move = np.linalg.solve(hessian, gradient)
        beta = beta + move
        if np.abs(move).max() < tolerance:
            break
    return [float(b) for b in beta]


def root_split(df: DataFrame, features: Sequence[str], label_col: str = "label", weight_col: str | None = None) -> DataFrame:
    """One row: (feature, threshold, gain, left_weight, right_weight) of the split that
    lowers the weighted Gini impurity most; rows with value <= threshold go left.

    Thresholds are midpoints between neighbouring distinct values.  Ties go to
    the first feature, then the smallest threshold; no rows or no two distinct
    values give no row.  NULL labels and values are left out, feature by feature.
    """
    cells = F.array(*[F.struct(F.lit(i).alias("f"), F.col(c).cast("double").alias("v")) for i, c in enumerate(features)])
    rows = df.where(F.col(label_col).isNotNull()).select(F.inline(cells), (F.col(label_col) == 1).alias("pos"), _weight(weight_col).alias("w"))
    per_value = rows.where("v IS NOT NULL").groupBy("f", "v").agg(
        F.sum(F.when(F.col("pos"), F.col("w")).otherwise(0.0)).alias("w1"),
        F.sum(F.when(F.col("pos"), 0.0).otherwise(F.col("w"))).alias("w0"))
    # running counts within ranges of values, then of the ranges before: no feature is sorted in one task.
    # The ranges are written once, since both steps must see the same ones.
    spark = df.sparkSession
    ranges = read_parquet(spark, write_parquet(per_value.repartitionByRange("f", "v").withColumn("b", F.spark_partition_id()),
                                               f"{checkpoint_dir(spark).rstrip('/')}/splits-{new_run_id()}"))
    inside = Window.partitionBy("f", "b").orderBy("v")
    ranged = ranges.withColumns({"l1": F.sum("w1").over(inside), "l0": F.sum("w0").over(inside), "next": F.lead("v").over(inside)})
    totals = ranges.groupBy("f", "b").agg(F.sum("w1").alias("t1"), F.sum("w0").alias("t0"), F.min("v").alias("first_v"))
    before = Window.partitionBy("f").orderBy("b")  # a row per range
    whole = Window.partitionBy("f")
    totals = totals.withColumns({
        "b1": F.sum("t1").over(before) - F.col("t1"), "b0": F.sum("t0").over(before) - F.col("t0"),
        "a1": F.sum("t1").over(whole), "a0": F.sum("t0").over(whole), "next_first": F.lead("first_v").over(before)})
    joined = ranged.join(totals, ["f", "b"]).withColumn("next", F.coalesce("next", "next_first")).where("next IS NOT NULL")
    l1, l0 = F.col("l1") + F.col("b1"), F.col("l0") + F.col("b0")

    def gini(one, zero):
        n = one + zero
        return 1.0 - (one * one + zero * zero) / (n * n)

    a1, a0 = F.col("a1"), F.col("a0")
    n, left, right = a1 + a0, l1 + l0, a1 + a0 - l1 - l0
    gain = gini(a1, a0) - left / n * gini(l1, l0) - right / n * gini(a1 - l1, a0 - l0)
    split = F.struct(F.round(gain, 12).alias("order"), -F.col("f"), -F.col("v"), gain.alias("gain"), F.col("f").alias("f"),
                     ((F.col("v") + F.col("next")) / 2).alias("threshold"), left.alias("left"), right.alias("right"))
    best = joined.where((left > 0) & (right > 0)).agg(F.max(split).alias("s")).where("s IS NOT NULL")
    names = F.array(*[F.lit(c) for c in features])
    return best.select(F.element_at(names, F.col("s.f") + 1).alias("feature"), "s.threshold", "s.gain",
                       F.col("s.left").alias("left_weight"), F.col("s.right").alias("right_weight"))


def linear_coefficients(model) -> list[float]:
    """Intercept and coefficients of a fitted MLlib logistic regression."""
    return [float(model.intercept), *map(float, model.coefficients.toArray())]


def tree_root(model, features: Sequence[str]) -> tuple[str, float] | None:
    """(feature, threshold) of the first split of a fitted tree, or of an
    ensemble's first tree; None if it is a leaf."""
    tree = model.trees[0] if hasattr(model, "trees") else model
    root = tree._java_obj.rootNode()
    if root.getClass().getSimpleName() != "InternalNode":
        return None
    return features[root.split().featureIndex()], float(root.split().threshold())
