"""Model catalogue (L5-L10): four class-weighted MLlib classifiers.

Every tree learner gets an explicit seed (the default one is derived from a
Python string hash and changes between processes).
"""
from __future__ import annotations

from collections import OrderedDict

from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.sql import DataFrame

# Fixed hyper-parameters of the compared learners.
LR_PARAMS = {"maxIter": 50, "regParam": 0.0}
DT_PARAMS = {"maxDepth": 10, "maxBins": 64}
RF_PARAMS = {"numTrees": 50, "maxDepth": 10, "maxBins": 64}
GBT_PARAMS = {"maxIter": 50, "maxDepth": 6, "maxBins": 64}
MODEL_NAMES = ("LogisticRegression", "DecisionTree", "RandomForest", "GBT")


def make_models(
    features_col: str = "features",
    label_col: str = "label",
    weight_col: str | None = "class_weight",
    seed: int = 42,
    overrides: dict | None = None,
) -> "OrderedDict[str, object]":
    """Ordered name -> estimator map; ``weight_col=None`` trains unweighted.

    ``overrides`` maps a model name to parameter changes (used by the quick
    test suite to shrink iteration counts; defaults are the compared setup).
    """
    overrides = overrides or {}
    common = {"featuresCol": features_col, "labelCol": label_col}
    lr = LogisticRegression(**common, **{**LR_PARAMS, **overrides.get("LogisticRegression", {})})
    dt = DecisionTreeClassifier(**common, seed=seed, **{**DT_PARAMS, **overrides.get("DecisionTree", {})})
    rf = RandomForestClassifier(**common, seed=seed, **{**RF_PARAMS, **overrides.get("RandomForest", {})})
    gbt = GBTClassifier(**common, seed=seed, **{**GBT_PARAMS, **overrides.get("GBT", {})})
    models = OrderedDict(zip(MODEL_NAMES, (lr, dt, rf, gbt)))
    if weight_col is not None:
        for est in models.values():
            est.setWeightCol(weight_col)
    return models


def score(model, data: DataFrame, score_source: str = "probability") -> DataFrame:
    """Batch scoring plus a ``score`` column (class-1 probability by default).

    Ranking by ``probability`` rather than ``rawPrediction`` keeps a single
    tree's AUC meaningful (its raw output is unnormalised leaf weight).
    """
    from .metrics import positive_score

    return positive_score(model.transform(data), score_source)
