"""Evaluation: exact AUC against MLlib, invariants, one-pass threshold metrics."""
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from tipscope.operators import metrics as M


@pytest.fixture(scope="module")
def scored(spark):
    rnd = random.Random(7)
    rows = []
    for _ in range(3000):
        label = 1 if rnd.random() < 0.15 else 0
        score = round(rnd.random() * 0.6 + 0.3 * label, 2)  # heavy ties
        rows.append((label, score, float(score >= 0.5)))
    return spark.createDataFrame(rows, "label int, score double, prediction double").cache()


def mllib_auc(df):
    return BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0).evaluate(
        df.withColumn("label", F.col("label").cast("double")))


def test_auc_matches_mllib_with_ties(scored):
    ours = M.auc(scored).first()["auc"]
    assert abs(ours - mllib_auc(scored)) < 1e-12


@pytest.mark.parametrize("buckets", [1, 2, 7, 64])
def test_auc_independent_of_bucketing(scored, buckets):
    assert abs(M.auc(scored, buckets=buckets).first()["auc"] - mllib_auc(scored)) < 1e-12


def test_auc_invariant_to_monotone_transform(scored):
    a = M.auc(scored).first()["auc"]
    b = M.auc(scored.withColumn("score", F.exp(F.col("score") * 3))).first()["auc"]
    assert abs(a - b) < 1e-12


def test_auc_undefined_for_one_class(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.2)], "label int, score double")
    assert M.auc(df).first()["auc"] is None


def test_threshold_metrics_match_mllib(scored):
    got = M.threshold_metrics(scored).first()
    df = scored.withColumn("label", F.col("label").cast("double"))
    for ours, theirs in [("accuracy", "accuracy"), ("f1", "f1"), ("precision_w", "weightedPrecision"),
                         ("recall_w", "weightedRecall")]:
        ref = MulticlassClassificationEvaluator(metricName=theirs).evaluate(df)
        assert abs(got[ours] - ref) < 1e-12, ours
    assert got["recall_w"] == pytest.approx(got["accuracy"])
    assert got["recall_pos"] == pytest.approx(got["tp"] / (got["tp"] + got["fn"]))


def test_recall_pos_zero_without_positives(spark):
    df = spark.createDataFrame([(0, 0.0), (0, 1.0)], "label int, prediction double")
    assert M.threshold_metrics(df).first()["recall_pos"] == 0.0


def test_single_predicted_class(spark):
    df = spark.createDataFrame([(0, 0.0), (1, 0.0), (0, 0.0)], "label int, prediction double")
    r = M.threshold_metrics(df).first()
    assert r["tp"] == 0 and r["accuracy"] == pytest.approx(2 / 3)


def test_grouped_metric_record(scored):
    long = scored.withColumn("model", F.lit("a")).unionByName(
        scored.withColumn("model", F.lit("b")).withColumn("score", -F.col("score")))
    rec = {r["model"]: r for r in M.metric_record(long, group_cols=["model"]).collect()}
    assert abs(rec["a"]["auc"] + rec["b"]["auc"] - 1.0) < 1e-12


def test_auc_continuous_scores_many_buckets(spark):
    rnd = random.Random(11)
    rows = [(int(rnd.random() < 0.2), rnd.gauss(0, 1)) for _ in range(5000)]
    df = spark.createDataFrame(rows, "label int, score double")
    df = df.withColumn("score", F.col("score") + F.col("label") * 0.7).cache()
    assert abs(M.auc(df, buckets=50).first()["auc"] - mllib_auc(df)) < 1e-12


def test_missing_scores_leave_every_metric(spark):
    rows = [(1, 0.9, 1.0), (0, 0.1, 0.0), (1, float("nan"), 0.0), (0, None, 1.0), (None, 0.5, 1.0), (1, 0.3, None)]
    df = spark.createDataFrame(rows, "label int, score double, prediction double")
    r = M.metric_record(df).first()
    assert (r["auc"], r["accuracy"], r["n_unscored"]) == (1.0, 1.0, 3)
    none = M.metric_record(df.limit(0)).first()
    assert none["auc"] is None and none["n_unscored"] == 0


def test_metric_record_reads_its_input_once(spark, tmpdir_path):
    spark.range(1000).selectExpr("cast(id % 2 as int) label", "rand(1) score", "cast(id % 3 as double) prediction").write.parquet(tmpdir_path + "/p")
    rec = M.metric_record(spark.read.parquet(tmpdir_path + "/p"))
    plan = rec._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Broadcast" not in plan


def test_auc_with_one_hot_score_holding_a_third_of_rows(spark):
    rnd = random.Random(5)
    rows = [(int(rnd.random() < 0.3), 0.5) for _ in range(2000)]
    rows += [(int(rnd.random() < 0.1 + 0.5 * x), x) for x in (rnd.random() for _ in range(4000))]
    df = spark.createDataFrame(rows, "label int, score double").cache()
    assert abs(M.auc(df, buckets=32).first()["auc"] - mllib_auc(df)) < 1e-12


def test_metric_record_has_no_cross_product(scored):
    rec = M.metric_record(scored)
    rec.collect()
    plan = rec._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_evaluate_predictions_on_mllib_output(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    rnd = random.Random(3)
    rows = [(int(y), rnd.gauss(y * 1.0, 1.0)) for y in (rnd.random() < 0.3 for _ in range(600))]
    df = spark.createDataFrame(rows, "label int, x double")
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    preds = LogisticRegression(maxIter=10).fit(df).transform(df)
    rec = M.evaluate_predictions(preds).first()
    ref = BinaryClassificationEvaluator(numBins=0).evaluate(preds.withColumn("label", F.col("label").cast("double")))
    assert abs(rec["auc"] - ref) < 1e-12
