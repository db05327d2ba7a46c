"""Learners end to end on the learnable fixture (small iteration counts)."""
import pytest

from tipscope.operators import balance as B
from tipscope.operators import compare as CMP
from tipscope.operators import features as FE
from tipscope.operators import models as MD
from tipscope.operators import sampling as SM
from tipscope.plans import catalog as C
from tipscope.sources import adapters as A

from pyspark.sql import functions as F

from conftest import SF001, SF01

QUICK = {"RandomForest": {"numTrees": 5, "maxDepth": 4}, "GBT": {"maxIter": 5, "maxDepth": 3},
         "LogisticRegression": {"maxIter": 10}, "DecisionTree": {"maxDepth": 4}}


def test_catalogue_weights_and_seed(spark):
    models = MD.make_models()
    assert list(models) == ["LogisticRegression", "DecisionTree", "RandomForest", "GBT"]
    for est in models.values():
        assert est.getWeightCol() == "class_weight"
    assert models["RandomForest"].getSeed() == 42
    assert not MD.make_models(weight_col=None)["GBT"].isSet("weightCol")


@pytest.fixture(scope="module")
def split(spark):
    docs = A.document_quality(spark, SF01)
    w = B.add_class_weights(docs, "label")
    feat = FE.build_feature_pipeline(C.QUALITY_SPEC).fit(w).transform(w).select(
        "doc_id", "features", "label", "class_weight")
    return SM.hash_split(feat, "doc_id", (0.8, 0.2))


def test_train_and_compare(spark, split):
    train, test = split
    board = CMP.train_and_compare(MD.make_models(overrides=QUICK), train, test)
    rows = board.collect()
    assert [r["model"] for r in rows] == ["LogisticRegression", "DecisionTree", "RandomForest", "GBT"]
    for r in rows:
        assert 0.0 <= r["auc"] <= 1.0 and 0.0 <= r["recall_pos"] <= 1.0 and r["train_seconds"] > 0
        assert r["recall_w"] == pytest.approx(r["accuracy"])
    # the fixture carries signal (upper-case share separates the classes); trees find it
    assert max(r["auc"] for r in rows) > 0.7
    best = CMP.best_model(board).first()
    assert best["best_auc_model"] in MD.MODEL_NAMES and best["fastest_model"] in MD.MODEL_NAMES
    trade = CMP.cost_tradeoff(board).collect()
    assert any(r["pareto"] for r in trade)
    fastest = min(trade, key=lambda r: r["train_seconds"])
    assert fastest["pareto"]
    rep = CMP.report_rows(board).first()
    assert rep["auc"] == round(rows[0]["auc"], 3)


def test_concurrent_fits_give_the_same_board(spark, split, tmpdir_path):
    train, test = split
    seen = []
    one = CMP.train_and_compare(MD.make_models(overrides=QUICK), train, test).drop("train_seconds").collect()
    four = CMP.train_and_compare(MD.make_models(overrides=QUICK), train, test, concurrent=4, on_result=lambda r: seen.append(r.first()["model"]))
    assert four.drop("train_seconds").collect() == one and sorted(seen) == sorted(MD.MODEL_NAMES)


def test_experiment_job_both_modes(spark, tmpdir_path):
    from tipscope.plans import jobs as J
    from tipscope.specs import LINEITEM_TRIPS

    raw = A.trips_from_lineitem(spark, SF01)
    for split_first in (False, True):
        out = J.experiment(raw, LINEITEM_TRIPS, train_rows=2000, key="trip_key", model_overrides=QUICK,
                           fractions=(0.5, 1.0), metrics_path=tmpdir_path, models=["LogisticRegression", "GBT"],
                           split_first=split_first)
        board = out["models"].collect()
        assert [r["model"] for r in board] == ["LogisticRegression", "GBT"]
        summ = out["summary"].first()
        assert summ["n_clean"] == 3956 and summ["n_train"] + summ["n_test"] > 0
        assert out["data_scaling"].count() == 2
    from tipscope.sources import sinks as SK
    assert SK.read_metrics(spark, tmpdir_path, "models").count() == 4


def test_exploration_and_parallelism_jobs(spark, tmpdir_path):
    from tipscope.plans import jobs as J
    from tipscope.specs import LINEITEM_TRIPS
    from tipscope.sources import sinks as SK

    raw = A.trips_from_lineitem(spark, SF01)
    out = J.exploration(raw, LINEITEM_TRIPS, histogram_limits=C.T1_HISTOGRAM_LIMITS, metrics_path=tmpdir_path)
    assert out["balance"].first()["total"] == 3956
    assert out["correlation"].count() == 13 * 13
    assert SK.read_metrics(spark, tmpdir_path, "exploration_rate_by_hour").count() == 1  # midnight dates
    samples, metrics = tmpdir_path + "/samples", tmpdir_path + "/scaling"
    rows = J.parallelism(raw, samples, metrics, LINEITEM_TRIPS, rows=2000).collect()
    assert [r["cores"] for r in rows] == [spark.sparkContext.defaultParallelism] and rows[0]["speedup"] == 1.0
    assert J.source_key(raw, LINEITEM_TRIPS, "r") != J.source_key(A.trips_from_lineitem(spark, SF001), LINEITEM_TRIPS, "r")
    assert J.source_key(raw, LINEITEM_TRIPS, "r") != J.source_key(raw, LINEITEM_TRIPS.with_(threshold=0.5), "r")
    # another submission with other cores adds its level to the table
    run = SK.read_metrics(spark, metrics, "parallelism").drop("run_id", "written_at")
    SK.append_metrics(run.withColumn("cores", F.col("cores") * 2).withColumn("train_seconds", F.col("train_seconds") / 2), metrics, "r2", "parallelism")
    rows = J.parallelism(raw, samples, metrics, LINEITEM_TRIPS, rows=2000).orderBy("cores").collect()
    assert len(rows) == 2 and rows[1]["ideal"] == 2.0


def test_tradeoff_and_best_model_ties(spark):
    board = spark.createDataFrame(
        [("b", 0.9, 0.5, 0.5, 1.0), ("a", 0.9, 0.5, 0.6, 1.0), ("c", 0.9, 0.7, 0.6, 2.0), ("d", None, None, None, 0.5), ("e", 0.8, 0.1, 0.1, 0.7),
         ("f", 0.95, 0.1, 0.1, 3.0)], "model string, auc double, f1 double, recall_pos double, train_seconds double")
    flags = {r["model"]: r["pareto"] for r in CMP.cost_tradeoff(board).collect()}
    assert flags == {"a": True, "b": True, "c": False, "d": False, "e": True, "f": True}
    best = CMP.best_model(board).first()
    assert (best["best_auc_model"], best["best_f1_model"], best["best_recall_pos_model"], best["fastest_model"]) == ("f", "c", "a", "d")


def test_jobs_leave_nothing_cached(spark):
    from tipscope.plans import jobs as J
    from tipscope.specs import LINEITEM_TRIPS

    spark.catalog.clearCache()
    stored = lambda: spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    before = stored()
    raw = A.trips_from_lineitem(spark, SF001)
    J.experiment(raw, LINEITEM_TRIPS, model_overrides=QUICK, models=["LogisticRegression"], fractions=(1.0,))
    J.exploration(raw, LINEITEM_TRIPS, histogram_limits=C.T1_HISTOGRAM_LIMITS)
    assert stored() == before
