"""The reference's smoke checks, on the trip-shaped fixture: derived columns, binary
label, low-tip minority, and clean -> weights -> recipe -> split -> LR -> metrics."""
import pytest

from tipscope.operators import balance as B
from tipscope.operators import compare as CMP
from tipscope.operators import features as FE
from tipscope.operators import models as MD
from tipscope.operators import prepare as P
from tipscope.operators import sampling as SM
from tipscope.sources import adapters as A
from tipscope.specs import LINEITEM_TRIPS as T1

from conftest import SF01


@pytest.fixture(scope="module")
def sample(spark):
    raw = A.trips_from_lineitem(spark, SF01)
    return SM.hash_sample(P.add_label(P.clean_trips(raw, T1), T1), "trip_key", 0.5).cache()


def test_clean_produces_required_columns(sample):
    assert {"label", "trip_duration_min", "avg_speed_mph", "pickup_hour"} <= set(sample.columns)


def test_label_is_binary(sample):
    assert {r["label"] for r in sample.select("label").distinct().collect()} <= {0, 1}


def test_low_tip_is_the_minority(sample):
    bal = B.balance_record(sample)
    assert bal["total"] > 0 and 0.0 < bal["pos_rate"] < 0.5


def test_end_to_end_training(sample):
    weighted = B.add_class_weights(sample)
    feat = FE.model_columns(FE.build_feature_pipeline(T1).fit(weighted).transform(weighted), T1)
    train, test = SM.random_split(feat.cache(), (0.8, 0.2), seed=1)
    board = CMP.train_and_compare({"LogisticRegression": MD.make_models()["LogisticRegression"]}, train, test)
    r = board.first()
    assert r["train_seconds"] > 0 and 0.0 <= r["auc"] <= 1.0 and 0.0 <= r["recall_pos"] <= 1.0
