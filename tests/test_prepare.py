"""Cleaning rules on hand-written edge frames (bounds, NULL order, flags, label)."""
import datetime as dt

from pyspark.sql import functions as F

from tipscope.operators import prepare as P
from tipscope.specs import TripSpec

SPEC = TripSpec()
SCHEMA = ("tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, passenger_count double, "
          "trip_distance double, RatecodeID double, PULocationID int, DOLocationID int, payment_type int, "
          "fare_amount double, extra double, tip_amount double, tolls_amount double, total_amount double, "
          "congestion_surcharge double, airport_fee double")
T0 = dt.datetime(2023, 1, 2, 10, 0, 0)  # a Monday


def trip(minutes=10.0, fare=10.0, dist=2.0, pc=1.0, pay=1, tip=2.0, rate=1.0, extra=None, start=T0):
    end = start + dt.timedelta(minutes=minutes)
    return (start, end, pc, dist, rate, 1, 2, pay, fare, extra, tip, None, None, None, None)


def clean(spark, rows):
    return P.clean_trips(spark.createDataFrame(rows, SCHEMA), SPEC)


def test_bounds_at_inside_and_outside(spark):
    cases = {
        "fare": ([trip(fare=0.01), trip(fare=499.99)], [trip(fare=0.0), trip(fare=500.0)]),
        "distance": ([trip(dist=0.1), trip(dist=99.0, minutes=60)], [trip(dist=0.0), trip(dist=100.0)]),
        "passengers": ([trip(pc=1.0), trip(pc=6.0)], [trip(pc=0.0), trip(pc=7.0), trip(pc=None)]),
        "duration": ([trip(minutes=1.0, dist=1.0), trip(minutes=180.0)], [trip(minutes=0.98), trip(minutes=180.02)]),
        "speed": ([trip(dist=100.0 / 60 * 10 - 1e-9, minutes=10.0)], [trip(dist=99.0, minutes=59.0)]),
        "payment": ([trip(pay=1)], [trip(pay=2), trip(pay=None)]),
    }
    for name, (keep, drop) in cases.items():
        assert clean(spark, keep).count() == len(keep), name
        assert clean(spark, drop).count() == 0, name


def test_speed_exactly_100_kept_and_just_above_dropped(spark):
    assert clean(spark, [trip(dist=50.0, minutes=30.0)]).count() == 1  # exactly 100 mph
    assert clean(spark, [trip(dist=50.05, minutes=30.0)]).count() == 0  # 100.1 mph


def test_duration_uses_whole_seconds(spark):
    start = dt.datetime(2023, 1, 2, 10, 0, 0, 900000)
    end = dt.datetime(2023, 1, 2, 10, 1, 0, 100000)  # 59.2 s apart, 60 whole seconds
    df = spark.createDataFrame([(start, end)], "a timestamp, b timestamp")
    spec = SPEC.with_(pickup="a", dropoff="b")
    assert P.add_duration(df, spec).first()["trip_duration_min"] == 1.0


def test_duration_ntz_matches_ltz(spark):
    rows = [(dt.datetime(2023, 3, 12, 1, 30), dt.datetime(2023, 3, 12, 3, 45, 30))]
    ntz = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    ltz = spark.createDataFrame(rows, "a timestamp, b timestamp")
    spec = SPEC.with_(pickup="a", dropoff="b")
    assert P.add_duration(ntz, spec).first()[2] == P.add_duration(ltz, spec).first()[2] == 135.5


def test_nulls_filtered_before_fill(spark):
    out = clean(spark, [trip(fare=None), trip(rate=None, extra=None)]).collect()
    assert len(out) == 1
    r = out[0]
    assert r["RatecodeID"] == 1.0 and r["extra"] == 0.0 and r["airport_fee"] == 0.0


def test_time_flags(spark):
    base = dt.datetime(2023, 1, 7)  # Saturday
    rows = [trip(start=base.replace(hour=h)) for h in (21, 22, 23, 0, 5, 6)]
    rows += [trip(start=dt.datetime(2023, 1, 8, 12)), trip(start=dt.datetime(2023, 1, 9, 12))]
    out = clean(spark, rows).select("pickup_hour", "pickup_dow", "is_weekend", "is_night").collect()
    night = {r["pickup_hour"]: r["is_night"] for r in out[:6]}
    assert night == {21: 0, 22: 1, 23: 1, 0: 1, 5: 1, 6: 0}
    assert [(r["pickup_dow"], r["is_weekend"]) for r in out[6:]] == [(1, 1), (2, 0)]
    assert out[0]["pickup_dow"] == 7 and out[0]["is_weekend"] == 1


def test_label_strict_threshold_and_null(spark):
    df = clean(spark, [trip(fare=10.0, tip=1.0), trip(fare=10.0, tip=0.99), trip(fare=10.0, tip=None)])
    labels = [r["label"] for r in P.add_label(df, SPEC).collect()]
    assert labels == [0, 1, None]


def test_clean_is_one_narrow_stage(spark):
    df = clean(spark, [trip()])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
