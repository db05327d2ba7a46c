"""Schema-drift ingest: int32 / int64 / double files in one folder become one canonical frame."""
import datetime as dt
import os
import subprocess
import sys

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tipscope.operators import prepare as P
from tipscope.sources import parquet as PQ
from tipscope.specs import CANONICAL_TYPES, TripSpec

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def write_month(path, month, pc_type, pay_type, n=50):
    start = [dt.datetime(2023, month, 1, 8) + dt.timedelta(minutes=7 * i) for i in range(n)]
    cols = {
        "tpep_pickup_datetime": pa.array(start, pa.timestamp("us")),
        "tpep_dropoff_datetime": pa.array([s + dt.timedelta(minutes=5 + i % 30) for i, s in enumerate(start)],
                                          pa.timestamp("us")),
        "passenger_count": pa.array([i % 8 for i in range(n)], pc_type),
        "trip_distance": pa.array([0.5 + i % 9 for i in range(n)], pa.float64()),
        "RatecodeID": pa.array([None if i % 5 == 0 else 1 for i in range(n)], pa.int64()),
        "PULocationID": pa.array([i for i in range(n)], pa.int32()),
        "DOLocationID": pa.array([i for i in range(n)], pa.int64()),
        "payment_type": pa.array([1 + i % 2 for i in range(n)], pay_type),
        "fare_amount": pa.array([5.0 + i for i in range(n)], pa.float64()),
        "extra": pa.array([None] * n, pa.float64()),
        "tip_amount": pa.array([(5.0 + i) * (0.05 if i % 3 == 0 else 0.2) for i in range(n)], pa.float64()),
        "tolls_amount": pa.array([0.0] * n, pa.float64()),
        "total_amount": pa.array([10.0] * n, pa.float64()),
        "congestion_surcharge": pa.array([2.5] * n, pa.float64()),
        "Airport_fee": pa.array([0.0] * n, pa.float64()),
        "store_and_fwd_flag": pa.array(["N"] * n, pa.string()),
    }
    pq.write_table(pa.table(cols), f"{path}/month_{month:02d}.parquet")


@pytest.fixture()
def drifted(tmpdir_path):
    write_month(tmpdir_path, 1, pa.int64(), pa.int64())
    write_month(tmpdir_path, 2, pa.float64(), pa.int32())
    write_month(tmpdir_path, 3, pa.int32(), pa.int64())
    write_month(tmpdir_path, 4, pa.int64(), pa.int64())
    return tmpdir_path


def test_load_trips_repairs_drift(spark, drifted):
    files = PQ.list_parquet_files(spark, drifted)
    assert len(files) == 4
    groups = PQ.group_by_schema(spark, files)
    assert len(groups) == 3  # months 1 and 4 share one scan
    df = PQ.load_trips(spark, drifted)
    assert df.count() == 200
    assert dict(df.dtypes) == {k: v for k, v in CANONICAL_TYPES.items()} | {
        "tpep_pickup_datetime": "timestamp", "tpep_dropoff_datetime": "timestamp"}
    assert [c for c in df.columns] == list(CANONICAL_TYPES)  # extra columns dropped


def test_folder_listing_leaves_nothing_out(spark, drifted, tmpdir_path):
    PQ.load_trips(spark, drifted).limit(30).coalesce(1).write.parquet(f"{drifted}/month_05.parquet")
    files = PQ.list_parquet_files(spark, drifted)
    assert len(files) == 5 and sum("month_05.parquet/part-" in f for f in files) == 1
    assert PQ.load_trips(spark, drifted).count() == 230
    spark.range(3).write.parquet(f"{drifted}/other")
    with pytest.raises(ValueError):
        PQ.list_parquet_files(spark, drifted)


def test_many_files_load_from_any_working_directory(spark, tmpdir_path):
    """70 files in two layouts, in a process that runs outside the repository."""
    for k in range(70):
        pq.write_table(pa.table({"fare_amount": pa.array([k], pa.int32() if k % 2 else pa.float64())}), f"{tmpdir_path}/f{k:02d}.parquet")
    code = (f"import sys; sys.path[:0] = {[ROOT, ROOT + '/tests']!r}\n"
            "from local_spark import session; from tipscope.sources import parquet as PQ; from tipscope.specs import TripSpec\n"
            "spark = session('elsewhere', 2)\n"
            f"df = PQ.load_trips(spark, {tmpdir_path!r}, TripSpec(canonical_types=(('fare_amount', 'double'),)))\n"
            "print('TOTAL', df.count(), df.agg({'fare_amount': 'sum'}).first()[0])\n")
    done = subprocess.run([sys.executable, "-c", code], cwd="/", capture_output=True, text=True, timeout=300)
    assert "TOTAL 70 2415.0" in done.stdout, done.stderr[-2000:]


def test_hours_are_those_of_the_file_in_any_session_zone(spark, drifted):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    df = P.add_time_features(PQ.load_trips(spark, drifted), TripSpec())
    hours = {r[0] for r in df.select("pickup_hour").distinct().collect()}
    assert hours == {8, 9, 10, 11, 12, 13}  # 08:00 and 50 trips seven minutes apart


def test_prefilter_equals_no_prefilter_on_inexact_columns(spark, tmpdir_path):
    write_month(tmpdir_path, 1, pa.int64(), pa.int64())
    odd = pq.read_table(f"{tmpdir_path}/month_01.parquet").to_pandas()
    odd["payment_type"] = [1.4 if i % 2 else 1.0 for i in range(len(odd))]
    odd.to_parquet(f"{tmpdir_path}/month_02.parquet")
    odd["payment_type"] = ["1" if i % 3 else "card" for i in range(len(odd))]
    odd["fare_amount"] = odd["fare_amount"].astype(str)
    odd.to_parquet(f"{tmpdir_path}/month_03.parquet")
    spec = TripSpec()
    plain, pushed = (P.clean_trips(PQ.load_trips(spark, tmpdir_path, spec, prefilter=p, safe=True), spec) for p in (False, True))
    assert plain.count() == pushed.count() > 60 and plain.exceptAll(pushed).count() == 0


def test_prefilter_does_not_change_cleaning(spark, drifted):
    spec = TripSpec()
    a = P.clean_trips(PQ.load_trips(spark, drifted, spec), spec)
    b = P.clean_trips(PQ.load_trips(spark, drifted, spec, prefilter=True), spec)
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    plan = b._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(fare_amount,0.0)" in plan  # value predicate reached the scan


def test_missing_file_raises(spark, tmpdir_path):
    with pytest.raises(FileNotFoundError):
        PQ.list_parquet_files(spark, tmpdir_path + "/nothing")


def test_missing_canonical_column_is_an_error(spark):
    df = spark.range(3).withColumnRenamed("id", "fare_amount")
    with pytest.raises(Exception):
        PQ.normalise(df, CANONICAL_TYPES).columns


def test_union_by_name_keeps_duplicates(spark):
    a = spark.range(3).select(F.col("id"), F.lit(1).alias("x"))
    b = spark.range(3).select(F.lit(1).alias("x"), F.col("id"))
    assert PQ.union_by_name([a, b]).count() == 6


def test_manifest_roundtrip_skips_footer_pass(spark, drifted, tmpdir_path):
    groups = PQ.group_by_schema(spark, PQ.list_parquet_files(spark, drifted))
    path = PQ.write_manifest(spark, groups, tmpdir_path + "/manifest")
    manifest = PQ.read_manifest(spark, path)
    assert sorted(map(sorted, manifest.values())) == sorted(map(sorted, groups.values()))
    assert PQ.load_trips(spark, drifted, manifest=manifest).count() == 200


def test_safe_normalise_turns_bad_values_into_null(spark):
    df = spark.createDataFrame([("1",), ("x",), ("3000000000",)], "payment_type string")
    got = [r[0] for r in PQ.normalise(df, {"payment_type": "int"}, safe=True).collect()]
    assert got == [1, None, None]
    with pytest.raises(Exception):
        PQ.normalise(df, {"payment_type": "int"}).collect()


def test_configure_sets_utc(spark):
    from tipscope.session import configure

    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    configure(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_default_taxi_spec_end_to_end(spark, drifted):
    from tipscope.plans import jobs as J
    from tipscope.operators import balance as B

    raw = PQ.load_trips(spark, drifted, prefilter=True)
    data = P.prepare(raw)
    n = data.count()
    assert 0 < n < 200
    assert dict(data.dtypes)["tpep_pickup_datetime"] == "timestamp"
    bal = B.balance_record(data)
    assert bal["total"] == n
    out = J.exploration(raw)
    assert out["retention"].first()["n_clean"] == n
    assert out["class_histogram"].count() > 0
    out = J.experiment(raw, models=["LogisticRegression"], fractions=(1.0,))
    assert out["summary"].first()["n_clean"] == n and out["summary"].first()["n_raw"] == raw.count()
    assert 0.0 <= out["models"].first()["auc"] <= 1.0


def test_plain_subfolders_are_one_dataset(spark, tmpdir_path):
    base = tmpdir_path + "/months"
    df = spark.range(20).select(F.col("id").alias("fare_amount")).coalesce(1)
    df.write.parquet(base + "/m1")
    df.select(F.col("fare_amount").cast("double")).write.parquet(base + "/m2")
    files = PQ.list_parquet_files(spark, base)
    assert len(files) == 2
    assert len(PQ.group_by_schema(spark, files)) == 2


def test_thousands_of_files_load_with_three_jobs(spark, tmpdir_path):
    """5,000 tiny files in two layouts: one census job and a listing job per layout."""
    for name, kind in (("a", pa.int32()), ("b", pa.float64())):
        pq.write_table(pa.table({"fare_amount": pa.array([1], kind)}), f"{tmpdir_path}/{name}.source")
    for k in range(5000):
        os.link(f"{tmpdir_path}/{'ab'[k % 2]}.source", f"{tmpdir_path}/f{k:04d}.parquet")
    sc = spark.sparkContext
    sc.setJobGroup("census", "census")
    try:
        df = PQ.load_trips(spark, tmpdir_path, TripSpec(canonical_types=(("fare_amount", "double"),)))
        assert len(sc.statusTracker().getJobIdsForGroup("census")) <= 3
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert df.count() == 5000 and df.agg(F.sum("fare_amount")).first()[0] == 5000.0


def test_census_gives_the_schemas_that_spark_infers(spark, tmpdir_path):
    """Types of the footers, of Spark's own files and of files that Spark itself must judge."""
    now = dt.datetime(2024, 1, 1)
    tables = {
        "flat": pa.table({"a": pa.array([1], pa.int8()), "b": pa.array([1], pa.int16()), "c": pa.array([1], pa.int64()), "d": pa.array([1.0], pa.float32()),
                          "e": pa.array([True]), "f": pa.array(["x"]), "g": pa.array([b"x"]), "h": pa.array([now.date()]),
                          "i": pa.array([now], pa.timestamp("us")), "j": pa.array([now], pa.timestamp("ms", "UTC"))}),
        "decimals": pa.table({"a": pa.array([1], pa.decimal128(9, 2)), "b": pa.array([1], pa.decimal128(30, 4))}),
        "unsigned": pa.table({"a": pa.array([1], pa.uint8()), "b": pa.array([1], pa.uint32()), "c": pa.array([1], pa.uint64())}),
        "nested": pa.table({"a": pa.array([[1, 2]]), "b": pa.array([{"x": 1}])}),
        "categories": pa.table({"a": pa.array(["x"]).dictionary_encode(), "b": pa.array([1], pa.time64("us"))}).drop(["b"]),
    }
    for name, t in tables.items():
        pq.write_table(t, f"{tmpdir_path}/{name}.parquet")
    spark.sql("SELECT 1 AS a, array(1) AS b, cast('x' AS char(3)) AS c").coalesce(1).write.parquet(f"{tmpdir_path}/spark.parquet")
    files = PQ.list_parquet_files(spark, tmpdir_path)
    for key, group in PQ.group_by_schema(spark, files).items():
        for f in group:
            want = spark.read.parquet(f)
            assert PQ.group_schema(spark, key, group).simpleString() == want.schema.simpleString(), f
            assert spark.read.schema(PQ.group_schema(spark, key, group)).parquet(f).collect() == want.collect()
