"""Sinks (write / reuse / append) and the streaming summary against the batch result."""
import os

from pyspark.sql import functions as F

from tipscope.operators import explore as X
from tipscope.operators import prepare as P
from tipscope.sources import sinks as SK
from tipscope.streaming import monthly as ST
from tipscope.plans import catalog as C

from conftest import SF001


def test_materialise_once_reuses(spark, tmpdir_path):
    path = SK.sample_path(tmpdir_path, rows=10, seed=1)
    assert path.endswith("rows=10_seed=1")
    calls = []

    def build():
        calls.append(1)
        return spark.range(10)

    assert SK.materialise_once(spark, path, build).count() == 10
    assert SK.materialise_once(spark, path, build).count() == 10
    assert len(calls) == 1


def test_append_metrics(spark, tmpdir_path):
    SK.append_metrics(spark.range(2), tmpdir_path, "r1", "models")
    SK.append_metrics(spark.range(3), tmpdir_path, "r2", "models")
    assert SK.read_metrics(spark, tmpdir_path, "models").count() == 5
    assert SK.read_metrics(spark, tmpdir_path, "models", "r2").count() == 3


def test_stream_summary_equals_batch(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    raw = C.t1_raw(spark, SF001)
    raw.write.parquet(src)
    stream = ST.trip_stream(spark, src, raw.schema, C.T1, max_files_per_trigger=1)
    out = os.path.join(tmpdir_path, "out")
    q = ST.start_summary(ST.monthly_summary(stream, C.T1), out, name="t_summary",
                         checkpoint=os.path.join(tmpdir_path, "ckpt"))
    q.awaitTermination(120)
    got = {r["month"]: r["n_rows"] for r in spark.read.parquet(out).collect()}
    batch = P.add_label(P.clean_trips(raw, C.T1), C.T1)
    want = {r["month"]: r["n_rows"] for r in X.rows_per_month(batch, "tpep_pickup_datetime").collect()}
    assert got == want and sum(got.values()) == 395


def test_trips_by_month_prune_partitions(spark, tmpdir_path):
    raw = C.t1_raw(spark, SF001)
    path = SK.write_trips_by_month(raw, tmpdir_path + "/by_month")
    back = SK.read_parquet(spark, path)
    assert back.count() == raw.count()
    one = back.where(F.col("month") == "1997-05")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "1997-05" in plan
    assert one.count() == raw.where(F.date_format("tpep_pickup_datetime", "yyyy-MM") == "1997-05").count()


def test_repeated_append_leaves_one_copy(spark, tmpdir_path):
    """A call repeated for the same run and entry (a retried step) replaces its rows; others stay."""
    for _ in range(2):
        SK.append_metrics(spark.range(2), tmpdir_path, "12e5", "models", entry="a")
    SK.append_metrics(spark.range(4), tmpdir_path, "12e5", "models", entry="b")
    SK.append_metrics(spark.range(1), tmpdir_path, "007", "models", entry="a")
    assert SK.read_metrics(spark, tmpdir_path, "models").count() == 7
    one = SK.read_metrics(spark, tmpdir_path, "models", "12e5")
    assert one.count() == 6 and {r.run_id for r in one.collect()} == {"12e5"} and one.columns == ["id", "run_id", "written_at"]


def test_two_builders_leave_one_complete_table(spark, tmpdir_path):
    from concurrent.futures import ThreadPoolExecutor
    from threading import Barrier

    path, both = tmpdir_path + "/once", Barrier(2)

    def build(tag):
        def rows():
            both.wait(60)  # neither commits before both have begun
            return spark.range(1000).withColumn("tag", F.lit(tag))
        return rows

    with ThreadPoolExecutor(2) as pool:
        frames = list(pool.map(lambda t: SK.materialise_once(spark, path, build(t)), ("x", "y")))
    assert [df.count() for df in frames] == [1000, 1000]
    assert spark.read.parquet(path).select("tag").distinct().count() == 1
    assert os.listdir(tmpdir_path) == ["once"]  # what the second one built is gone


def test_an_interrupted_table_is_built_anew(spark, tmpdir_path):
    path = tmpdir_path + "/half"
    spark.range(3).write.parquet(path)
    os.remove(path + "/_SUCCESS")
    assert SK.materialise_once(spark, path, lambda: spark.range(10)).count() == 10
