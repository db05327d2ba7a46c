"""Exploratory aggregates: correlation vs pandas, histograms, rates, scaling tables."""
import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tipscope.operators import explore as X
from tipscope.operators import scaling as SC


def test_correlation_matches_pandas_pairwise(spark):
    rows = [(1.0, 2.0, None), (2.0, 4.1, 1.0), (3.0, 5.9, 0.0), (4.0, None, 1.0), (5.0, 10.2, 3.0),
            (6.0, 11.0, 2.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r["col_a"], r["col_b"]): r["r"] for r in X.correlation(df, ["a", "b", "c"]).collect()}
    ref = pd.DataFrame(rows, columns=["a", "b", "c"]).corr()
    for a in "abc":
        for b in "abc":
            assert got[(a, b)] == pytest.approx(ref.loc[a, b], abs=1e-12)


def test_correlation_constant_column_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (2.0, 0.0)], "a double, z double")
    got = {(r["col_a"], r["col_b"]): r["r"] for r in X.correlation(df, ["a", "z"]).collect()}
    assert got[("a", "z")] is None and got[("a", "a")] == pytest.approx(1.0)


def test_class_histogram_area_is_one(spark):
    rows = [(float(i % 37), float(i % 11) + 0.5, float(i), i % 3 == 0) for i in range(500)]
    df = spark.createDataFrame(rows, "trip_distance double, trip_duration_min double, fare_amount double, l boolean")
    df = df.withColumn("label", F.col("l").cast("int"))
    h = X.class_histogram(df, limits=None)
    width = {}
    for r in h.collect():
        width.setdefault((r["feature"], r["label"]), []).append(r)
    for key, bins in width.items():
        assert len(bins) <= 40
    stats = df.groupBy("label").agg(F.min("fare_amount").alias("lo"), F.max("fare_amount").alias("hi")).collect()
    for s in stats:
        w = (s["hi"] - s["lo"]) / 40
        area = sum(r["density"] * w for r in width[("fare_amount", s["label"])])
        assert area == pytest.approx(1.0)


def test_ratio_histogram_and_rates(spark):
    df = spark.createDataFrame([(0.0,), (0.019,), (0.02,), (0.59,), (0.7,), (None,)], "tip_pct double")
    h = {r["bin_idx"]: r["n_rows"] for r in X.ratio_histogram(df).collect()}
    assert h == {0: 2, 1: 1, 29: 1}


def test_month_prefix(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.datetime(2022, 12, 31),), (dt.datetime(2023, 1, 1),),
                                (dt.datetime(2023, 1, 2),)], "t timestamp")
    out = [(r["month"], r["n_rows"]) for r in X.rows_per_month(df, "t", "2023").collect()]
    assert out == [("2023-01", 2)]


def test_speedup_and_linear_reference(spark):
    t = spark.createDataFrame([(4, 11.03), (1, 30.47), (2, 15.82), (8, 6.46)], "cores int, train_seconds double")
    rows = {r["cores"]: r for r in SC.speedup(t).collect()}
    assert rows[1]["speedup"] == 1.0 and rows[8]["ideal"] == 8.0
    assert rows[8]["speedup"] == pytest.approx(30.47 / 6.46)
    d = spark.createDataFrame([(200, 4.0), (100, 3.0)], "n_rows long, train_seconds double")
    lin = {r["n_rows"]: r["linear_seconds"] for r in SC.linear_reference(d).collect()}
    assert lin == {100: 3.0, 200: 6.0}
    assert not math.isnan(lin[200])


def test_class_histogram_matches_numpy_including_constant_slice(spark):
    import numpy as np

    rows = [(float(i % 13) * 1.7, 5.0, float(i) ** 0.5, i % 4 == 0) for i in range(300)]
    df = spark.createDataFrame(rows, "trip_distance double, trip_duration_min double, fare_amount double, l boolean")
    df = df.withColumn("label", F.col("l").cast("int"))
    got = {}
    for r in X.class_histogram(df, limits=None).collect():
        got[(r["feature"], r["label"], r["bin"])] = r["density"]
    pdf = df.toPandas()
    for feat in ("trip_distance", "trip_duration_min", "fare_amount"):
        for lab in (0, 1):
            dens, _ = np.histogram(pdf[pdf.label == lab][feat], bins=40, density=True)
            for b, dv in enumerate(dens):
                assert got.get((feat, lab, b), 0.0) == pytest.approx(dv), (feat, lab, b)


def test_grouped_summaries_equal_the_single_operators(spark):
    from tipscope.operators import balance as B
    from tipscope.plans import catalog as C

    data = C.t1_clean(spark, "/root/testdata/sf0.01").cache()
    got = X.grouped_summaries(data, C.T1, month_prefix="1999")
    want = {
        "balance": B.class_balance(data),
        "rows_per_month": X.rows_per_month(data, "tpep_pickup_datetime", "1999"),
        "ratio_histogram": X.ratio_histogram(data),
        "rate_by_hour": X.rate_by_hour(data, "tpep_pickup_datetime"),
        "rate_by_weekday": X.rate_by_weekday(data, "tpep_pickup_datetime"),
    }
    for name, df in want.items():
        assert got[name].columns == df.columns, name
        assert got[name].dtypes == df.dtypes, name
        assert got[name].collect() == df.collect(), name
    data.unpersist()


def test_class_histogram_values_on_bin_edges_follow_numpy(spark):
    import numpy as np

    edges = np.linspace(0.0, 7.3, 41)
    vals = [float(e) for e in edges] + [0.1 * k for k in range(74)]  # every edge plus a grid of decimals
    rows = [(v, 1.0 + (i % 5), float(i), 0) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "trip_distance double, trip_duration_min double, fare_amount double, label int")
    got = {r["bin"]: r["n_rows"] for r in X.class_histogram(df, limits=None).collect()
           if r["feature"] == "trip_distance"}
    counts, _ = np.histogram(np.array(vals), bins=40)
    assert [got.get(b, 0) for b in range(40)] == list(counts)


def test_correlation_of_many_columns_with_gaps_and_nan(spark):
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 70)) + rng.normal(size=(400, 1)) + 1e6
    x[rng.random(x.shape) < 0.1] = np.nan
    x[:, 3] = 0.1
    pdf = pd.DataFrame(x, columns=[f"c{i}" for i in range(70)])
    df = spark.createDataFrame(pdf).withColumn("c5", F.when(~F.isnan("c5"), F.col("c5"))).repartition(5)
    want = pdf.corr()
    for r in X.correlation(df, list(pdf.columns)).collect():
        expected = want.loc[r["col_a"], r["col_b"]]
        if "c3" in (r["col_a"], r["col_b"]):
            assert r["r"] is None
        else:
            assert r["r"] == pytest.approx(expected, abs=1e-9)
