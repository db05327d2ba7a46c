"""Independent learner checks, exact samples and merged summary states."""
import glob

import numpy as np
import pytest
from pyspark.sql import functions as F

from tipscope.operators import explore as X
from tipscope.operators import moments as MO
from tipscope.operators import sampling as SM
from tipscope.operators import verify as V
from tipscope.plans import catalog as C
from tipscope.session import checkpoint_dir

from conftest import SF001


def test_newton_against_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(800, 2))
    y = (rng.random(800) < 1 / (1 + np.exp(-(0.4 + x @ [1.5, -0.7])))).astype(int)
    w = rng.uniform(0.5, 2, 800)
    rows = [(float(a), float(b), int(c), float(d)) for (a, b), c, d in zip(x, y, w)] + [(None, 1.0, 1, 1.0), (1.0, 1.0, None, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double, label int, w double")
    beta = V.newton_logistic(df, ["a", "b"], weight_col="w")
    design = np.column_stack([np.ones(800), x])
    gradient = design.T @ (w * (y - 1 / (1 + np.exp(-design @ beta))))
    assert np.abs(gradient).max() < 1e-8  # the maximum: the gradient vanishes
    with pytest.raises(ValueError):
        V.newton_logistic(df.withColumn("b", F.col("a") * 2), ["a", "b"])
    with pytest.raises(ValueError):
        V.newton_logistic(df.where("false"), ["a"])


def plain_root(rows, k):
    best = None
    total = [sum(w for *_, y, w in rows if y == c) for c in (0, 1)]
    gini = lambda a, b: 1 - (a * a + b * b) / (a + b) ** 2
    n = sum(total)
    for f in range(k):
        values = sorted({r[f] for r in rows})
        for lo, hi in zip(values, values[1:]):
            left = [sum(w for *x, y, w in rows if x[f] <= lo and y == c) for c in (0, 1)]
            right = [t - v for t, v in zip(total, left)]
            gain = gini(*total) - sum(left) / n * gini(*left) - sum(right) / n * gini(*right)
            if best is None or round(gain, 12) > round(best[2], 12):
                best = (f, (lo + hi) / 2, gain, sum(left), sum(right))
    return best


@pytest.mark.parametrize("seed", range(4))
def test_root_split_against_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(float(rng.integers(20)), float(rng.normal()), float(rng.integers(2)), int(rng.integers(2)), float(rng.integers(1, 4)))
            for _ in range(150)]
    rows = [(a, b, c, int(y or a > 14), w) for a, b, c, y, w in rows]
    df = spark.createDataFrame(rows, "a double, b double, c double, label int, w double").repartition(5)
    got, want = V.root_split(df, ["a", "b", "c"], weight_col="w").first(), plain_root(rows, 3)
    assert (got["feature"], got["threshold"]) == ("abc"[want[0]], want[1])
    assert [got["gain"], got["left_weight"], got["right_weight"]] == pytest.approx(want[2:])


def test_root_split_without_a_choice(spark):
    df = spark.createDataFrame([(1.0, 0), (1.0, 1), (None, 1)], "a double, label int")
    assert V.root_split(df, ["a"]).count() == 0
    assert V.root_split(df.where("false"), ["a"]).count() == 0


def test_target_sample_is_exact_and_layout_independent(spark):
    rows = spark.range(5000).withColumn("k", F.concat(F.lit("key "), F.col("id")))
    for k in (1, 17, 2500, 4999):
        sample = {r.id for r in SM.target_row_sample(rows, k, key="k").collect()}
        assert len(sample) == k
        assert sample == {r.id for r in SM.target_row_sample(rows.repartition(7), k, key="k").collect()}
    assert SM.target_row_sample(rows, 0, key="k").count() == 0 and SM.target_row_sample(rows, 9000, key="k").count() == 5000


def test_target_sample_with_one_hot_key(spark):
    """A third of the rows share a key, some are wholly equal, keys may be NULL."""
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 10 != 1, F.col("id").cast("string")).alias("k"),
                                    (F.col("id") % 50).alias("v"))
    for k in (10, 500, 1000, 2000, 2999):
        sample = SM.target_row_sample(rows, k, key="k")
        assert sample.count() == k and sample.exceptAll(rows).count() == 0


def test_states_merge_to_what_a_scan_gives(spark):
    data = C.t1_clean(spark, SF001).cache()
    cols = X.correlation_columns(C.T1)
    parts = [MO.pair_moments(data.where(F.col("trip_key") % 4 == i), cols) for i in range(4)]
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.unionByName(p)
    whole = {(r.i, r.j): r for r in MO.pair_moments(data, cols).collect()}
    rows = MO.merge_moments(merged).collect()
    assert len(rows) == len(whole)
    for r in rows:
        assert list(r) == pytest.approx(list(whole[r.i, r.j]), rel=1e-9, abs=1e-6)
    data.unpersist()


def test_moments_of_pairs_whose_spread_cancels(spark):
    """One far value outside a pair's rows must not cost the pair its digits; infinite values give NULL."""
    rows = [(1e9, None, 1.0), *((float(i), float(i * i % 7), float("inf") if i == 3 else 2.0) for i in range(12)), (None, 3.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r.col_a, r.col_b): r.r for r in X.correlation(df, ["a", "b", "c"]).collect()}
    a, b = [float(i) for i in range(12)], [float(i * i % 7) for i in range(12)]
    assert got["a", "b"] == pytest.approx(np.corrcoef(a, b)[0, 1], abs=1e-12) and got["c", "c"] is None and got["a", "c"] is None


def _counted(df, seen):
    """``df`` that adds its rows to an accumulator whenever it is evaluated."""
    def run(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch
    return df.mapInArrow(run, df.schema)


def test_state_and_moments_evaluate_their_rows_once(spark, tmpdir_path):
    data = C.t1_clean(spark, SF001).cache()
    n, sc = data.count(), spark.sparkContext
    seen = sc.accumulator(0)
    MO.pair_moments(_counted(data, seen), X.correlation_columns(C.T1))
    assert seen.value == n > 0
    seen = sc.accumulator(0)
    X.append_summary_state(_counted(data, seen), tmpdir_path, "all", C.T1)
    assert seen.value == n
    assert not glob.glob(f"{checkpoint_dir(spark).removeprefix('file:')}/state-rows-*")
    got = X.summaries_from_state(spark, tmpdir_path, C.T1)
    assert got["rows_per_month"].collect() == X.rows_per_month(data, C.T1.pickup).collect()
    want = {(r.col_a, r.col_b): r.r for r in X.correlation(data, X.correlation_columns(C.T1)).collect()}
    assert {(r.col_a, r.col_b): r.r for r in got["correlation"].collect()} == {k: v if v is None else pytest.approx(v, abs=1e-9) for k, v in want.items()}
    data.unpersist()


def test_equal_values_have_no_correlation_however_they_are_dealt(spark):
    """Equal values stay without spread when parts of any sizes merge; no rows give NULL for every pair."""
    rows = [(0.1 if i % 3 else None, float(i), 1e-3 if i % 7 else float(i)) for i in range(397)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    cols, few = ["a", "b", "c"], df.where("c = 0.001")
    sizes = [1, 2, 80, 3, 77, 55, 111]
    ends = [sum(sizes[:i]) for i in range(len(sizes) + 1)] + [397]
    parts = [MO.pair_moments(df.where(F.col("b").between(x, y - 1)), cols) for x, y in zip(ends, ends[1:])]
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.unionByName(p)
    for found in (MO.correlation_of(MO.merge_moments(merged), cols), X.correlation(df.repartition(7), cols)):
        got = {(r.col_a, r.col_b): r.r for r in found.collect()}
        assert [got["a", x] for x in cols] == [None] * 3 and got["b", "c"] is not None and got["b", "b"] == pytest.approx(1.0)
    assert {(r.col_a, r.col_b) for r in X.correlation(few.repartition(5), cols).where("r IS NULL").collect()} == {(x, y) for x in cols for y in cols} - {("b", "b")}
    assert [r.r for r in X.correlation(df.limit(0), cols).collect()] == [None] * 9


def test_no_job_at_call_time(spark):
    """Weights and class histograms are one lazy plan."""
    from tipscope.operators import balance as B

    data = C.t1_clean(spark, SF001)
    sc = spark.sparkContext
    sc.setJobGroup("lazy", "lazy")
    try:
        weighted = B.add_class_weights(data)
        histogram = X.class_histogram(data, limits=C.T1_HISTOGRAM_LIMITS)
        assert len(sc.statusTracker().getJobIdsForGroup("lazy")) == 0
        assert weighted.where("class_weight IS NULL").count() == 0 and histogram.count() > 0
        assert len(sc.statusTracker().getJobIdsForGroup("lazy")) > 0
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
