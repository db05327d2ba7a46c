"""Property tests: Spark operators against brute-force Python on random small fixtures."""
import datetime as dt

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from tipscope.operators import metrics as M
from tipscope.operators import prepare as P
from tipscope.specs import TripSpec

SPEC = TripSpec()
T0 = dt.datetime(2023, 3, 1, 0, 0, 0)
SCHEMA = ("tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, passenger_count double, "
          "trip_distance double, RatecodeID double, PULocationID int, DOLocationID int, payment_type int, "
          "fare_amount double, extra double, tip_amount double, tolls_amount double, total_amount double, "
          "congestion_surcharge double, airport_fee double")

maybe = lambda s: st.one_of(st.none(), s)
trip = st.tuples(
    st.integers(0, 60 * 24 * 7),                                   # pickup offset, minutes
    maybe(st.integers(-120, 60 * 200)),                            # duration, seconds / 1 (scaled below)
    maybe(st.sampled_from([0.0, 1.0, 3.0, 6.0, 7.0])),            # passengers
    maybe(st.sampled_from([0.0, 0.5, 2.0, 30.0, 99.9, 100.0])),   # distance
    maybe(st.sampled_from([1, 2])),                                # payment type
    maybe(st.sampled_from([0.0, 0.01, 12.5, 499.99, 500.0])),     # fare
    maybe(st.sampled_from([0.0, 0.5, 1.0, 3.0])),                 # tip
)


def brute_clean(rows):
    kept = []
    for start, dur_s, pc, dist, pay, fare, tip in rows:
        if dur_s is None or pay != 1 or fare is None or dist is None or pc is None:
            continue
        minutes = dur_s * 30 / 60.0  # durations are whole multiples of 30 s
        if not (0 < fare < 500 and 0 < dist < 100 and 1 <= pc <= 6 and 1 <= minutes <= 180):
            continue
        speed = dist / (minutes / 60.0)
        if not (0 < speed <= 100):
            continue
        label = None if tip is None else int(tip / fare < 0.10)
        kept.append(label)
    return sorted(kept, key=lambda v: (v is None, v))


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(trip, min_size=0, max_size=25))
def test_clean_and_label_match_brute_force(spark, rows):
    data = []
    for start, dur_s, pc, dist, pay, fare, tip in rows:
        pick = T0 + dt.timedelta(minutes=start)
        drop = None if dur_s is None else pick + dt.timedelta(seconds=dur_s * 30)
        data.append((pick, drop, pc, dist, None, 1, 2, pay, fare, None, tip, None, None, None, None))
    df = spark.createDataFrame(data, SCHEMA)
    got = [r["label"] for r in P.add_label(P.clean_trips(df, SPEC), SPEC).select("label").collect()]
    assert sorted(got, key=lambda v: (v is None, v)) == brute_clean(rows)


def brute_auc(pairs):
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    if not pos or not neg:
        return None
    wins = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 1), st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.7, 0.9, 1.0])),
                min_size=1, max_size=60),
       st.integers(1, 6))
def test_auc_matches_brute_force(spark, pairs, buckets):
    df = spark.createDataFrame(pairs, "label int, score double")
    got = M.auc(df, buckets=buckets).first()
    want = brute_auc(pairs)
    if want is None:
        assert got is None or got["auc"] is None
    else:
        assert abs(got["auc"] - want) < 1e-12


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture], phases=[Phase.explicit, Phase.reuse, Phase.generate])
@given(st.lists(st.tuples(*[maybe(st.floats(-50, 50, allow_nan=False)) for _ in range(4)]),
                min_size=3, max_size=40))
def test_correlation_matches_pandas_pairwise(spark, rows):
    import math

    import pandas as pd

    from tipscope.operators import explore as X

    cols = ["a", "b", "c", "d"]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols))
    got = {(r["col_a"], r["col_b"]): r["r"] for r in X.correlation(df, cols).collect()}
    ref = pd.DataFrame(rows, columns=cols, dtype="float64").corr()
    for a in cols:
        for b in cols:
            want = ref.loc[a, b]
            g = got[(a, b)]
            if want is None or (isinstance(want, float) and math.isnan(want)):
                # pandas gives NaN for < 2 pairs or zero variance; tiny variances may differ in
                # the last bits, so only a defined value on our side needs a near-zero spread
                continue
            assert g is not None and abs(g - want) < 1e-6, (a, b, g, want)


def brute_threshold(pairs):
    n = len(pairs)
    if n == 0:
        return None
    out = {}
    stats = {}
    for c in (0, 1):
        tp = sum(1 for y, p in pairs if y == c and p == c)
        pred = sum(1 for _, p in pairs if p == c)
        real = sum(1 for y, _ in pairs if y == c)
        prec = tp / pred if pred else 0.0
        rec = tp / real if real else 0.0
        f1 = 2 * prec * rec / (prec + rec) if prec + rec else 0.0
        stats[c] = (real / n, prec, rec, f1)
    out["accuracy"] = sum(1 for y, p in pairs if y == p) / n
    out["precision_w"] = sum(w * p for w, p, _, _ in stats.values())
    out["recall_w"] = sum(w * r for w, _, r, _ in stats.values())
    out["f1"] = sum(w * f for w, _, _, f in stats.values())
    out["recall_pos"] = stats[1][2]
    return out


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture],
          phases=[Phase.explicit, Phase.reuse, Phase.generate])
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 1)), min_size=0, max_size=50))
def test_threshold_metrics_match_brute_force(spark, pairs):
    df = spark.createDataFrame([(y, float(p)) for y, p in pairs], "label int, prediction double")
    got = M.threshold_metrics(df).first()
    want = brute_threshold(pairs)
    if want is None:
        assert got is None or got["accuracy"] == 0.0
        return
    for k, v in want.items():
        assert abs(got[k] - v) < 1e-12, (k, got[k], v)


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture],
          phases=[Phase.explicit, Phase.reuse, Phase.generate])
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(-1000, 1000)), min_size=1, max_size=80))
def test_class_histogram_matches_numpy(spark, rows):
    import numpy as np

    from tipscope.operators import explore as X

    data = [(lab, v / 100.0, 1.0, 2.0) for lab, v in rows]
    df = spark.createDataFrame(data, "label int, trip_distance double, trip_duration_min double, fare_amount double")
    got = {(r["label"], r["bin"]): (r["n_rows"], r["density"])
           for r in X.class_histogram(df, limits=None).collect() if r["feature"] == "trip_distance"}
    for lab in (0, 1):
        xs = np.array([v for l_, v, _, _ in data if l_ == lab])
        if len(xs) == 0:
            assert not any(k[0] == lab for k in got)
            continue
        counts, _ = np.histogram(xs, bins=40)
        dens, _ = np.histogram(xs, bins=40, density=True)
        for b in range(40):
            n, d = got.get((lab, b), (0, 0.0))
            assert n == counts[b], (lab, b, n, counts[b])
            assert abs(d - dens[b]) <= 1e-9 * max(1.0, abs(dens[b])), (lab, b, d, dens[b])


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture],
          phases=[Phase.explicit, Phase.reuse, Phase.generate])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 1),
                          st.sampled_from([0.0, 0.2, 0.4, 0.6, 0.8, 1.0])), min_size=1, max_size=60),
       st.integers(1, 5))
def test_grouped_auc_matches_brute_force(spark, rows, buckets):
    df = spark.createDataFrame(rows, "model string, label int, score double")
    got = {r["model"]: r["auc"] for r in M.auc(df, group_cols=["model"], buckets=buckets).collect()}
    for m in {r[0] for r in rows}:
        want = brute_auc([(y, s) for mm, y, s in rows if mm == m])
        if want is None:
            assert got.get(m) is None
        else:
            assert abs(got[m] - want) < 1e-12, (m, got[m], want)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture],
          phases=[Phase.explicit, Phase.reuse, Phase.generate])
@given(st.lists(st.integers(-10**12, 10**12), min_size=0, max_size=200, unique=True),
       st.sampled_from([(0.8, 0.2), (0.5, 0.3, 0.2), (1.0,)]))
def test_hash_split_is_disjoint_complete_and_stable(spark, keys, weights):
    from tipscope.operators import sampling as SM

    df = spark.createDataFrame([(k,) for k in keys], "k long")
    parts = [sorted(r[0] for r in p.collect()) for p in SM.hash_split(df, "k", weights)]
    again = [sorted(r[0] for r in p.collect()) for p in SM.hash_split(df.repartition(3), "k", weights)]
    flat = [k for p in parts for k in p]
    assert sorted(flat) == sorted(keys) and len(flat) == len(set(flat))
    assert parts == again


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture],
          phases=[Phase.explicit, Phase.reuse, Phase.generate])
@given(st.lists(st.sampled_from(["a", "b", "c", "d", "B", "aa", "1.0"]), min_size=1, max_size=40))
def test_index_order_is_frequency_then_alphabetical(spark, values):
    from collections import Counter

    from tipscope.operators import features as FE

    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = {r["value"]: (r["idx"], r["n_rows"]) for r in FE.index_table(df, ["v"]).collect()}
    counts = Counter(values)
    order = sorted(counts, key=lambda v: (-counts[v], v))
    assert got == {v: (i, counts[v]) for i, v in enumerate(order)}


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture],
          phases=[Phase.explicit, Phase.reuse, Phase.generate])
@given(st.lists(trip, min_size=0, max_size=25))
def test_retention_counts_equal_raw_and_clean_counts(spark, rows):
    from tipscope.operators import explore as X

    data = []
    for start, dur_s, pc, dist, pay, fare, tip in rows:
        pick = T0 + dt.timedelta(minutes=start)
        drop = None if dur_s is None else pick + dt.timedelta(seconds=dur_s * 30)
        data.append((pick, drop, pc, dist, None, 1, 2, pay, fare, None, tip, None, None, None, None))
    df = spark.createDataFrame(data, SCHEMA)
    r = X.retention(df, SPEC).first()
    assert r["n_raw"] == len(rows)
    assert r["n_clean"] == len(brute_clean(rows)) == P.clean_trips(df, SPEC).count()
