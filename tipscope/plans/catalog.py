"""Registered queries: one per operator (or tight operator group) of the inventory.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame over the test tables in
``sf_dir``; ``ORACLE[name]`` is the same computation as DuckDB SQL over the
tables registered as views.  Queries without an oracle are random or learned
(samples, splits, model fits, timings) and are checked by invariants in
``tests/``.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..operators import balance as B
from ..operators import compare as CMP
from ..operators import explore as X
from ..operators import features as FE
from ..operators import metrics as M
from ..operators import models as MD
from ..operators import prepare as P
from ..operators import sampling as SM
from ..operators import scaling as SC
from ..operators import verify as V
from ..session import checkpoint_dir, configure
from ..sources import adapters as A
from ..sources import parquet as PQ
from ..sources import sinks as SK
from ..specs import LINEITEM_TRIPS, TripSpec
from . import jobs as J

T1 = LINEITEM_TRIPS
# The events table seen as trips for the time features.
T2 = TripSpec(pickup="ts", label_col="label")
# Range limits of the class histograms rescaled to the T1 units (days, prices).
T1_HISTOGRAM_LIMITS = (("trip_distance", 25.0), ("trip_duration_min", 400.0), ("fare_amount", 60000.0))
# Canonical types of the lineitem scan (S2/S4 check): several casts change type.
LINEITEM_TYPES = {
    "l_orderkey": "bigint",
    "l_partkey": "int",
    "l_suppkey": "int",
    "l_linenumber": "double",
    "l_quantity": "int",
    "l_extendedprice": "double",
    "l_tax": "double",
    "l_returnflag": "string",
    "l_shipdate": "timestamp_ntz",
}
ORDERS_TYPES = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double",
                "o_orderdate": "timestamp_ntz"}
HASH_FRACTION = 0.2


def round6(df: DataFrame) -> DataFrame:
    """Round every floating column to 6 decimals (oracle comparisons)."""
    return df.select(*[
        F.round(F.col(f.name), 6).alias(f.name) if isinstance(f.dataType, (DoubleType, FloatType))
        else F.col(f.name)
        for f in df.schema.fields
    ])


def t1_raw(spark, d):
    return A.trips_from_lineitem(spark, d)


def t1_clean(spark, d):
    return P.add_tip_ratio(P.add_label(P.clean_trips(t1_raw(spark, d), T1), T1), T1)


def events_labelled(spark, d):
    return A.events(spark, d).withColumn("label", (F.col("value") < 5).cast("int"))


KEY = ["trip_key", "trip_line"]


# --- sources ----------------------------------------------------------------

def q_scan_normalise(spark, d):
    return PQ.read_one(spark, f"{d.rstrip('/')}/lineitem.parquet", LINEITEM_TYPES)


def q_scan_union_by_name(spark, d):
    orders = A.table(spark, d, "orders")
    # two physical layouts of the same rows: other column order and types
    a = orders.select("o_orderkey", F.col("o_custkey").cast("int").alias("o_custkey"),
                      "o_totalprice", "o_orderdate")
    b = orders.select("o_orderdate", F.col("o_totalprice").cast("string").alias("o_totalprice"),
                      F.col("o_custkey").cast("double").alias("o_custkey"), "o_orderkey")
    return PQ.union_by_name([PQ.normalise(a, ORDERS_TYPES), PQ.normalise(b, ORDERS_TYPES)])


def q_load_trips_drift(spark, d):
    """Ingest as a user does it: files of three physical layouts, one as a Spark
    folder, read as one canonical table with pushed-down rules, then cleaned."""
    raw = t1_raw(spark, d)
    base = f"{checkpoint_dir(spark).rstrip('/')}/drift-{SK.new_run_id()}"
    month = F.month("tpep_pickup_datetime") % 3
    wide = raw.where(month == 0).withColumn("payment_type", F.col("payment_type").cast("bigint"))
    text = raw.where(month == 1).withColumn("payment_type", F.col("payment_type").cast("double")).withColumn(
        "tip_amount", F.col("tip_amount").cast("string"))
    upper = raw.where(month == 2).withColumnRenamed("airport_fee", "Airport_fee").withColumn("note", F.lit("x")).withColumn(
        "passenger_count", F.col("passenger_count").cast("int"))
    for name, part in (("a", wide), ("b", text), ("c", upper)):
        part.write.parquet(f"{base}/{name}.parquet")
    types = (*T1.types.items(), ("trip_key", "bigint"), ("trip_line", "int"))
    loaded = PQ.load_trips(spark, base, T1.with_(canonical_types=types), prefilter=True)
    clean = round6(P.add_tip_ratio(P.add_label(P.clean_trips(loaded, T1), T1), T1))
    return clean.withColumns({c: F.col(c).cast("timestamp_ntz") for c in (T1.pickup, T1.dropoff)})


# --- cleaning and derived columns ------------------------------------------

def q_clean_trips(spark, d):
    return round6(t1_clean(spark, d))


def _single_filter(fn, col):
    def q(spark, d):
        return round6(fn(t1_raw(spark, d), T1).select(*KEY, col))
    return q


def q_duration(spark, d):
    return round6(P.add_duration(t1_raw(spark, d), T1).select(*KEY, "trip_duration_min"))


def q_speed(spark, d):
    df = P.filter_duration(t1_raw(spark, d), T1)
    return round6(P.add_speed(df, T1).select(*KEY, "avg_speed_mph"))


def q_time_features(spark, d):
    df = P.add_time_features(A.events(spark, d), T2)
    return df.select("event_id", "pickup_hour", "pickup_dow", "is_weekend", "is_night",
                     X.C.weekday_name("pickup_dow").alias("day_name"))


def q_fill_nulls(spark, d):
    return round6(P.fill_nulls(t1_raw(spark, d), T1).select(
        *KEY, "RatecodeID", "extra", "tolls_amount", "congestion_surcharge", "airport_fee"))


def q_label_threshold(spark, d):
    return t1_clean(spark, d).select(*KEY, "label")


def q_tip_ratio(spark, d):
    return round6(t1_clean(spark, d).select(*KEY, "tip_pct"))


# --- aggregates -------------------------------------------------------------

def q_retention(spark, d):
    return round6(X.retention(t1_raw(spark, d), T1))


def q_class_balance(spark, d):
    return round6(B.class_balance(t1_clean(spark, d)))


def q_class_balance_toxic(spark, d):
    return round6(B.class_balance(A.table(spark, d, "labels"), "toxic"))


def q_majority_baseline(spark, d):
    return round6(B.majority_baseline(t1_clean(spark, d)))


def q_majority_baseline_inverse(spark, d):
    """Positives in the majority: good documents are label 1 here."""
    return round6(B.majority_baseline(A.table(spark, d, "labels"), "quality"))


def q_class_weights(spark, d):
    return round6(B.class_weight_summary(B.add_class_weights(t1_clean(spark, d), "label")))


def q_rows_per_month(spark, d):
    return X.rows_per_month(A.table(spark, d, "orders"), "o_orderdate")


def q_month_prefix(spark, d):
    return X.rows_per_month(A.table(spark, d, "orders"), "o_orderdate", prefix="1998")


def q_ratio_histogram(spark, d):
    return round6(X.ratio_histogram(t1_clean(spark, d)))


def q_rate_by_hour(spark, d):
    return round6(X.rate_by_hour(events_labelled(spark, d), "ts"))


def q_rate_by_weekday(spark, d):
    return round6(X.rate_by_weekday(events_labelled(spark, d), "ts"))


def q_label_domain(spark, d):
    return X.label_domain(t1_clean(spark, d))


def q_correlation(spark, d):
    return round6(X.correlation(t1_clean(spark, d), X.correlation_columns(T1)))


def t2_prepared(spark, d):
    """T2 rows with the columns of prepared trips; hours, weekdays and ratios vary."""
    ev = events_labelled(spark, d).withColumn("tip_pct", F.col("value") / 50.0)
    return P.add_time_features(ev, T2)


def q_correlation_time(spark, d):
    ev = t2_prepared(spark, d).withColumn("gap", F.when(F.col("event_id") % 7 != 0, F.col("value")).otherwise(
        F.when(F.col("event_id") % 2 == 0, F.lit(float("nan")))))
    return round6(X.correlation(ev, ["value", "gap", "pickup_hour", "pickup_dow", "is_weekend", "is_night", "label"]))


def _exploration(part):
    def q(spark, d):
        return round6(X.grouped_summaries(t2_prepared(spark, d), T2)[part])
    return q


def _from_state(part):
    """A summary of T1 from the stored states of three sources, one of them stored twice."""
    def q(spark, d):
        path = f"{checkpoint_dir(spark).rstrip('/')}/states-{SK.new_run_id()}"
        clean = t1_clean(spark, d)
        for source in (0, 1, 2, 1):
            X.append_summary_state(clean.where(F.col("trip_key") % 3 == source), path, f"part-{source}", T1)
        return round6(X.summaries_from_state(spark, path, T1)[part])
    return q


def q_class_histogram(spark, d):
    return round6(X.class_histogram(t1_clean(spark, d), limits=T1_HISTOGRAM_LIMITS))


# --- evaluation on the deterministic scorers (T4) ---------------------------

def t4(spark, d):
    return A.lineitem_scores(spark, d, "quantity")


def q_confusion(spark, d):
    return M.confusion(t4(spark, d))


def q_auc(spark, d):
    return round6(M.auc(t4(spark, d)))


def q_weighted_metrics(spark, d):
    return round6(M.threshold_metrics(t4(spark, d)))


def q_minority_recall(spark, d):
    return round6(M.threshold_metrics(t4(spark, d)).select("tp", "fn", "recall_pos"))


def q_metric_record(spark, d):
    return round6(M.metric_record(t4(spark, d)))


def q_metric_record_missing(spark, d):
    """Some scores are NULL, some NaN: those rows leave every metric."""
    scored = A.lineitem_scores(spark, d, "quantity").withColumn("score", F.when(F.col("score") < 0.1, F.lit(None)).when(
        F.col("score") > 0.9, F.lit(float("nan"))).otherwise(F.col("score")))
    return round6(M.metric_record(scored))


def q_leaderboard(spark, d):
    return round6(CMP.leaderboard(A.lineitem_scores_long(spark, d)))


def q_best_model(spark, d):
    return round6(CMP.best_model(CMP.leaderboard(A.lineitem_scores_long(spark, d))))


def q_report_rows(spark, d):
    return CMP.report_rows(CMP.leaderboard(A.lineitem_scores_long(spark, d)))


# --- sampling ----------------------------------------------------------------

def q_hash_sample(spark, d):
    ev = A.events(spark, d)
    return SM.with_hash_bucket(SM.hash_sample(ev, "event_id", HASH_FRACTION), "event_id") \
        .select("event_id", "hash_bucket")


def q_hash_split(spark, d):
    return SM.split_labels(A.events(spark, d), "event_id").select("event_id", "part")


def q_bernoulli_sample(spark, d):
    return SM.bernoulli_sample(A.table(spark, d, "lineitem"), 0.1, seed=42)


def q_target_row_sample(spark, d):
    """Exactly 1000 rows by key hash, whatever the layout."""
    li = A.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line_key"))
    return SM.target_row_sample(li, 1000, key="line_key")


def q_bernoulli_facts(spark, d):
    """Facts of the seeded samplers: only rows of the table, none more often than there,
    and a size within six standard deviations; the sample without a key likewise."""
    key = ["l_orderkey", "l_linenumber"]
    li = A.table(spark, d, "lineitem").select(*key)
    n, there = li.count(), li.groupBy(*key).agg(F.count("*").alias("there"))
    out = []
    for name, sample, f in (("bernoulli", SM.bernoulli_sample(li, 0.1, seed=42), 0.1),
                            ("target", SM.target_row_sample(li, n // 4, seed=42), (n // 4) / n)):
        drawn = sample.groupBy(*key).agg(F.count("*").alias("n")).join(there, key, "left")
        out.append(drawn.agg(
            F.lit(name).alias("sampler"), F.min(F.coalesce(F.col("n") <= F.col("there"), F.lit(False))).alias("rows_of_the_table"),
            (F.abs(F.sum("n") - n * f) <= 6 * (n * f * (1 - f)) ** 0.5).alias("size_fits")))
    return out[0].unionByName(out[1])


def q_random_split(spark, d):
    """Facts of the seeded split: parts are disjoint and complete."""
    li = A.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    train, test = SM.random_split(li, (0.8, 0.2), seed=42)
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    keys = both.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n"))
    return keys.agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_keys"), F.max("n").alias("most_of_a_key"))


def q_hash_sample_small(spark, d):
    li = A.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line_key"))
    return SM.hash_sample(li, "line_key", 0.00035)


# --- feature recipe ----------------------------------------------------------

def _index_tables(spark, d, fn):
    return fn(t1_clean(spark, d), list(T1.categorical_features))


def q_string_index(spark, d):
    return _index_tables(spark, d, FE.index_table)


def q_one_hot(spark, d):
    return _index_tables(spark, d, FE.one_hot_table)


def q_assemble(spark, d):
    clean = t1_clean(spark, d)
    feat = FE.build_feature_pipeline(T1).fit(clean).transform(clean)
    arr = vector_to_array("features")
    # The sum is a left fold in slot order, bit-identical to the SQL fold, so it
    # is compared unrounded (decimal rounding of a near-tie differs by engine).
    return feat.select(
        *KEY, "label",
        F.size(arr).alias("vec_size"),
        F.size(F.filter(arr, lambda x: x != 0)).alias("n_nonzero"),
        F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x).alias("feature_sum"),
    )


# --- learned / timed (no oracle) --------------------------------------------

QUALITY_SPEC = TripSpec(
    numeric_features=("n_chars", "digit_share", "upper_share", "newline_share", "word_density"),
    categorical_features=("lang",),
)


def t3_featurised(spark, d):
    docs = A.document_quality(spark, d)
    weighted = B.add_class_weights(docs, "label")
    model = FE.build_feature_pipeline(QUALITY_SPEC).fit(weighted)
    return model.transform(weighted).select("doc_id", "features", "label", "class_weight")


def q_feature_pipeline(spark, d):
    """The whole recipe: fitted without one language (unseen later) and applied
    to rows of which some have none; numeric slots, size and hot slot."""
    docs = B.add_class_weights(A.document_quality(spark, d), "label")
    model = FE.build_feature_pipeline(QUALITY_SPEC).fit(docs.where("lang <> 'es'"))
    gaps = docs.withColumn("lang", F.when(F.col("doc_id") % 10 != 0, F.col("lang")))
    arr = vector_to_array("features")
    out = model.transform(gaps).withColumn("a", arr)
    return round6(out.select(
        "doc_id", "label", "class_weight", F.size("a").alias("vec_size"),
        *[F.col("a")[i].alias(f"slot_{i}") for i in range(5)],
        (F.array_position(F.slice("a", 6, 100), F.lit(1.0)) - 1).cast("int").alias("hot_slot")))


def dear_lines(spark, d):
    """Lineitem rows with the label "dear" and few-valued features, weighted by class."""
    li = A.table(spark, d, "lineitem").select(
        F.col("l_quantity").cast("double").alias("quantity"), F.col("l_linenumber").cast("double").alias("line"),
        F.col("l_discount").cast("double").alias("discount"), F.col("l_tax").cast("double").alias("tax"),
        (F.col("l_extendedprice") * (F.lit(0.2) + F.col("l_quantity") / 50.0) > 35000).cast("int").alias("label"))
    return B.add_class_weights(li, "label", B.balance_record(li))


#: Parameters under which a learner's first decision is exact: a converged fit, one unsampled tree.
EXACT = {"LogisticRegression": {"maxIter": 300, "tol": 1e-12}, "DecisionTree": {"maxDepth": 2},
         "RandomForest": {"numTrees": 1, "maxDepth": 2, "bootstrap": False}, "GBT": {"maxIter": 1, "maxDepth": 2}}


def _learned(name, spark, d) -> dict:
    """What the learner found on T6 and what is computed without it: coefficients
    of Newton steps, or the root split of the impurity counts."""
    rows = dear_lines(spark, d)
    columns = ["quantity", "discount"] if name == "LogisticRegression" else ["quantity", "line", "discount", "tax"]
    model = MD.make_models(overrides=EXACT)[name].fit(
        VectorAssembler(inputCols=columns, outputCol="features").transform(rows).select("features", "label", "class_weight"))
    if name == "LogisticRegression":
        own = V.newton_logistic(rows, columns, weight_col="class_weight")
        agrees = max(abs(x - y) for x, y in zip(own, V.linear_coefficients(model))) < 1e-4
        return {**{c: round(x, 6) for c, x in zip(("intercept", *columns), own)}, "learner_agrees": agrees}
    best = V.root_split(rows, columns, weight_col="class_weight").first()
    return {"root_feature": best["feature"], "root_threshold": best["threshold"], "root_gain": round(best["gain"], 6),
            "learner_agrees": V.tree_root(model, columns) == (best["feature"], best["threshold"])}


def _fit_facts(name):
    """One learner's run: sizes of the disjoint parts, ranges of its metrics, and
    what it learned on T6 against an independent computation."""
    def q(spark, d):
        feat = t3_featurised(spark, d).cache()
        train, test = SM.hash_split(feat, "doc_id", (0.8, 0.2))
        board = CMP.train_and_compare({name: MD.make_models(seed=42)[name]}, train, test)
        sizes = feat.agg(F.count("*").alias("n_rows")).first()["n_rows"]
        out = board.select(
            "model", *[F.lit(n).cast("bigint").alias(c) for n, c in ((sizes, "n_rows"), (train.count(), "n_train"), (test.count(), "n_test"))],
            (F.abs(F.col("recall_w") - F.col("accuracy")) < 1e-9).alias("recall_is_accuracy"),
            F.forall(F.array(*CMP.METRIC_COLUMNS), lambda v: v.between(0.0, 1.0)).alias("in_range"))
        feat.unpersist()
        return out.withColumns({c: F.lit(v) for c, v in _learned(name, spark, d).items()})
    return q


def q_experiment(spark, d):
    """J1 with hashed samples: what its summary and its scaling curve counted."""
    out = J.experiment(t1_raw(spark, d), T1, key="trip_key", models=["LogisticRegression"], fractions=(0.5, 1.0),
                       model_overrides={"LogisticRegression": {"maxIter": 5}})
    curve = out["data_scaling"].agg(F.min("n_rows").alias("n_half"), F.max("n_rows").alias("n_full"),
                                    F.min(F.col("train_seconds") > 0).alias("timed"))
    counted = out["summary"].select("n_raw", "n_clean", "n_neg", "n_pos", "pos_rate", "n_train", "n_test", "fraction", "seed")
    fitted = out["models"].agg(F.count("*").alias("n_models"))
    one = lambda df, c: df.select(c).scalar().alias(c)
    return round6(counted.select("*", *[one(curve, c) for c in ("n_half", "n_full", "timed")], one(fitted, "n_models")))


def q_cost_tradeoff(spark, d):
    """The trade-off of the T4 scorers, with how often each predicts 1 as its cost."""
    scores = A.lineitem_scores_long(spark, d)
    cost = scores.groupBy("model").agg(F.sum("prediction").cast("bigint").alias("cost"))
    board = CMP.leaderboard(scores).join(cost, "model")
    return round6(CMP.cost_tradeoff(board, "cost"))


def q_data_scaling(spark, d):
    feat = t3_featurised(spark, d)
    lr = MD.make_models(weight_col=None)["LogisticRegression"]
    curve = SC.data_scaling(lr, feat, (0.25, 0.5, 1.0), key="doc_id")
    return curve.select("fraction", "n_rows", (F.col("train_seconds") > 0).alias("timed"))


def timings(spark, d):
    """T5: the events table as a table of runs: per type its rows, cores, seconds."""
    kinds = A.events(spark, d).groupBy("event_type").agg(
        F.count("*").alias("n_rows"), F.round(F.sum("value"), 3).alias("train_seconds"))
    return kinds.withColumn("cores", F.length("event_type").cast("int"))


def q_linear_reference(spark, d):
    return round6(SC.linear_reference(timings(spark, d)).select("event_type", "n_rows", "train_seconds", "linear_seconds"))


def q_speedup(spark, d):
    runs = timings(spark, d).groupBy("cores").agg(F.min("train_seconds").alias("train_seconds"))
    return round6(SC.speedup(runs))


def q_sink_roundtrip(spark, d):
    clean = t1_clean(spark, d)
    weighted = B.add_class_weights(clean, "label", B.balance_record(clean))
    path = f"{checkpoint_dir(spark).rstrip('/')}/sink_roundtrip/{SK.new_run_id()}"
    SK.write_parquet(weighted.select(*KEY, "label", "class_weight"), path)
    return round6(SK.read_parquet(spark, path))


def q_metrics_roundtrip(spark, d):
    """Result sinks: each model's row is added under one run, one of them twice,
    another run's rows stand beside them, and one run is read back."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/metrics-{SK.new_run_id()}"
    board = CMP.leaderboard(A.lineitem_scores_long(spark, d))
    for scorer in ("quantity", "price", "quantity"):  # one of them twice, as after a retry
        SK.append_metrics(board.where(F.col("model") == scorer), path, "run-1", "models", entry=scorer)
    SK.append_metrics(board.where("model = 'discount'"), path, "run-2", "models", entry="discount")
    return round6(SK.read_metrics(spark, path, "models", "run-1").drop("written_at"))


def q_preview(spark, d):
    return SK.preview(t1_clean(spark, d), ["trip_key", "fare_amount", "tip_amount", "label", "tip_pct"])


def _pinned(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Run a query with the runtime options it relies on (UTC wall clock, AQE)."""
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return fn(spark, sf_dir)
    q.__name__ = getattr(fn, "__name__", "query")
    q.__doc__ = fn.__doc__
    return q


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_normalise": q_scan_normalise,
    "scan_union_by_name": q_scan_union_by_name,
    "clean_trips": q_clean_trips,
    "filter_payment": _single_filter(P.filter_payment, "payment_type"),
    "filter_fare": _single_filter(P.filter_fare, "fare_amount"),
    "filter_distance": _single_filter(P.filter_distance, "trip_distance"),
    "filter_passengers": _single_filter(P.filter_passengers, "passenger_count"),
    "filter_duration": _single_filter(P.filter_duration, "trip_duration_min"),
    "filter_speed": _single_filter(P.filter_speed, "avg_speed_mph"),
    "duration": q_duration,
    "speed": q_speed,
    "time_features": q_time_features,
    "fill_nulls": q_fill_nulls,
    "label_threshold": q_label_threshold,
    "tip_ratio": q_tip_ratio,
    "retention": q_retention,
    "class_balance": q_class_balance,
    "class_balance_toxic": q_class_balance_toxic,
    "majority_baseline": q_majority_baseline,
    "majority_baseline_inverse": q_majority_baseline_inverse,
    "class_weights": q_class_weights,
    "rows_per_month": q_rows_per_month,
    "month_prefix": q_month_prefix,
    "ratio_histogram": q_ratio_histogram,
    "rate_by_hour": q_rate_by_hour,
    "rate_by_weekday": q_rate_by_weekday,
    "label_domain": q_label_domain,
    "correlation": q_correlation,
    "correlation_time": q_correlation_time,
    "class_histogram": q_class_histogram,
    "exploration_balance": _exploration("balance"),
    "exploration_months": _exploration("rows_per_month"),
    "exploration_ratio": _exploration("ratio_histogram"),
    "exploration_hour": _exploration("rate_by_hour"),
    "exploration_weekday": _exploration("rate_by_weekday"),
    "state_balance": _from_state("balance"),
    "state_months": _from_state("rows_per_month"),
    "state_ratio": _from_state("ratio_histogram"),
    "state_correlation": _from_state("correlation"),
    "confusion": q_confusion,
    "auc": q_auc,
    "weighted_metrics": q_weighted_metrics,
    "minority_recall": q_minority_recall,
    "metric_record": q_metric_record,
    "metric_record_missing": q_metric_record_missing,
    "leaderboard": q_leaderboard,
    "best_model": q_best_model,
    "report_rows": q_report_rows,
    "hash_sample": q_hash_sample,
    "hash_sample_small": q_hash_sample_small,
    "hash_split": q_hash_split,
    "bernoulli_sample": q_bernoulli_sample,
    "sampler_facts": q_bernoulli_facts,
    "target_row_sample": q_target_row_sample,
    "random_split": q_random_split,
    "string_index": q_string_index,
    "one_hot": q_one_hot,
    "assemble": q_assemble,
    "feature_pipeline": q_feature_pipeline,
    "fit_lr": _fit_facts("LogisticRegression"),
    "fit_dt": _fit_facts("DecisionTree"),
    "fit_rf": _fit_facts("RandomForest"),
    "fit_gbt": _fit_facts("GBT"),
    "experiment": q_experiment,
    "cost_tradeoff": q_cost_tradeoff,
    "data_scaling": q_data_scaling,
    "linear_reference": q_linear_reference,
    "speedup": q_speedup,
    "sink_roundtrip": q_sink_roundtrip,
    "metrics_roundtrip": q_metrics_roundtrip,
    "load_trips_drift": q_load_trips_drift,
    "preview": q_preview,
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: _pinned(v) for k, v in _QUERIES.items()}
