"""Composite jobs a user launches (J1-J3), written as functions over a session.

* :func:`experiment` (J1): prepare -> balance -> weights -> feature recipe ->
  sample -> split -> train-and-compare -> data-scaling curve.
* :func:`exploration` (J2): retention, balance, month volumes, ratio
  histogram, hourly / weekday rates, correlation and class histograms.
* :func:`parallelism` (J3): a featurised sample materialised once, and the fit
  time of this submission appended to the scaling table.

Each returns a dict of DataFrames; with ``metrics_path`` the results are also
appended to the metrics tables (one folder per kind).
"""
from __future__ import annotations

import hashlib
import time
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import balance as B
from ..operators import compare as CMP
from ..operators import explore as X
from ..operators import features as FE
from ..operators import models as MD
from ..operators import prepare as P
from ..operators import sampling as SM
from ..operators import scaling as SC
from ..session import checkpoint_dir, configure
from ..sources import sinks as SK
from ..specs import TripSpec


def experiment(
    raw: DataFrame,
    spec: TripSpec | None = None,
    train_rows: int = 2_000_000,
    seed: int = 42,
    key: str | None = None,
    model_overrides: dict | None = None,
    fractions: Sequence[float] = (0.05, 0.1, 0.25, 0.5, 1.0),
    metrics_path: str | None = None,
    models: Sequence[str] | None = None,
    partitions: int | None = None,
    split_first: bool = False,
    score_source: str = "probability",
    concurrent: int = 1,
) -> dict[str, DataFrame]:
    """J1.  ``key`` switches sampling and splitting to layout-independent hashing.

    By default (as in the original study) class weights and the feature recipe
    are fitted on all prepared rows before the split.  ``split_first=True``
    splits first and fits both on the training part only, so nothing about the
    test rows leaks into training.  ``score_source`` picks the ranking column
    for AUC (``probability`` or ``rawPrediction``).  ``concurrent`` learners are
    fitted at the same time (see :func:`compare.train_and_compare`).
    """
    s = spec or TripSpec()
    configure(raw.sparkSession)  # UTC wall clock, AQE
    t0 = time.perf_counter()
    run_id = SK.new_run_id()
    out: dict[str, DataFrame] = {}
    keep = [key] if key else []
    owned: list[DataFrame] = []  # caches made here, released at the end

    # A count without columns reads only the footers of a Parquet scan.  (An
    # Observation on the cache-filling job would do without it, but a session
    # that has observed cannot ship the summaries of fitted models to its tasks.)
    n_raw = raw.count()
    data = P.prepare(raw, s).cache()
    n_clean = data.count()
    frac = SM.target_fraction(n_clean, train_rows)

    def sample_and_split(df):
        if key:
            sample = df if frac >= 1.0 else SM.hash_sample(df, key, frac)
            return SM.hash_split(sample, key, (0.8, 0.2), salt="split")
        sample = df if frac >= 1.0 else SM.bernoulli_sample(df, frac, seed)
        if not sample.is_cached:  # a seeded split needs a stable input
            sample = sample.cache()
            owned.append(sample)
        return SM.random_split(sample, (0.8, 0.2), seed)

    def featurise(recipe, df):
        return FE.model_columns(recipe.transform(df), s) if not keep else \
            recipe.transform(df).select(*keep, "features", s.label_col, s.weight_col)

    if split_first:
        train_rows_df, test_rows_df = sample_and_split(data)
        train_rows_df = train_rows_df.cache()
        owned.append(train_rows_df)
        bal = B.balance_record(train_rows_df, s.label_col)  # fitted on the training part only
        w_train = B.add_class_weights(train_rows_df, s.label_col, bal, s.weight_col)
        w_test = B.add_class_weights(test_rows_df, s.label_col, bal, s.weight_col)
        recipe = FE.build_feature_pipeline(s).fit(w_train)
        train, test = featurise(recipe, w_train), featurise(recipe, w_test)
        featurised = train.cache()
    else:
        bal = B.balance_record(data, s.label_col)  # the only balance pass
        weighted = B.add_class_weights(data, s.label_col, bal, s.weight_col)
        recipe = FE.build_feature_pipeline(s).fit(weighted)
        featurised = featurise(recipe, weighted).cache()
        train, test = sample_and_split(featurised)
    if not split_first:
        featurised.count()
        data.unpersist()  # the featurised rows replace the prepared ones
    train, test = train.cache(), test.cache()
    n_train, n_test = train.count(), test.count()
    if split_first:
        data.unpersist()

    catalogue = MD.make_models(label_col=s.label_col, weight_col=s.weight_col, seed=seed,
                               overrides=model_overrides)
    if models is not None:
        catalogue = {k: v for k, v in catalogue.items() if k in models}
    sink = (lambda row: SK.append_metrics(row, metrics_path, run_id, "models", entry=row.first()["model"])) if metrics_path else None
    board = CMP.train_and_compare(catalogue, train, test, s.label_col, score_source=score_source,
                                  on_result=sink, partitions=partitions, concurrent=concurrent)
    out["models"] = board
    for df in (train, test):
        if df is not featurised:  # split-first mode trains on the featurised frame itself
            df.unpersist()

    lr = MD.make_models(label_col=s.label_col, weight_col=None)["LogisticRegression"]
    out["data_scaling"] = SC.data_scaling(lr, featurised, fractions, key=key, seed=seed)
    spark = raw.sparkSession
    summary = spark.createDataFrame([(
        int(n_raw), int(n_clean), int(bal["n_neg"]), int(bal["n_pos"]), int(bal["total"]),
        float(bal["pos_rate"]), float(bal["imbalance_ratio"]), int(n_train), int(n_test), float(frac),
        int(seed), float(time.perf_counter() - t0),
    )], "n_raw long, n_clean long, n_neg long, n_pos long, total long, pos_rate double, "
       "imbalance_ratio double, n_train long, n_test long, fraction double, seed long, "
       "wall_clock_seconds double")
    out["summary"] = summary
    if metrics_path:
        SK.append_metrics(out["data_scaling"], metrics_path, run_id, "data_scaling")
        SK.append_metrics(summary, metrics_path, run_id, "summary")
    for df in owned:
        df.unpersist()
    featurised.unpersist()
    return out


def exploration(raw: DataFrame, spec: TripSpec | None = None, month_prefix: str | None = None,
                histogram_limits=None, metrics_path: str | None = None) -> dict[str, DataFrame]:
    """Every exploratory summary as a small DataFrame (nothing sampled).

    Passes over the prepared rows (cached for the job, released at the end):
    one grouping-sets aggregate for the five count / mean summaries, one for
    the correlation matrix, two for the class histograms (ranges, then bins).
    The returned summaries are read from small written tables; nothing stays cached.
    """
    s = spec or TripSpec()
    configure(raw.sparkSession)  # UTC wall clock, AQE
    data = P.prepare(raw, s).cache()
    # balance, months, ratio histogram and hour / weekday rates: one grouping-sets pass
    out = {
        "retention": X.retention(raw, s),
        **X.grouped_summaries(data, s, month_prefix),
        "correlation": X.correlation(data, X.correlation_columns(s)),
        "class_histogram": X.class_histogram(
            data, label_col=s.label_col,
            **({"limits": histogram_limits} if histogram_limits is not None else {})),
    }
    # What still hangs on the prepared rows is small: written, so that nothing stays cached.
    base = f"{checkpoint_dir(raw.sparkSession).rstrip('/')}/exploration-{SK.new_run_id()}"
    for k in ("retention", "correlation", "class_histogram"):
        out[k] = SK.read_parquet(raw.sparkSession, SK.write_parquet(out[k], f"{base}/{k}"))
    data.unpersist()
    if metrics_path:
        run_id = SK.new_run_id()
        for kind, df in out.items():
            SK.append_metrics(df, metrics_path, run_id, f"exploration_{kind}")
    return out


def source_key(raw: DataFrame, spec: TripSpec, recipe: str) -> str:
    """Digest of what a materialised sample depends on: files, columns, rules and recipe."""
    parts = [*sorted(raw.inputFiles()), raw.schema.json(), repr(spec), recipe]
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()[:16]


def parallelism(raw: DataFrame, sample_base: str, metrics_path: str, spec: TripSpec | None = None,
                rows: int = 3_000_000, seed: int = 42, repeats: int = 1) -> DataFrame:
    """One submission of the strong-scaling study.

    A featurised sample is materialised once per source, rules, recipe, size
    and seed; the LR fit is timed on the cores of this session and appended to
    the metrics table.  Returns the speed-up over all rows of the table with
    this sample, so each submission adds a level.
    """
    s = spec or TripSpec()
    configure(raw.sparkSession)  # UTC wall clock, AQE
    spark = raw.sparkSession
    pipeline = FE.build_feature_pipeline(s)
    recipe = [(type(x).__name__, [(p.name, x.getOrDefault(p)) for p in x.params if x.isSet(p)]) for x in pipeline.getStages()]
    key = source_key(raw, s, repr(recipe))
    path = SK.sample_path(sample_base, rows=rows, seed=seed, source=key)

    owned: list[DataFrame] = []

    def build():
        data = P.prepare(raw, s).select(*s.numeric_features, *s.categorical_features, s.label_col).cache()
        owned.append(data)
        balance = B.balance_record(data, s.label_col)  # fills the cache: the only pass over the raw rows
        sample = SM.target_row_sample(B.add_class_weights(data, s.label_col, balance, s.weight_col), rows, seed,
                                      n_rows=data.count())
        return FE.model_columns(pipeline.fit(sample).transform(sample), s)

    train = SK.materialise_once(spark, path, build)
    for df in owned:
        df.unpersist()
    lr = MD.make_models(label_col=s.label_col, weight_col=None)["LogisticRegression"]
    row = SC.timed_run(lr, train, repeats).withColumn("sample", F.lit(path))
    SK.append_metrics(row, metrics_path, SK.new_run_id(), "parallelism")
    runs = SK.read_metrics(spark, metrics_path, "parallelism").where(F.col("sample") == path)
    best = runs.groupBy("cores", "n_rows").agg(F.min("train_seconds").alias("train_seconds"))
    return SC.speedup(best)
