"""Exploratory aggregates.

Everything that the original analysis pulled to the driver (correlation on a
2 % sample, class histograms on a 1 % sample) runs here as distributed
aggregates over *all* rows; only the small summaries come back.  Counts and
moments are mergeable: kept per source, a new month is added without reading
the earlier ones (:func:`append_summary_state`, :func:`summaries_from_state`).
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..specs import (
    CLASS_HISTOGRAM_BINS,
    CLASS_HISTOGRAM_FEATURES,
    CLASS_HISTOGRAM_LIMITS,
    CORRELATION_EXCLUDED,
    RATIO_BIN_WIDTH,
    RATIO_HISTOGRAM_MAX,
    TripSpec,
)
from ..session import checkpoint_dir
from ..sources.sinks import append_metrics, delete_folder, new_run_id, read_metrics, read_parquet, write_parquet
from . import prepare as P
from .moments import correlation, correlation_of, merge_moments, pair_moments


def retention(raw: DataFrame, spec: TripSpec | None = None) -> DataFrame:
    """A1: raw and clean row counts in one pass (n_raw, n_clean, retained)."""
    s = spec or TripSpec()
    with_derived = P.add_speed(P.add_duration(raw, s), s)
    keep = (P.payment_rule(s) & P.fare_rule(s) & P.distance_rule(s) & P.passenger_rule(s)
            & P.duration_rule(s) & P.speed_rule(s))
    counts = with_derived.agg(F.count(F.lit(1)).alias("n_raw"), F.count_if(keep).alias("n_clean"))
    return counts.withColumn("retained", F.try_divide(F.col("n_clean").cast("double"), F.col("n_raw")))


def month_key(ts: str | Column) -> Column:
    """``yyyy-MM`` of a timestamp."""
    return F.date_format(C.col(ts), "yyyy-MM")


def month_start(ts: str | Column) -> Column:
    """First day of the timestamp's month (a date; cheap to group by)."""
    return F.trunc(C.col(ts).cast("date"), "MM")


def rows_per_month(df: DataFrame, ts_col: str, prefix: str | None = None) -> DataFrame:
    """A4 (+F10): row count per month, ordered; optionally only months with a prefix.

    Rows are grouped by the month's first day (an integer-backed date) and only
    the aggregated rows are formatted as ``yyyy-MM``; the prefix filter runs on
    those months inside Spark, not on the driver.
    """
    out = (df.groupBy(month_start(ts_col).alias("m")).agg(F.count(F.lit(1)).alias("n_rows"))
           .select(F.date_format("m", "yyyy-MM").alias("month"), "n_rows"))
    if prefix is not None:
        out = out.where(F.col("month").startswith(prefix))
    return out.orderBy("month")


def ratio_histogram(df: DataFrame, ratio_col: str = "tip_pct", width: float = RATIO_BIN_WIDTH,
                    upper: float | None = RATIO_HISTOGRAM_MAX) -> DataFrame:
    """A5 (+F8, P14): fixed-width histogram of a ratio, ordered by bin.

    Returns the integer bin index (a stable key) and the bin's left edge
    ``floor(x / w) * w``.
    """
    src = df.where(F.col(ratio_col) <= F.lit(upper)) if upper is not None else df
    src = src.where(F.col(ratio_col).isNotNull())
    return (src.groupBy(C.bin_index(ratio_col, width).alias("bin_idx"))
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .withColumn("bin", F.col("bin_idx") * F.lit(float(width)))
            .orderBy("bin_idx"))


def rate_by_hour(df: DataFrame, ts_col: str, label_col: str = "label") -> DataFrame:
    """Mean label per hour of day."""
    return (df.groupBy(F.hour(ts_col).alias("h"))
            .agg(F.avg(label_col).alias("low_rate"), F.count(F.lit(1)).alias("n_rows"))
            .orderBy("h"))


def rate_by_weekday(df: DataFrame, ts_col: str, label_col: str = "label") -> DataFrame:
    """A7 (+P16): mean label per day of week (1 = Sunday) with the day's name."""
    return (df.groupBy(F.dayofweek(ts_col).alias("d"))
            .agg(F.avg(label_col).alias("low_rate"), F.count(F.lit(1)).alias("n_rows"))
            .withColumn("day_name", C.weekday_name("d"))
            .orderBy("d"))


def label_domain(df: DataFrame, label_col: str = "label") -> DataFrame:
    """The distinct label values."""
    return df.select(label_col).distinct()


def correlation_columns(spec: TripSpec | None = None) -> list[str]:
    """Numeric features without identifier columns, plus the label."""
    s = spec or TripSpec()
    return [c for c in s.numeric_features if c not in CORRELATION_EXCLUDED] + [s.label_col]


def class_histogram(
    df: DataFrame,
    features: Sequence[str] = CLASS_HISTOGRAM_FEATURES,
    label_col: str = "label",
    bins: int = CLASS_HISTOGRAM_BINS,
    limits: Sequence[tuple[str, float]] | None = CLASS_HISTOGRAM_LIMITS,
) -> DataFrame:
    """A11 (+F9, F12): per-class density histograms over each slice's own range.

    For every (feature, class) slice the range min..max is split into ``bins``
    equal bins (the last one closed), and density = count / (n * width), so
    each slice has area 1.  One lazy plan: the slice ranges are a scalar
    subquery (one global aggregate, a row of ``len(features) x 2`` structs); the
    rows are unpivoted, binned against that row (no join) and counted with
    partial aggregation, so no slice ever lands in one task.
    """
    src = df
    for c, hi in (limits or ()):
        src = src.where(F.col(c) < F.lit(hi))
    src = src.where(F.col(label_col).isin(0, 1))
    lab = F.col(label_col)
    x = {f: F.col(f).cast("double") for f in features}
    ok = {f: x[f].isNotNull() & ~F.isnan(x[f]) for f in features}
    ranges = [F.struct(F.min(F.when(keep, x[f])).alias("lo"), F.max(F.when(keep, x[f])).alias("hi"), F.count_if(keep).alias("n"))
              for f in features for keep in [ok[f] & (lab == c) for c in (0, 1)]]
    per_slice = src.agg(F.array(*ranges)).scalar()

    stacked = ", ".join(f"{i}, cast(`{f}` as double)" for i, f in enumerate(features))
    long = src.select(lab.cast("int").alias("label"), F.expr(f"stack({len(features)}, {stacked}) as (f, x)"))
    long = long.where(F.col("x").isNotNull() & ~F.isnan("x"))

    def with_range(rows: DataFrame) -> DataFrame:
        """The slice's range beside its rows; a constant slice spans lo - 0.5 .. hi + 0.5, as numpy's histogram does."""
        one = F.element_at(per_slice, 2 * F.col("f") + F.col("label") + 1)
        wide = rows.withColumn("s", one).withColumn("spread", F.when(F.col("s.hi") > F.col("s.lo"), 0.0).otherwise(0.5))
        return wide.withColumns({"lo": F.col("s.lo") - F.col("spread"), "hi": F.col("s.hi") + F.col("spread"), "n": F.col("s.n")})

    lo, hi = F.col("lo"), F.col("hi")
    width = (hi - lo) / F.lit(float(bins))

    def edge(k):  # k-th bin edge as numpy's linspace builds it; the last edge is hi itself
        return F.when(k >= bins, hi).otherwise(k.cast("double") * width + lo)

    # numpy's rule: scale to a bin, then step down / up when x falls outside its edges
    raw = F.least(F.greatest(F.floor((F.col("x") - lo) / (hi - lo) * F.lit(float(bins))), F.lit(0)), F.lit(bins - 1))
    placed = with_range(long).withColumn("raw", raw)
    idx = (F.when(F.col("x") < edge(F.col("raw")), F.col("raw") - 1)
           .when((F.col("raw") != bins - 1) & (F.col("x") >= edge(F.col("raw") + 1)), F.col("raw") + 1)
           .otherwise(F.col("raw"))).cast("int")
    counted = placed.groupBy("f", "label", idx.alias("bin")).agg(F.count(F.lit(1)).alias("n_rows"))
    names = F.array(*[F.lit(f) for f in features])
    return with_range(counted).select(
        F.element_at(names, F.col("f") + 1).alias("feature"), "label", "bin",
        (lo + F.col("bin") * width).alias("bin_lo"),
        "n_rows",
        (F.col("n_rows") / (F.col("n") * width)).alias("density"),
    )


def grouped_summaries(df: DataFrame, spec: TripSpec | None = None, month_prefix: str | None = None,
                      width: float = RATIO_BIN_WIDTH, upper: float | None = RATIO_HISTOGRAM_MAX) -> dict:
    """A2, A4, A5, A6, A7 from ONE pass over ``df`` with grouping sets.

    The class balance, month volumes, ratio histogram and hourly / weekday
    rates are all counts and means, so one ``GROUPING SETS`` aggregate (one
    shuffle, partial aggregation per task) computes them together; each
    summary is then a slice of that small result, which is written once to the
    shared checkpoint folder (nothing stays cached).  The slices equal :func:`class_balance`, :func:`rows_per_month`,
    :func:`ratio_histogram`, :func:`rate_by_hour` and :func:`rate_by_weekday`.
    """
    s = spec or TripSpec()
    table = read_parquet(df.sparkSession, write_parquet(  # a few hundred rows at most
        summary_counts(df, s, width, upper), f"{checkpoint_dir(df.sparkSession).rstrip('/')}/summaries-{new_run_id()}"))
    return summaries_of(table, month_prefix, width)


_KEYS = ["m", "h", "d", "bin_idx"]
_SETS = [[], ["m"], ["h"], ["d"], ["bin_idx"]]
_COUNTS = ["n_rows", "n_neg", "n_pos", "n_label", "label_sum"]


def _gid(kept: Sequence[str]) -> int:
    """grouping_id(): bit set for every key aggregated away."""
    return sum(1 << (len(_KEYS) - 1 - i) for i, k in enumerate(_KEYS) if k not in kept)


def summary_counts(df: DataFrame, spec: TripSpec | None = None, width: float = RATIO_BIN_WIDTH,
                   upper: float | None = RATIO_HISTOGRAM_MAX) -> DataFrame:
    """The counts behind the summaries, a row per month, hour, weekday, ratio bin and
    overall (``gid`` says which).  Counts of disjoint rows add up."""
    s = spec or TripSpec()
    ratio = F.col(s.ratio_col)
    in_hist = ratio.isNotNull() if upper is None else ratio.isNotNull() & (ratio <= F.lit(upper))
    keyed = df.select(
        month_start(s.pickup).alias("m"),
        F.hour(s.pickup).alias("h"),
        F.dayofweek(s.pickup).alias("d"),
        F.when(in_hist, C.bin_index(ratio, width)).alias("bin_idx"),
        F.col(s.label_col).alias("label"),
    )
    return keyed.groupingSets(_SETS, *_KEYS).agg(
        F.grouping_id().cast("long").alias("gid"),
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("label") == 0).alias("n_neg"),
        F.count_if(F.col("label") == 1).alias("n_pos"),
        F.count("label").alias("n_label"),
        F.sum("label").cast("double").alias("label_sum"),
    )


def summaries_of(counts: DataFrame, month_prefix: str | None = None, width: float = RATIO_BIN_WIDTH) -> dict:
    """The five summaries as slices of a table of counts."""
    from .balance import balance_from_counts

    table = counts.withColumn("low_rate", F.try_divide("label_sum", "n_label"))
    part = {tuple(k): table.where(F.col("gid") == _gid(k)) for k in _SETS}
    months = part[("m",)].select(F.date_format("m", "yyyy-MM").alias("month"), "n_rows")
    if month_prefix is not None:
        months = months.where(F.col("month").startswith(month_prefix))
    return {
        "balance": balance_from_counts(part[()].select("n_neg", "n_pos")),
        "rows_per_month": months.orderBy("month"),
        "ratio_histogram": part[("bin_idx",)].where(F.col("bin_idx").isNotNull())
        .select("bin_idx", "n_rows", (F.col("bin_idx") * F.lit(float(width))).alias("bin")).orderBy("bin_idx"),
        "rate_by_hour": part[("h",)].select("h", "low_rate", "n_rows").orderBy("h"),
        "rate_by_weekday": part[("d",)].select("d", "low_rate", "n_rows", C.weekday_name("d").alias("day_name"))
        .orderBy("d"),
    }


def append_summary_state(df: DataFrame, path: str, source: str, spec: TripSpec | None = None) -> None:
    """Add the prepared rows of one source (a month, a file) to the stored state:
    its counts and the moments of its columns.  Sources must not share rows; the
    same source again replaces what it stored before.

    ``df`` is evaluated once: the columns that count are written to the shared
    checkpoint folder, read for both parts of the state, and deleted."""
    s, spark = spec or TripSpec(), df.sparkSession
    columns = correlation_columns(s)
    aside = f"{checkpoint_dir(spark).rstrip('/')}/state-rows-{new_run_id()}"
    try:
        write_parquet(df.select(*dict.fromkeys([s.pickup, s.ratio_col, s.label_col, *columns])), aside)
        rows = read_parquet(spark, aside)
        append_metrics(summary_counts(rows, s), path, source, "summary_counts")
        append_metrics(pair_moments(rows, columns), path, source, "summary_moments")
    finally:
        delete_folder(spark, aside)


def summaries_from_state(spark, path: str, spec: TripSpec | None = None, month_prefix: str | None = None) -> dict:
    """The summaries and the correlation over all stored sources, without their rows."""
    s = spec or TripSpec()
    counts = read_metrics(spark, path, "summary_counts").groupBy("gid", *_KEYS).agg(*[F.sum(c).alias(c) for c in _COUNTS])
    moments = merge_moments(read_metrics(spark, path, "summary_moments"))
    return {**summaries_of(counts, month_prefix), "correlation": correlation_of(moments, correlation_columns(s))}
