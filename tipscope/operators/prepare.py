"""Cleaning, derived columns and labelling.

``clean_trips`` is one narrow stage: Catalyst combines the stacked ``where``
calls into a single ``Filter`` and pushes what it can into the Parquet scan.
All rules are taken from the :class:`~tipscope.specs.TripSpec`.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..specs import TripSpec


def _spec(spec: TripSpec | None) -> TripSpec:
    return spec or TripSpec()


def _dtype(df: DataFrame, name: str):
    return df.schema[name].dataType


# --- single rules -----------------------------------------------------------

def payment_rule(spec: TripSpec | None = None) -> Column:
    """card payments only (tips of other payments are not recorded)."""
    s = _spec(spec)
    return F.col(s.payment) == F.lit(s.card_payment)


def fare_rule(spec: TripSpec | None = None) -> Column:
    s = _spec(spec)
    return C.within(s.fare, s.fare_bounds)


def distance_rule(spec: TripSpec | None = None) -> Column:
    s = _spec(spec)
    return C.within(s.distance, s.distance_bounds)


def passenger_rule(spec: TripSpec | None = None) -> Column:
    s = _spec(spec)
    return C.within(s.passengers, s.passenger_bounds)


def duration_rule(spec: TripSpec | None = None) -> Column:
    s = _spec(spec)
    return C.within(s.duration_col, s.duration_bounds)


def speed_rule(spec: TripSpec | None = None) -> Column:
    s = _spec(spec)
    return C.within(s.speed_col, s.speed_bounds)


def filter_payment(df: DataFrame, spec: TripSpec | None = None) -> DataFrame:
    return df.where(payment_rule(spec))


def filter_fare(df: DataFrame, spec: TripSpec | None = None) -> DataFrame:
    return df.where(fare_rule(spec))


def filter_distance(df: DataFrame, spec: TripSpec | None = None) -> DataFrame:
    return df.where(distance_rule(spec))


def filter_passengers(df: DataFrame, spec: TripSpec | None = None) -> DataFrame:
    return df.where(passenger_rule(spec))


def filter_duration(df: DataFrame, spec: TripSpec | None = None) -> DataFrame:
    """F5 on the derived duration column (adds it when missing)."""
    s = _spec(spec)
    if s.duration_col not in df.columns:
        df = add_duration(df, s)
    return df.where(duration_rule(s))


def filter_speed(df: DataFrame, spec: TripSpec | None = None) -> DataFrame:
    """F6 on the derived speed column (adds duration and speed when missing)."""
    s = _spec(spec)
    if s.duration_col not in df.columns:
        df = add_duration(df, s)
    if s.speed_col not in df.columns:
        df = add_speed(df, s)
    return df.where(speed_rule(s))


# --- derived columns --------------------------------------------------------

def add_duration(df: DataFrame, spec: TripSpec | None = None) -> DataFrame:
    """Whole-second trip duration in the spec's unit (minutes by default)."""
    s = _spec(spec)
    return df.withColumn(
        s.duration_col,
        C.elapsed(s.pickup, s.dropoff, s.duration_unit_seconds,
                  _dtype(df, s.pickup), _dtype(df, s.dropoff)),
    )


def add_speed(df: DataFrame, spec: TripSpec | None = None) -> DataFrame:
    """Distance per hour (or per the spec's time divisor)."""
    s = _spec(spec)
    return df.withColumn(s.speed_col, C.speed(s.distance, s.duration_col, s.speed_time_divisor))


def add_time_features(df: DataFrame, spec: TripSpec | None = None) -> DataFrame:
    """Pickup hour, day of week (1 = Sunday), weekend and night flags."""
    s = _spec(spec)
    ts = F.col(s.pickup)
    return df.withColumns({
        s.hour_col: F.hour(ts),
        s.dow_col: F.dayofweek(ts),
        s.weekend_col: C.is_weekend(ts),
        s.night_col: C.is_night(ts),
    })


def fill_nulls(df: DataFrame, spec: TripSpec | None = None) -> DataFrame:
    """Missing surcharges become 0 and a missing rate code becomes the fill code."""
    s = _spec(spec)
    present = [c for c in s.surcharges if c in df.columns]
    out = df.fillna(0, subset=present) if present else df
    if s.rate_code in df.columns:
        out = out.fillna(s.rate_code_fill, subset=[s.rate_code])
    return out


def clean_trips(df: DataFrame, spec: TripSpec | None = None) -> DataFrame:
    """the full cleaning rule set, in the order that fixes NULL semantics.

    Range rules run *before* any fill, so a NULL fare, distance, passenger
    count or timestamp makes its predicate NULL and drops the row; only the
    surcharge columns and the rate code are imputed afterwards.
    """
    s = _spec(spec)
    out = filter_payment(df, s)
    out = add_duration(out, s)
    out = out.where(fare_rule(s) & distance_rule(s) & passenger_rule(s) & duration_rule(s))
    out = add_speed(out, s).where(speed_rule(s))
    out = add_time_features(out, s)
    return fill_nulls(out, s)


def add_label(df: DataFrame, spec: TripSpec | None = None, threshold: float | None = None) -> DataFrame:
    """``label`` = 1 when tip / fare < threshold (strict); NULL tip gives NULL."""
    s = _spec(spec)
    t = s.threshold if threshold is None else threshold
    return df.withColumn(s.label_col, C.threshold_label(s.tip, s.fare, t))


def add_tip_ratio(df: DataFrame, spec: TripSpec | None = None) -> DataFrame:
    """P10: ``tip_pct`` = tip / fare (NULL when the fare is zero or missing)."""
    s = _spec(spec)
    return df.withColumn(s.ratio_col, C.rate(s.tip, s.fare))


def prepare(df: DataFrame, spec: TripSpec | None = None) -> DataFrame:
    """Clean, label and add the tip ratio in one lazy plan."""
    s = _spec(spec)
    return add_tip_ratio(add_label(clean_trips(df, s), s), s)
