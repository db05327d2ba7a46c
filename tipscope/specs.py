"""Column specifications.

Every operator in the package is parameterised by a :class:`TripSpec` rather
than by hard-coded column names, so the same cleaning / labelling / feature
code runs on the canonical taxi-style schema and on the fixture adapters built
from the local test tables.
"""
from __future__ import annotations

from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Bound:
    """A numeric range rule; ``None`` on a side means unbounded."""

    lo: float | None
    hi: float | None
    lo_inclusive: bool = False
    hi_inclusive: bool = False

    def describe(self) -> str:
        left = "[" if self.lo_inclusive else "("
        right = "]" if self.hi_inclusive else ")"
        return f"{left}{self.lo}, {self.hi}{right}"


# ---------------------------------------------------------------------------
# Fixed values of the trip task (must match the reference for equal results).
#   canonical columns and types, cleaning bounds, fill values, label threshold,
#   numeric feature order, categorical features, weekday labels, night hours,
#   weekend days and the exploratory-analysis constants.
# ---------------------------------------------------------------------------
CANONICAL_TYPES: dict[str, str] = {
    "tpep_pickup_datetime": "timestamp",
    "tpep_dropoff_datetime": "timestamp",
    "passenger_count": "double",
    "trip_distance": "double",
    "RatecodeID": "double",
    "PULocationID": "int",
    "DOLocationID": "int",
    "payment_type": "int",
    "fare_amount": "double",
    "extra": "double",
    "tip_amount": "double",
    "tolls_amount": "double",
    "total_amount": "double",
    "congestion_surcharge": "double",
    "airport_fee": "double",
}
LOW_TIP_THRESHOLD = 0.10
FARE_BOUNDS = Bound(0, 500)
DISTANCE_BOUNDS = Bound(0, 100)
PASSENGER_BOUNDS = Bound(1, 6, True, True)
DURATION_BOUNDS = Bound(1, 180, True, True)
SPEED_BOUNDS = Bound(0, 100, False, True)
SURCHARGE_COLUMNS = ("extra", "tolls_amount", "congestion_surcharge", "airport_fee")
RATE_CODE_FILL = 1.0
NUMERIC_FEATURES = (
    "trip_distance",
    "passenger_count",
    "trip_duration_min",
    "avg_speed_mph",
    "fare_amount",
    "extra",
    "tolls_amount",
    "congestion_surcharge",
    "airport_fee",
    "pickup_hour",
    "is_weekend",
    "is_night",
    "PULocationID",
    "DOLocationID",
)
CATEGORICAL_FEATURES = ("pickup_dow", "RatecodeID")
WEEKDAY_NAMES = ("Dom", "Lun", "Mar", "Mie", "Jue", "Vie", "Sab")  # labels of dayofweek 1..7 (Sunday first)
NIGHT_FROM_HOUR = 22
NIGHT_TO_HOUR = 5
WEEKEND_DAYS = (1, 7)
# Columns excluded from the correlation matrix (zone ids are identifiers).
CORRELATION_EXCLUDED = ("PULocationID", "DOLocationID")
# Exploratory-analysis constants.
RATIO_BIN_WIDTH = 0.02
RATIO_HISTOGRAM_MAX = 0.6
CLASS_HISTOGRAM_BINS = 40
CLASS_HISTOGRAM_FEATURES = ("trip_distance", "trip_duration_min", "fare_amount")
CLASS_HISTOGRAM_LIMITS = (("trip_distance", 25.0), ("trip_duration_min", 80.0), ("fare_amount", 120.0))


@dataclass(frozen=True)
class TripSpec:
    """Roles of the columns of a trip-shaped table plus the task's rules."""

    pickup: str = "tpep_pickup_datetime"
    dropoff: str = "tpep_dropoff_datetime"
    passengers: str = "passenger_count"
    distance: str = "trip_distance"
    fare: str = "fare_amount"
    tip: str = "tip_amount"
    payment: str = "payment_type"
    card_payment: int = 1
    rate_code: str = "RatecodeID"
    rate_code_fill: float = RATE_CODE_FILL
    surcharges: tuple[str, ...] = SURCHARGE_COLUMNS
    fare_bounds: Bound = FARE_BOUNDS
    distance_bounds: Bound = DISTANCE_BOUNDS
    passenger_bounds: Bound = PASSENGER_BOUNDS
    duration_bounds: Bound = DURATION_BOUNDS
    speed_bounds: Bound = SPEED_BOUNDS
    # duration = whole-second difference / duration_unit_seconds
    duration_unit_seconds: float = 60.0
    # speed = distance / (duration / speed_time_divisor); minutes -> hours
    speed_time_divisor: float = 60.0
    duration_col: str = "trip_duration_min"
    speed_col: str = "avg_speed_mph"
    hour_col: str = "pickup_hour"
    dow_col: str = "pickup_dow"
    weekend_col: str = "is_weekend"
    night_col: str = "is_night"
    label_col: str = "label"
    ratio_col: str = "tip_pct"
    weight_col: str = "class_weight"
    threshold: float = LOW_TIP_THRESHOLD
    numeric_features: tuple[str, ...] = NUMERIC_FEATURES
    categorical_features: tuple[str, ...] = CATEGORICAL_FEATURES
    canonical_types: tuple[tuple[str, str], ...] = field(
        default_factory=lambda: tuple(CANONICAL_TYPES.items())
    )

    def with_(self, **kw) -> "TripSpec":
        return replace(self, **kw)

    @property
    def types(self) -> dict[str, str]:
        return dict(self.canonical_types)


TAXI = TripSpec()

# Fixture adapter T1 (lineitem joined to orders, see sources.adapters): the
# duration is measured in days, so its bounds and the speed rule are rescaled.
LINEITEM_TRIPS = TAXI.with_(
    fare_bounds=Bound(0, 100000),
    distance_bounds=Bound(0, 50),
    duration_bounds=Bound(1, 730, True, True),
    speed_bounds=Bound(0, 1, False, True),
    duration_unit_seconds=86400.0,
    speed_time_divisor=1.0,
    threshold=0.015,
)
