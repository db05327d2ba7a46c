"""Column-expression helpers (built-in Spark functions only)."""
from .columns import (  # noqa: F401
    bin_index,
    bin_start,
    elapsed,
    epoch_seconds,
    hash_bucket,
    is_night,
    is_weekend,
    rate,
    speed,
    threshold_label,
    weekday_name,
    within,
)
