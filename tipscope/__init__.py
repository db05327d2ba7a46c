"""tipscope: Spark-native trip analytics and imbalance-aware classification.

The names below are the everyday entry points; every operator lives in
``tipscope.operators`` / ``tipscope.sources`` and takes a ``TripSpec``.
"""
from .operators.balance import add_class_weights, balance_record, class_balance, majority_baseline
from .operators.compare import best_model, cost_tradeoff, report_rows, train_and_compare
from .operators.explore import (
    class_histogram,
    correlation,
    rate_by_hour,
    rate_by_weekday,
    ratio_histogram,
    retention,
    rows_per_month,
)
from .operators.features import build_feature_pipeline
from .operators.metrics import auc, evaluate_predictions, metric_record, threshold_metrics
from .operators.models import make_models
from .operators.prepare import add_label, add_tip_ratio, clean_trips, prepare
from .operators.sampling import hash_sample, hash_split, random_split, target_row_sample
from .operators.scaling import data_scaling, linear_reference, speedup, time_fit, timed_run
from .session import checkpoint_dir, configure
from .sources.parquet import load_trips
from .specs import LINEITEM_TRIPS, LOW_TIP_THRESHOLD, TAXI, Bound, TripSpec

__version__ = "0.1.0"

__all__ = [
    "Bound", "LINEITEM_TRIPS", "LOW_TIP_THRESHOLD", "TAXI", "TripSpec",
    "add_class_weights", "add_label", "add_tip_ratio", "auc", "balance_record", "best_model",
    "build_feature_pipeline", "checkpoint_dir", "class_balance", "class_histogram", "clean_trips",
    "configure", "correlation", "cost_tradeoff", "data_scaling", "evaluate_predictions", "hash_sample",
    "hash_split", "linear_reference", "load_trips", "majority_baseline", "make_models", "metric_record",
    "prepare", "random_split", "rate_by_hour", "rate_by_weekday", "ratio_histogram",
    "report_rows", "retention", "rows_per_month", "speedup", "target_row_sample", "threshold_metrics",
    "time_fit", "timed_run", "train_and_compare",
]
