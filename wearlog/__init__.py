"""Run-to-failure sensor analytics on Spark: lazy DataFrame operators keyed
on (dataset_id, unit_id). See README.md for the operator map."""

from .functions.ids import dataset_ids_col, fd_id_col, normalize_fd_id, parse_dataset_ids
from .operators.features import build_labeled_features, build_rolling_features, feature_names
from .operators.fingerprint import dataframe_fingerprint, fingerprint_value
from .operators.labels import add_rul_targets, add_test_rul_targets, missing_truth_units, positional_truth
from .operators.latest import dedupe_keep_last, latest_row_per_unit, unit_trajectory
from .operators.metrics import align_predictions, metric_bounds, metrics_dict, regression_metrics
from .operators.quantiles import exact_quantiles
from .operators.sensors import compute_sensor_summary, suggest_low_variance_sensors
from .operators.sequences import create_sequence_dataset
from .operators.split import apply_split, rows_of_units, split_by_unit, split_counts, split_units
from .operators.unit_layout import row_ordinal, unit_layout
from .session import build_session, materialize

__all__ = [
    "add_rul_targets",
    "add_test_rul_targets",
    "align_predictions",
    "apply_split",
    "build_labeled_features",
    "build_rolling_features",
    "build_session",
    "compute_sensor_summary",
    "create_sequence_dataset",
    "dataframe_fingerprint",
    "dataset_ids_col",
    "dedupe_keep_last",
    "exact_quantiles",
    "fd_id_col",
    "feature_names",
    "fingerprint_value",
    "latest_row_per_unit",
    "materialize",
    "metric_bounds",
    "metrics_dict",
    "missing_truth_units",
    "normalize_fd_id",
    "parse_dataset_ids",
    "positional_truth",
    "regression_metrics",
    "row_ordinal",
    "rows_of_units",
    "split_by_unit",
    "split_counts",
    "split_units",
    "suggest_low_variance_sensors",
    "unit_layout",
    "unit_trajectory",
]
