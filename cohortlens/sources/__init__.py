from cohortlens.sources.tables import load_table, outcomes, outcomes_raw, period_counts
from cohortlens.sources.files import (
    read_table, write_table, sniff_delimiter, Roles, save_features, load_features,
    save_predictions, load_predictions, has_model, save_model, load_model, load_first,
    record_frame,
)

__all__ = [
    "load_table", "outcomes", "outcomes_raw", "period_counts", "read_table", "write_table",
    "sniff_delimiter", "Roles", "save_features", "load_features", "save_predictions",
    "load_predictions", "has_model", "save_model", "load_model", "load_first", "record_frame",
]
