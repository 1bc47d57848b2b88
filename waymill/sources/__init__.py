from .dated_csv import (
    FILE,
    FORECAST_FILES,
    OBSERVED_FILES,
    DatedCsv,
    day_folders,
    expected_inputs,
    files_by_header,
    list_inputs,
    missing_partitions,
    paths_of,
    read_backfill,
    read_by_header,
    read_dated_csv,
    source_files,
)
from .documents import eligible_files, read_documents
from .tables import catalog_table, inline_table, read_daily, read_state

__all__ = [
    "FILE",
    "FORECAST_FILES",
    "OBSERVED_FILES",
    "DatedCsv",
    "catalog_table",
    "day_folders",
    "eligible_files",
    "expected_inputs",
    "files_by_header",
    "inline_table",
    "list_inputs",
    "missing_partitions",
    "paths_of",
    "read_backfill",
    "read_by_header",
    "read_daily",
    "read_dated_csv",
    "read_documents",
    "read_state",
    "source_files",
]
