from .staged import StagedRun, finish_run
from .writers import append_if_any, append_parquet, export_csv, overwrite_parquet, publish_table, replace_table, write_partitions

__all__ = [
    "StagedRun",
    "append_if_any",
    "append_parquet",
    "export_csv",
    "finish_run",
    "overwrite_parquet",
    "publish_table",
    "replace_table",
    "write_partitions",
]
