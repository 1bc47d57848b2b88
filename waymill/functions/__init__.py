from .columns import (
    charge,
    charge_total,
    compact_date,
    compact_time,
    joined,
    path_stamp,
    stamp_in_path,
    translate_codes,
)

__all__ = [
    "charge",
    "charge_total",
    "compact_date",
    "compact_time",
    "joined",
    "path_stamp",
    "stamp_in_path",
    "translate_codes",
]
