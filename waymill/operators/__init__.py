from .incremental import high_water_mark, high_water_marks, newer_than, newer_than_per_key, read_mark
from .lookup import attach_name, distinct_pairs, match_unique, one_name_per_code
from .missing import column_means, drop_all_null, fill_mean, fill_mode, fill_zero, most_frequent, typed_readings
from .nested import explode_array, explode_map_values, fare_offers, itinerary_legs, map_entries, pick_entry
from .profile import branch_counts, column_profile
from .ranking import cheapest_per_key, least_row_per_key
from .reshape import keep_targets, rename_columns, union_all

__all__ = [
    "attach_name",
    "branch_counts",
    "cheapest_per_key",
    "column_means",
    "column_profile",
    "distinct_pairs",
    "drop_all_null",
    "explode_array",
    "explode_map_values",
    "fare_offers",
    "fill_mean",
    "fill_mode",
    "fill_zero",
    "high_water_mark",
    "high_water_marks",
    "itinerary_legs",
    "keep_targets",
    "least_row_per_key",
    "map_entries",
    "match_unique",
    "most_frequent",
    "newer_than",
    "newer_than_per_key",
    "one_name_per_code",
    "pick_entry",
    "read_mark",
    "rename_columns",
    "typed_readings",
    "union_all",
]
