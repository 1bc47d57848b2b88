from .fares import cheapest_itineraries, documents_to_itineraries, run_fares
from .operations import daily_operations, run_daily_operations
from .publish import profile_and_publish
from .weather import clean_forecast, clean_observed, run_forecast, run_observed

__all__ = [
    "cheapest_itineraries",
    "clean_forecast",
    "clean_observed",
    "daily_operations",
    "documents_to_itineraries",
    "profile_and_publish",
    "run_daily_operations",
    "run_fares",
    "run_forecast",
    "run_observed",
]
