from closingbell.functions.dates import candle_date, recent_years, session_year
from closingbell.functions.text import normalise_symbol, shown, shown_number, stable_id
from closingbell.functions.values import missing, not_positive, whole_volume

__all__ = [
    "candle_date",
    "missing",
    "normalise_symbol",
    "not_positive",
    "recent_years",
    "session_year",
    "shown",
    "shown_number",
    "stable_id",
    "whole_volume",
]
