from faremill.functions.bins import DURATION_BINS, Bins
from faremill.functions.calendar import (
    calendar_features,
    hour_of_day,
    in_year,
    month_key,
    month_start,
    weekday_name,
    weekday_number,
)
from faremill.functions.money import average_money, clean_target, to_cents
from faremill.functions.portions import unit_hash
from faremill.functions.trip import derive_measures, duration_minutes

__all__ = [
    "DURATION_BINS",
    "Bins",
    "average_money",
    "calendar_features",
    "clean_target",
    "derive_measures",
    "duration_minutes",
    "hour_of_day",
    "in_year",
    "month_key",
    "month_start",
    "to_cents",
    "unit_hash",
    "weekday_name",
    "weekday_number",
]
