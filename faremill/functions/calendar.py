"""Calendar keys and labels.

Reports group by compact keys (month start, weekday number, hour) and turn them into text
after the aggregation, so formatting runs once per group rather than once per trip.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Weekday names, position = Spark's weekday() + 1 (Monday first).
WEEKDAY_NAMES = (
    "Monday",
    "Tuesday",
    "Wednesday",
    "Thursday",
    "Friday",
    "Saturday",
    "Sunday",
)


def month_start(ts: str = "pickup_ts") -> Column:
    return F.date_trunc("month", F.col(ts))


def month_key(ts: str | Column = "pickup_ts") -> Column:
    return F.date_format(ts, "yyyy-MM")


def month_label(ts: str | Column = "pickup_ts") -> Column:
    return F.date_format(ts, "MMM yyyy")


def weekday_number(ts: str = "pickup_ts") -> Column:
    return F.weekday(F.col(ts))


def weekday_name(number: str | Column) -> Column:
    """Weekday name of a Monday-based number 0-6."""
    number = F.col(number) if isinstance(number, str) else number
    names = F.array(*[F.lit(name) for name in WEEKDAY_NAMES])
    return F.element_at(names, number + F.lit(1))


def hour_of_day(ts: str = "pickup_ts") -> Column:
    return F.hour(F.col(ts))


def _on_month_folders(trips: DataFrame | None, months: list[str]) -> Column:
    """The months as a test on ``pickup_month``, by which a stored trip table is partitioned."""
    if trips is None or "pickup_month" not in trips.columns:
        return F.lit(True)
    return F.col("pickup_month").isin(months)


def in_year(year: int, ts: str = "pickup_ts", trips: DataFrame | None = None) -> Column:
    """Calendar-year predicate as a half-open range, which parquet scans can prune on.

    With the frame it is meant for, partitions of other months are left out as well.
    """
    months = [f"{year:04d}-{month:02d}" for month in range(1, 13)]
    inside = between_instants(ts, dt.datetime(year, 1, 1), dt.datetime(year + 1, 1, 1))
    return inside & _on_month_folders(trips, months)


def in_months(
    months: list[str] | tuple[str, ...], ts: str = "pickup_ts", trips: DataFrame | None = None
) -> Column:
    """Membership in a list of ``yyyy-MM`` months as pushable ranges, one per run.

    With the frame it is meant for, partitions of other months are left out as well.
    """
    starts = sorted({dt.datetime.strptime(m, "%Y-%m") for m in months})
    runs: list[list[dt.datetime]] = []
    for start in starts:
        if runs and runs[-1][1] == start:
            runs[-1][1] = _next_month(start)
        else:
            runs.append([start, _next_month(start)])
    inside = F.lit(False)
    for low, high in runs:
        inside = inside | between_instants(ts, low, high)
    return inside & _on_month_folders(trips, sorted(months))


def between_instants(ts: str, low: dt.datetime, high: dt.datetime) -> Column:
    """``low <= ts < high`` with bounds read as wall-clock time of the session zone."""
    return (F.col(ts) >= instant(low)) & (F.col(ts) < instant(high))


def instant(moment: dt.datetime | str) -> Column:
    return F.lit(str(moment)).cast("timestamp")


def calendar_features(trips: DataFrame, ts: str = "pickup_ts") -> DataFrame:
    """Add the model features ``month``, ``day_of_week`` and ``hour_of_day``."""
    return trips.withColumns(
        {
            "month": month_key(ts),
            "day_of_week": weekday_name(weekday_number(ts)),
            "hour_of_day": hour_of_day(ts),
        }
    )


def _next_month(start: dt.datetime) -> dt.datetime:
    return dt.datetime(start.year + start.month // 12, start.month % 12 + 1, 1)
