"""Lookup baseline: predict a trip's amount by the average of its cell."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.functions.calendar import (
    hour_of_day,
    in_months,
    instant,
    month_key,
    weekday_name,
    weekday_number,
)
from faremill.schema import CELL_KEYS

_AVERAGE = "avg_amount_per_trip"


def holdout_rows(trips: DataFrame, test_months: Sequence[str]) -> DataFrame:
    """Cell keys and true amount of the trips in the test months.

    Months are tested as time ranges, so the table scan is pruned to them.
    """
    return trips.filter(in_months(list(test_months), trips=trips)).select(
        "color",
        "pu_borough",
        "do_borough",
        month_key().alias("month_ym"),
        weekday_name(weekday_number()).alias("dow_name"),
        hour_of_day().alias("hour_of_day"),
        F.col("total_amount").alias("y_true"),
    )


def needed_trips(
    trips: DataFrame, test_months: Sequence[str], history_before: str | None = None
) -> DataFrame:
    """The trips whose cells a lookup can find, as a time range that reaches the scan."""
    if history_before is None:
        return trips.filter(in_months(list(test_months), trips=trips))
    return trips.filter(F.col("pickup_ts") < instant(f"{history_before}-01"))


def history_keys(history_before: str | None) -> list[str]:
    """Join keys: without test months in the lookup, the month cannot be part of the key."""
    return [k for k in CELL_KEYS if history_before is None or k != "month_ym"]


def lookup_table(
    cells: DataFrame, history_before: str | None = None, test_months: Sequence[str] | None = None
) -> DataFrame:
    """The averages to look up.

    By default cells of the test months themselves are used, as published; other months' cells
    can't be found by any test trip and are left out where ``test_months`` are given. With
    ``history_before`` (a ``yyyy-MM`` month) only earlier cells count, weighted by trips.
    """
    keys = history_keys(history_before)
    if history_before is None:
        within = cells if test_months is None else cells.filter(F.col("month_ym").isin(list(test_months)))
        return within.select(*keys, _AVERAGE)
    weighted = F.try_divide(
        F.sum(F.col(_AVERAGE) * F.col("total_trips")),
        F.sum(F.when(F.col(_AVERAGE).isNotNull(), F.col("total_trips"))),
    )
    past = cells.filter(F.col("month_ym") < history_before)
    return past.groupBy(*keys).agg(weighted.alias(_AVERAGE))


def baseline_predictions(
    trips: DataFrame,
    cells: DataFrame,
    test_months: Sequence[str],
    history_before: str | None = None,
) -> DataFrame:
    """Test trips with ``y_true``, the cell average (NULL if unmatched) and ``y_hat``.

    An unmatched trip gets its colour's mean of the matched averages. That mean is summed
    up cell by cell, so no window ever holds all trips of one colour; both joins are
    ordinary left joins, which Spark broadcasts on measured size and splits where a key is hot.
    """
    keys = history_keys(history_before)
    lookup = lookup_table(cells, history_before, test_months)
    rows = holdout_rows(trips, test_months)
    means = _per_cell(rows, lookup, keys).groupBy("color").agg(_color_mean().alias("mean"))
    filled = rows.join(lookup, keys, "left").join(means, "color", "left")
    return filled.select(*CELL_KEYS, "y_true", _AVERAGE, F.coalesce(_AVERAGE, "mean").alias("y_hat"))


def baseline_metrics(
    trips: DataFrame,
    cells: DataFrame,
    test_months: Sequence[str],
    history_before: str | None = None,
) -> DataFrame:
    """Rows, matched rows, coverage and RMSE of the baseline, without joining single trips.

    All trips of a cell share one prediction, so count, mean and variance of the cell give
    its squared error exactly: n * ((mean - y_hat)^2 + variance). The join moves one row per
    cell, whatever the number of trips in the hottest one. Unmatched trips of a colour
    share its fallback, so they too need only their count, mean and mean square.
    """
    keys = history_keys(history_before)
    per_cell = _per_cell(holdout_rows(trips, test_months), lookup_table(cells, history_before, test_months), keys)
    n, mean, variance, looked_up = (
        F.col(c) for c in ("n_true", "mean_true", "var_true", _AVERAGE)
    )
    matched = looked_up.isNotNull()
    error = n * (F.pow(mean - looked_up, F.lit(2)) + variance)
    per_color = per_cell.groupBy("color").agg(
        F.sum("n_rows").alias("rows"),
        F.sum(F.when(matched, F.col("n_rows"))).alias("matched"),
        F.sum(F.when(matched, n)).alias("n_matched"),
        F.sum(F.when(matched, error)).alias("error_matched"),
        F.sum(F.when(~matched, n)).alias("n_open"),
        F.sum(F.when(~matched, n * mean)).alias("sum_open"),
        F.sum(F.when(~matched, n * (variance + mean * mean))).alias("square_open"),
        _color_mean().alias("fallback"),
    )
    n_open, fallback = F.col("n_open"), F.col("fallback")
    error_open = (
        F.col("square_open") - 2.0 * fallback * F.col("sum_open") + n_open * fallback * fallback
    )
    scored = F.coalesce("n_matched", F.lit(0)) + F.coalesce(
        F.when(fallback.isNotNull(), n_open), F.lit(0)
    )
    squared = F.coalesce("error_matched", F.lit(0.0)) + F.coalesce(
        F.greatest(error_open, F.lit(0.0)), F.lit(0.0)
    )
    total = F.coalesce(F.sum("rows"), F.lit(0))
    hits = F.coalesce(F.sum("matched"), F.lit(0))
    return per_color.agg(
        total.alias("test_rows"),
        hits.alias("matched_rows"),
        F.try_divide(hits, total).alias("coverage"),
        F.sqrt(F.try_divide(F.sum(squared), F.sum(scored))).alias("rmse"),
    )


def _per_cell(rows: DataFrame, lookup: DataFrame, keys: list[str]) -> DataFrame:
    grouped = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("y_true").alias("n_true"),
        F.avg("y_true").alias("mean_true"),
        F.var_pop("y_true").alias("var_true"),
    )
    return grouped.join(lookup, keys, "left")


def _color_mean():
    """Mean looked-up average over the matched trips of a colour."""
    matched = F.when(F.col(_AVERAGE).isNotNull(), F.col("n_rows"))
    return F.try_divide(F.sum(F.col(_AVERAGE) * F.col("n_rows")), F.sum(matched))
