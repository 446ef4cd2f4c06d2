"""Mergeable quantile sketches: built once per feed and month, stored, and merged for any period.

A sketch is a few kilobytes, so a second period, or a new month, costs no second scan of older trips.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sketch size; the rank of a quantile is off by some 2.3 / size ** 0.9, with size 4096 below 0.2 %.
SIZE = 4096
RANK_ERROR = 0.002


def _parts(measures: Mapping[str, Column], size: int, only: Column | None = None) -> list[Column]:
    """The columns of ``measure_sketches``, of all rows or of some."""
    parts = []
    for name, value in measures.items():
        value = value.cast("double") if only is None else F.when(only, value.cast("double"))
        parts += [
            F.kll_sketch_agg_double(value, F.lit(size)).alias(f"{name}_sketch"),
            F.count(value).alias(f"{name}_n"),
            F.sum(value).alias(f"{name}_sum"),
            F.min(value).alias(f"{name}_min"),
            F.max(value).alias(f"{name}_max"),
        ]
    return parts


def measure_sketches(df: DataFrame, measures: Mapping[str, Column], by: Sequence[str | Column], size: int = SIZE) -> DataFrame:
    """Per group and measure ``{m}_sketch`` (NULL without values), ``{m}_n``, ``{m}_sum``, ``{m}_min`` and ``{m}_max``.

    Meant for few groups: beyond 128 in a task, Spark collects and sorts all of the task's rows.
    """
    return df.groupBy(*by).agg(*_parts(measures, size))


def month_sketches(
    df: DataFrame, measures: Mapping[str, Column], by: Sequence[str], month: str, size: int = SIZE, ts: str = "pickup_ts"
) -> DataFrame:
    """``measure_sketches`` by ``by`` and the month of ``ts``.

    Rows are grouped by year, with an aggregate for each of its months, so that a task holds sketches in
    place of rows however many months there are.
    """
    # rows without a time are a group of their own: no year, and any one month
    number = F.coalesce(F.month(ts), F.lit(1))
    lines = [
        F.struct(F.lit(f"{m:02d}").alias(month), F.count_if(number == m).alias("__rows"), *_parts(measures, size, number == m))
        for m in range(1, 13)
    ]
    grouped = df.groupBy(*by, F.date_format(ts, "yyyy-").alias("__year")).agg(F.array(*lines).alias("__months"))
    wide = grouped.select(*by, "__year", F.inline("__months")).where(F.col("__rows") > 0)
    return wide.withColumn(month, F.concat("__year", month)).drop("__year", "__rows")


def merged_stats(sketches: DataFrame, measures: Sequence[str], by: Sequence[str], size: int = SIZE) -> DataFrame:
    """Average, median, minimum and maximum of every measure, from stored sketches alone."""
    parts = []
    for m in measures:
        median = F.kll_sketch_get_quantile_double(F.kll_merge_agg_double(f"{m}_sketch", F.lit(size)), F.lit(0.5))
        parts += [
            F.try_divide(F.sum(f"{m}_sum"), F.sum(f"{m}_n")).alias(f"avg_{m}"),
            F.when(F.sum(f"{m}_n") > 0, median).alias(f"median_{m}"),
            F.min(f"{m}_min").alias(f"min_{m}"),
            F.max(f"{m}_max").alias(f"max_{m}"),
        ]
    return sketches.groupBy(*by).agg(*parts)


def rank_errors(df: DataFrame, claims: DataFrame, measures: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """How far claimed quantiles are from their rank: (``by``, measure, quantile, rows, rank_error).

    ``claims`` has one row per group with an array of (quantile, value) per measure. One scan of counters;
    values that repeat span a range of ranks, from which the error is measured.
    """
    named = claims.select(*by, *[F.col(m).alias(f"_{m}") for m in measures])
    # one row per group: dealt by so few keys, the values would all land in as many tasks
    joined = df.join(F.broadcast(named), list(by) if by else F.lit(True))

    def against(measure: str) -> Column:
        return F.transform(
            f"_{measure}",
            lambda claim: F.struct(
                F.lit(measure).alias("measure"),
                claim["quantile"].alias("quantile"),
                (F.col(measure) < claim["value"]).cast("int").alias("below"),
                (F.col(measure) <= claim["value"]).cast("int").alias("upto"),
            ),
        )

    lines = F.flatten(F.array(*[against(m) for m in measures]))
    counted = joined.select(*by, F.inline(lines)).filter(F.col("below").isNotNull())
    grouped = counted.groupBy(*by, "measure", "quantile").agg(
        F.count(F.lit(1)).alias("rows"), F.avg("below").alias("low"), F.avg("upto").alias("high")
    )
    error = F.greatest(F.col("low") - F.col("quantile"), F.col("quantile") - F.col("high"), F.lit(0.0))
    return grouped.select(*by, "measure", "quantile", "rows", error.alias("rank_error"))
