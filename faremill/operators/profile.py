"""Column profiling: summaries, correlations, histograms and category shares.

Each report is one aggregate over all its columns, so a profile costs one scan however many
columns it covers.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faremill.operators.quantiles import exact_quantiles
from faremill.operators.ranking import top_per_group
from faremill.sources.catalog import numeric_columns

QUARTILES = (0.25, 0.5, 0.75)
_MOMENTS = {
    "count": F.count,
    "mean": F.avg,
    "stddev": F.stddev_samp,
    "min": F.min,
    "max": F.max,
}


def summary(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    quartiles: str | None = "approx",
    accuracy: int = 10_000,
) -> DataFrame:
    """Count, mean, sample deviation, extremes and quartiles, one row per numeric column.

    ``quartiles`` is ``"approx"`` (sketch, same scan), ``"exact"`` (linear interpolation,
    one more scan) or None.
    """
    columns = list(columns or numeric_columns(df))
    if quartiles == "exact":
        lines = exact_quantiles(
            df, columns, QUARTILES, interpolation="linear", accuracy=accuracy, facts=_MOMENTS
        )
        quartile = {
            name: F.max(F.when(F.col("probability") == q, F.col("quantile")))
            for name, q in zip(("p25", "p50", "p75"), QUARTILES)
        }
        return lines.groupBy("column", *_MOMENTS).agg(
            *[value.alias(name) for name, value in quartile.items()]
        )

    def line(name: str) -> Column:
        value = F.col(name).cast("double")
        fields = [F.lit(name).alias("column")]
        fields += [aggregate(value).alias(fact) for fact, aggregate in _MOMENTS.items()]
        if quartiles == "approx":
            sketch = F.percentile_approx(value, list(QUARTILES), accuracy)
            fields += [sketch[i].alias(f"p{int(q * 100)}") for i, q in enumerate(QUARTILES)]
        return F.struct(*fields)

    return _one_row_to_lines(df, [line(name) for name in columns])


def text_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count and alphabetical extremes, one row per string column."""
    columns = columns or [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return _one_row_to_lines(
        df,
        [
            F.struct(
                F.lit(name).alias("column"),
                F.count(name).alias("count"),
                F.min(name).alias("min"),
                F.max(name).alias("max"),
            )
            for name in columns
        ],
    )


def target_correlation(
    df: DataFrame,
    target: str = "total_amount",
    columns: Sequence[str] | None = None,
    exclude: Sequence[str] = ("fare_amount", "tolls_amount"),
    nulls: str = "zero",
) -> DataFrame:
    """Pearson correlation of numeric columns with a target, strongest first.

    ``nulls="zero"`` counts a NULL as 0 (what ``df.stat.corr`` does); ``"pairwise"`` leaves
    out rows where either side is NULL.
    """
    columns = columns or numeric_columns(df, exclude=(target, *exclude))
    lines = [
        F.struct(
            F.lit(name).alias("column"),
            F.corr(_number(name, nulls), _number(target, nulls)).alias("correlation"),
        )
        for name in columns
    ]
    return _one_row_to_lines(df, lines).orderBy(F.abs("correlation").desc(), "column")


def correlation_matrix(
    df: DataFrame, columns: Sequence[str], nulls: str = "pairwise"
) -> DataFrame:
    """Full correlation matrix in long form; each unordered pair is computed once."""

    def cell(a: str, b: str, value: Column) -> Column:
        return F.struct(
            F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), value.alias("correlation")
        )

    pairs = list(combinations(columns, 2))
    computed = df.agg(
        *[
            F.corr(_number(a, nulls), _number(b, nulls)).alias(f"r{i}")
            for i, (a, b) in enumerate(pairs)
        ]
    )
    cells = [cell(name, name, F.lit(1.0)) for name in columns]
    for i, (a, b) in enumerate(pairs):
        cells += [cell(a, b, F.col(f"r{i}")), cell(b, a, F.col(f"r{i}"))]
    return computed.select(F.inline(F.array(*cells)))


def histogram(
    df: DataFrame, column: str, low: float = 0.0, high: float = 200.0, bins: int = 100
) -> DataFrame:
    """Fixed-width histogram. Bins are left-closed, the last also contains ``high``;
    values outside are ignored and empty bins are listed with zero."""
    width = (high - low) / bins
    value = F.col(column).cast("double")
    number = F.least(F.floor((value - low) / width), F.lit(bins - 1)).cast("int")
    counts = (
        df.filter((value >= low) & (value <= high))
        .groupBy(number.alias("bin"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    every_bin = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every_bin.join(counts, "bin", "left").select(
        "bin",
        (F.lit(low) + F.col("bin") * width).alias("bin_low"),
        (F.lit(low) + (F.col("bin") + 1) * width).alias("bin_high"),
        F.coalesce("rows", F.lit(0)).alias("frequency"),
    )


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row count of every non-NULL value of several columns, in one scan."""
    pairs = [
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns
    ]
    return (
        df.select(F.inline(F.array(*pairs)))
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def category_shares(df: DataFrame, columns: Sequence[str], top: int = 10) -> DataFrame:
    """Share of each category among the non-NULL values, three decimals, top values only."""
    counts = value_counts(df, columns)
    totals = counts.groupBy("column").agg(F.sum("rows").alias("total"))
    leaders = top_per_group(counts, ["column"], [F.col("rows").desc(), F.col("value").asc()], top)
    return leaders.join(F.broadcast(totals), "column").select(  # one row per listed column
        "column", "value", "rows", F.round(F.col("rows") / F.col("total"), 3).alias("share")
    )


def _number(name: str, nulls: str) -> Column:
    value = F.col(name).cast("double")
    return F.coalesce(value, F.lit(0.0)) if nulls == "zero" else value


def _one_row_to_lines(df: DataFrame, lines: Sequence[Column]) -> DataFrame:
    return df.agg(F.array(*lines).alias("lines")).select(F.inline("lines"))
