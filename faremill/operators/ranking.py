"""Top rows per group and top shares of a total."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_group(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int = 1
) -> DataFrame:
    """First ``n`` rows of every group. Spark prunes to ``n`` per task before the shuffle."""
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") <= n).drop("_rn")


def top_ranks(df: DataFrame, measure: str, n: int) -> DataFrame:
    """Rows whose descending RANK over the whole frame is at most ``n``, ties included.

    Equivalent to keeping values not below the ``n``-th largest, which a top-k finds
    without moving the frame into one window partition. NULLs rank last, as in SQL: once
    one of them is among the first ``n`` rows, every row qualifies.
    """
    leaders = df.select(measure).orderBy(F.col(measure).desc_nulls_last()).limit(n)
    facts = F.struct(
        F.min(measure).alias("nth"), (F.count(F.lit(1)) > F.count(measure)).alias("has_null")
    )
    cut = leaders.agg(facts).scalar()
    return df.filter(cut["has_null"] | (F.col(measure) >= cut["nth"]))


def total_of(df: DataFrame, measure: str) -> Column:
    """Grand total of ``measure`` as a scalar subquery, usable in any other frame."""
    return df.agg(F.sum(measure)).scalar()
