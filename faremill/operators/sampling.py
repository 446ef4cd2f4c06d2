"""Stratified sampling, random splits and the temporal hold-out.

``unit_hash`` variants choose rows by their own values: they need no shuffle, return the same
rows on every scan and survive lost executors. The native variants wrap Spark's samplers,
whose choice depends on how the input happens to be partitioned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faremill.functions.portions import unit_hash


def month_fractions(
    df: DataFrame,
    test_months: Sequence[str],
    test_fraction: float = 0.03,
    overall_fraction: float = 0.04,
    month: str = "month",
) -> DataFrame:
    """Rows and sampling fraction of each month.

    Test months get ``test_fraction``; the others whatever makes the whole sample
    ``overall_fraction`` of the table, clamped to [0, 1].
    """
    counts = df.groupBy(month).agg(F.count(F.lit(1)).alias("rows"))
    is_test = _in(month, test_months)
    share = counts.agg(
        F.try_divide(F.sum(F.when(is_test, F.col("rows")).otherwise(0)), F.sum("rows"))
    ).scalar()
    other = _other_fraction(share, test_fraction, overall_fraction)
    return counts.select(
        F.col(month),
        F.col("rows"),
        is_test.alias("is_test"),
        F.when(is_test, F.lit(float(test_fraction))).otherwise(other).alias("fraction"),
    )


def temporal_sample(
    df: DataFrame,
    test_months: Sequence[str],
    unit: Column,
    test_fraction: float = 0.03,
    overall_fraction: float = 0.04,
    month: str = "month",
) -> DataFrame:
    """Sample with the fractions of ``month_fractions``, from two row counts only."""
    is_test = _in(month, test_months)
    share = df.agg(F.try_divide(F.count_if(is_test), F.count(F.lit(1)))).scalar()
    other = _other_fraction(share, test_fraction, overall_fraction)
    wanted = F.when(is_test, F.lit(float(test_fraction))).otherwise(other)
    return df.filter(F.col(month).isNotNull() & (unit < wanted))


def stratified_sample(
    df: DataFrame,
    fractions: DataFrame,
    unit: Column,
    month: str = "month",
) -> DataFrame:
    """Keep each row whose number in [0, 1) is below the given fraction of its month."""
    known = fractions.filter(F.col(month).isNotNull()).select(month, "fraction")
    joined = df.join(known, month)
    return joined.filter(unit < F.col("fraction")).drop("fraction")


def stratified_sample_native(
    df: DataFrame, fractions: DataFrame, seed: int = 42, month: str = "month"
) -> DataFrame:
    """``sampleBy`` with the fractions fetched to the driver (one row per month)."""
    wanted = {row[month]: row["fraction"] for row in fractions.select(month, "fraction").collect()}
    return df.sampleBy(month, fractions=wanted, seed=seed)


def fraction(df: DataFrame, share: float, keys: Sequence[str] | None = None, seed: int = 42):
    """Simple random fraction; with ``keys`` chosen by hash, else by Spark's sampler."""
    if share >= 1.0:
        return df
    if keys is None:
        return df.sample(fraction=share, seed=seed)
    return df.filter(unit_hash(*keys, seed=seed) < share)


def temporal_split(
    df: DataFrame,
    test_months: Sequence[str],
    unit: Column,
    train_share: float = 0.8,
    month: str = "month",
) -> DataFrame:
    """Add ``split``: listed months are ``test``, the rest ``train`` or ``val`` by ``unit``."""
    split = F.when(_in(month, test_months), "test").when(unit < train_share, "train")
    return df.withColumn("split", split.otherwise("val"))


def temporal_split_native(
    df: DataFrame,
    test_months: Sequence[str],
    train_share: float = 0.8,
    seed: int = 42,
    month: str = "month",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Train, validation and test frames with Spark's ``randomSplit``."""
    train, val = df.filter(~_in(month, test_months)).randomSplit(
        [train_share, 1.0 - train_share], seed=seed
    )
    return train, val, df.filter(_in(month, test_months))


def first_rows(df: DataFrame, n: int, *order_by: str | Column) -> DataFrame:
    """First ``n`` rows in a given order (a training-set cap)."""
    return df.orderBy(*order_by).limit(n)


def _in(month: str, months: Sequence[str]) -> Column:
    return F.coalesce(F.col(month).isin(*months), F.lit(False))


def _other_fraction(test_share: Column, test_fraction: float, overall: float) -> Column:
    rest = F.try_divide(F.lit(float(overall)) - test_share * test_fraction, 1.0 - test_share)
    return F.least(F.greatest(F.coalesce(rest, F.lit(float(overall))), F.lit(0.0)), F.lit(1.0))
