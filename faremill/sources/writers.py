"""Sinks: managed tables and temporary views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def save_table(
    df: DataFrame,
    name: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Create or replace a managed table, schema included, and return its scan.

    ``fmt="delta"`` works where the Delta jar is on the class path; its replace needs the
    ``overwriteSchema`` option that the built-in formats do not know.
    """
    writer = df.write.format(fmt).mode("overwrite")
    if fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def save_trips(df: DataFrame, name: str, fmt: str = "parquet") -> DataFrame:
    """Store the trip fact partitioned by pick-up month.

    The rebalance hint lets adaptive execution merge small months and split an oversized
    one across tasks, so neither tiny files nor one giant writer appears; sorting inside a
    task gives row groups tight pick-up ranges, which half-open date filters prune on.
    """
    laid_out = (
        df.withColumn("pickup_month", F.date_format("pickup_ts", "yyyy-MM"))
        .hint("rebalance", F.col("pickup_month"))
        .sortWithinPartitions("pickup_month", "pickup_ts")
    )
    return save_table(laid_out, name, fmt=fmt, partition_by=["pickup_month"])


def temp_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
