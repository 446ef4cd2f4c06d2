"""Category indices as a table, for vocabularies that outgrow the driver and one-hot vectors.

The table has one row per value, numbered in the order of values. It is built by range partitions and
their counts, and joined where rows are encoded, so neither a driver map nor one window over a column's
values limits its size; Spark broadcasts it only where it measures small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from faremill.session import stored


def category_index(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, index, rows): every known value of each column, indices from 0 in the order of values.

    NULL is no value. Counts combine on the map side; only distinct values are sorted.
    """
    lines = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    pairs = train.select(F.inline(F.array(*lines))).filter(F.col("value").isNotNull())
    counts = pairs.groupBy("column", "value").agg(F.count(F.lit(1)).alias("rows"))
    dealt = counts.repartitionByRange("column", "value").sortWithinPartitions("column", "value")
    numbered = dealt.withColumns({"piece": F.spark_partition_id(), "place": F.monotonically_increasing_id()})
    laid = stored(numbered, "category-values")
    pieces = laid.groupBy("column", "piece").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    # one row per partition, not per value
    earlier = Window.partitionBy("column").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")
    starts = pieces.select("column", "piece", shift.alias("shift"))
    placed = laid.join(starts, ["column", "piece"])
    return stored(placed.select("column", "value", (F.col("place") + F.col("shift")).alias("index"), "rows"), "category-index")


def with_indices(df: DataFrame, table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Adds ``{column}_index`` by a join per column; NULL where the value is unknown or missing."""
    for column in columns:
        known = table.filter(F.col("column") == column).select(
            F.col("value").alias("_value"), F.col("index").alias(f"{column}_index")
        )
        df = df.join(known, F.col(column).cast("string") == F.col("_value"), "left").drop("_value")
    return df


def onehot_counts(df: DataFrame, table: DataFrame, columns: Sequence[str], *by: str) -> DataFrame:
    """Ones per one-hot column: (``by``, column, index, rows). Unknown values are zero vectors: index NULL."""
    indexed = with_indices(df, table, columns)
    lines = [F.struct(F.lit(c).alias("column"), F.col(f"{c}_index").alias("index")) for c in columns]
    return indexed.select(*by, F.inline(F.array(*lines))).groupBy(*by, "column", "index").agg(F.count(F.lit(1)).alias("rows"))
