"""Tables that change under their readers: new versions behind one name, and months refreshed in place.

A published name is a view on the files of one version. A new version is written beside the old one and
the name is switched to it in one catalog call, so a reader sees the old or the new table and never a
missing one; a table may be replaced by a query on itself, with other columns. Older versions stay until
``versions_before`` names them for removal.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def publish(df: DataFrame, name: str, folder: str, partition_by: Sequence[str] = (), fmt: str = "parquet") -> DataFrame:
    """Write a new version of ``name`` under ``folder`` and switch the name to it.

    A table that has the name, not a view, is kept under another one, ``{name}_before_...``.
    """
    path = f"{folder}/{name}/{uuid.uuid4().hex}"
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.format(fmt).partitionBy(*partition_by).save(path)
    spark = df.sparkSession
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType in ("MANAGED", "EXTERNAL"):
        spark.sql(f"ALTER TABLE `{name}` RENAME TO `{name}_before_{uuid.uuid4().hex}`")
    spark.sql(f"CREATE OR REPLACE VIEW `{name}` AS SELECT * FROM {fmt}.`{path}`")
    return spark.table(name)


def version_path(spark: SparkSession, name: str) -> str:
    """The folder that holds the files behind a published name."""
    files = spark.table(name).inputFiles()
    found = {file[: file.index(f"/{name}/") + len(name) + 34] for file in files}
    if len(found) != 1:
        raise ValueError(f"{name} isn't one published version")
    return found.pop()


def refresh_partitions(df: DataFrame, path: str, by: str, values: Sequence[str], fmt: str = "parquet") -> None:
    """Rewrite only the folders ``by`` in ``values`` of the table at ``path`` with the rows of ``df`` in them.

    ``df`` may read other tables but not the folders that it replaces. Values without rows are emptied.
    """
    spark = df.sparkSession
    wanted = df.filter(F.col(by).isin(list(values)))
    fresh = wanted.hint("rebalance", by)
    fresh.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).save(path)
    kept = {row[0] for row in spark.read.format(fmt).load(path).filter(F.col(by).isin(list(values))).select(by).distinct().collect()}
    present = {row[0] for row in wanted.select(by).distinct().collect()}
    for value in kept - present:  # as many as values at most
        empty = spark.createDataFrame([], spark.read.format(fmt).load(path).schema).drop(by)
        empty.write.format(fmt).mode("overwrite").save(f"{path}/{by}={value}")


def save_bucketed(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Store a table in ``buckets`` sorted buckets of its keys, so that joins and aggregates on these need no shuffle."""
    laid = df.repartition(buckets, *keys)
    laid.write.option("path", path).bucketBy(buckets, *keys).sortBy(*keys).mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)
