"""Shared helpers: words, scratch columns, tables in the shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.session import ensure_checkpoint_dir

# fixed values: what separates words, as characters, as a Java pattern, and the letters lower-cased
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str | Column) -> Column:
    """The text, empty for null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    """Runs of characters other than space, tab, line feed, vertical tab, form feed, return."""
    return F.array_remove(F.split(text, SPACE_RUN), "")


def text_words(text: str | None) -> list[bytes]:
    """The same words in Python, lower-cased A-Z only, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def each_text(batch: pa.Array, rows: int = 256) -> Iterator[str | None]:
    """The texts of an Arrow batch, some at a time: a batch may hold thousands of long ones."""
    for low in range(0, len(batch), rows):
        yield from batch.slice(low, rows).to_pylist()


def remainder(column: str, modulus: int) -> Column:
    """crc32 of the column as text, modulo ``modulus``; a null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % modulus


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the frame doesn't have yet."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: With it Spark removes a query's shuffle files at its end, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write the frame to the shared folder and read it back, which cuts its lineage; its shuffles are removed."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with _shuffles_removed(spark):
        df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._stored_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``stored`` has returned. Nothing lazy may read them any more."""
    for table in tables:
        context = table.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(table._stored_at)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


#: Bytes of data, written as text, that may be broadcast.
BROADCAST_BYTES = 32 << 20


def small_side(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """The frame, to be broadcast if it has been measured to hold few bytes; else joined by shuffle."""
    size = df.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))).cast("long")).alias("size")).first()["size"] or 0
    return F.broadcast(df) if size <= most else df
