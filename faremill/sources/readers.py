"""Scans: trip parquet folders, the zone CSV and catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faremill.schema import ZONE_CONTRACT, FeedSpec, conform


def read_trips(spark: SparkSession, path: str, spec: FeedSpec | None = None) -> DataFrame:
    """Scan a parquet folder; with a ``spec`` the feed is put on the trip contract."""
    raw = spark.read.parquet(path)
    return raw if spec is None else conform(raw, spec)


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Scan the zone CSV as text, then type the key and trim the names.

    ``try_cast`` turns a non-numeric key into NULL, which no trip can match.
    """
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in ZONE_CONTRACT])
    raw = spark.read.schema(as_text).option("header", True).csv(path)
    return normalise_zones(raw)


def read_zones_checked(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Zones of the well-formed lines, and the other lines as text (``line``), of a CSV read by its declared types.

    A line with another number of fields, or a key that isn't a number, is kept as a rejected line.
    """
    bad = T.StructField("_line", T.StringType())
    declared = T.StructType([*[T.StructField(f.name, f.dataType) for f in ZONE_CONTRACT], bad])
    options = {"header": True, "columnNameOfCorruptRecord": bad.name, "ignoreLeadingWhiteSpace": True, "ignoreTrailingWhiteSpace": True}
    raw = spark.read.schema(declared).options(**options).csv(path)
    good = normalise_zones(raw.filter(F.col(bad.name).isNull()))
    # only columns that a query names are parsed, and so checked: all are named here, though never used
    line = F.coalesce(F.col(bad.name), F.concat_ws(",", *ZONE_CONTRACT.fieldNames())).alias("line")
    # a plain test of the flag would be pushed into the parser, which sets it only afterwards
    flagged = F.coalesce(F.length(bad.name), F.lit(-1)) >= 0
    return good, raw.filter(flagged).select(line)


def normalise_zones(raw: DataFrame) -> DataFrame:
    key, *labels = ZONE_CONTRACT.fieldNames()
    return raw.select(
        F.trim(F.col(key).cast("string")).try_cast("int").alias(key),
        *[F.trim(F.col(name)).alias(name) for name in labels],
    )


def table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def list_files(df: DataFrame) -> DataFrame:
    """Files behind a file-based scan, one row per file, from its file index; no row is read."""
    files = df.inputFiles()
    if not files:
        return df.sparkSession.createDataFrame([], "file_path string, file_size long")
    listed = df.sparkSession.read.format("binaryFile").load(files)
    return listed.select(F.col("path").alias("file_path"), F.col("length").alias("file_size"))


def preview(df: DataFrame, n: int = 10, *order_by) -> DataFrame:
    """First ``n`` rows; give ``order_by`` a total order to make them deterministic."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)
