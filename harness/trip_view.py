"""A trip-shaped view over ``lineitem``, ``orders``, ``nation`` and ``region``.

Arithmetic is on integers or exact cents, so any engine derives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.functions.trip import derive_measures
from faremill.operators.enrich import enrich, union_feeds
from faremill.operators.quality import Limits, clean
from faremill.schema import GREEN_FEED, YELLOW_FEED, FeedSpec, conform
from faremill.sources.readers import normalise_zones

LIMITS = Limits(date_min="1996-01-01", date_max="2001-06-30")
REPORT_YEAR = 2000
TEST_MONTHS = ["2001-04", "2001-05", "2001-06"]


def _feed_extras(color: str) -> list[Column]:
    """Stand-ins for the columns that only one of the feeds carries."""
    line = F.col("l_linenumber")
    if color == "green":
        return [
            (line.cast("double") / 4).alias("ehail_fee"),
            (line % 2 + 1).cast("double").alias("trip_type"),
        ]
    return [(line % 3).alias("Airport_fee")]


def _lines(spark: SparkSession, sf_dir: str, only: Column | None = None) -> DataFrame:
    """Line items with trip values, joined to the second their order was placed.

    Values are computed below the join, so filters on them run before the shuffle and
    timestamps stay short expressions. Both tables grow alike, so they are joined by shuffle at any size: a
    task holds its share of the orders, and line items are neither sorted nor broadcast to.
    """
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    if only is not None:
        lineitem = lineitem.filter(only)
    cents = F.floor((F.col("l_extendedprice") - 3000) / 10)
    values = lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_returnflag",
        ((F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 3607) % 86400).alias("offset"),
        ((F.col("l_partkey") * 37 + F.col("l_suppkey") * 11) % 25200 - 600).alias("ride"),
        (F.col("l_quantity") * F.col("l_discount") * 30).alias("trip_distance"),
        (cents / F.lit(100.0)).alias("total_amount"),
        (F.floor(F.col("l_tax") * F.col("l_extendedprice") / 2) / F.lit(100.0)).alias("tip_amount"),
        F.when(F.col("l_linenumber") != 7, F.col("l_linenumber") - 1)
        .cast("double")
        .alias("passenger_count"),
        (F.col("l_suppkey") % 6 + 1).alias("payment_type"),
        (F.col("l_suppkey") % 27).cast("int").alias("PULocationID"),
        (F.col("l_partkey") % 26).cast("int").alias("DOLocationID"),
    )
    placed = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).alias("placed")
    )
    return values.join(placed.hint("shuffle_hash"), F.col("l_orderkey") == F.col("o_orderkey"))


def _columns(pickup_name: str, dropoff_name: str) -> list[Column]:
    start = F.col("placed") + F.col("offset")
    return [
        F.timestamp_seconds(start).alias(pickup_name),
        F.timestamp_seconds(start + F.col("ride")).alias(dropoff_name),
        *[
            F.col(name)
            for name in (
                "trip_distance",
                "total_amount",
                "tip_amount",
                "passenger_count",
                "payment_type",
                "PULocationID",
                "DOLocationID",
            )
        ],
    ]


def _is_green() -> Column:
    return F.coalesce(F.col("l_returnflag") == "R", F.lit(False))


def raw_feed(spark: SparkSession, sf_dir: str, spec: FeedSpec) -> DataFrame:
    """One feed with its own column names, as a source would deliver it."""
    only = _is_green() if spec.color == "green" else ~_is_green()
    return _lines(spark, sf_dir, only).select(
        *_columns(spec.pickup_column, spec.dropoff_column), *_feed_extras(spec.color)
    )


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both feeds on the common columns, from one scan, with derived measures."""
    color = F.when(_is_green(), "green").otherwise("yellow").alias("color")
    keys = [F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")]
    rows = _lines(spark, sf_dir).select(*_columns("pickup_ts", "dropoff_ts"), color, *keys)
    return derive_measures(rows)


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    region = spark.read.parquet(f"{sf_dir}/region.parquet")
    joined = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return normalise_zones(
        joined.select(
            F.col("n_nationkey").alias("LocationID"),
            F.col("r_name").alias("Borough"),
            F.col("n_name").alias("Zone"),
            F.lit("Standard").alias("service_zone"),
        )
    )


def cleaned_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(raw_trips(spark, sf_dir), LIMITS)


def enriched_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(cleaned_trips(spark, sf_dir), zones(spark, sf_dir))


def cleaned_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two differently shaped feeds, conformed, cleaned and united, with the columns that only one carries."""
    feeds = [
        clean(derive_measures(conform(raw_feed(spark, sf_dir, spec), spec)), LIMITS)
        for spec in (YELLOW_FEED, GREEN_FEED)
    ]
    return union_feeds(*feeds)


def enriched_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full path from the feeds to the enriched table."""
    return enrich(cleaned_feeds(spark, sf_dir), zones(spark, sf_dir))
