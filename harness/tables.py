"""Registered queries that store tables, read them back, and judge approximate quantiles by rank."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.functions.calendar import month_key
from faremill.functions.trip import duration_minutes
from faremill.operators import baseline, profile, sketches
from faremill.plans import reports, stored
from faremill.session import ensure_checkpoint_dir
from faremill.sources import read_zones_checked
from faremill.sources.catalog import numeric_columns
from harness import trip_view as tv

CHANGED = "2000-03"


def _folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _saved(spark: SparkSession, sf_dir: str) -> stored.StoredReports:
    """All tables stored with one feed missing in one month, and that month refreshed."""
    trips = tv.enriched_trips(spark, sf_dir)
    tables = stored.StoredReports(spark, f"reports_{uuid.uuid4().hex}", _folder(spark, "stored"), "exact_cents")
    late = (month_key() == CHANGED) & (F.col("color") == "green")
    tables.save(trips.filter(~late))
    tables.refresh(trips, [CHANGED])
    return tables


def stored_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _saved(spark, sf_dir).cells()


def stored_pair_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.pair_revenue_share(_saved(spark, sf_dir).trips(), tv.REPORT_YEAR)


def stored_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookup baseline from stored trips and stored cells."""
    tables = _saved(spark, sf_dir)
    scored = baseline.baseline_metrics(tables.trips(), tables.cells(), tv.TEST_MONTHS)
    return scored.withColumns({c: F.round(c, 6) for c in ("coverage", "rmse")})


def bucketed_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = tv.enriched_trips(spark, sf_dir)
    cells = reports.cell_stats(baseline.needed_trips(trips, tv.TEST_MONTHS), "exact_cents")
    name = f"baseline_{uuid.uuid4().hex}"
    errors = stored.bucketed_baseline(trips, cells, tv.TEST_MONTHS, name, _folder(spark, "bucketed"), 8)
    return errors.withColumn("squared_error", F.round("squared_error", 6))


def zones_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zones written as CSV beside lines that are too short or have no numeric key, and read again."""
    zones = tv.zones(spark, sf_dir)
    text = F.concat_ws(",", F.col("LocationID").cast("string"), "Borough", F.concat(F.lit(" "), "Zone"), "service_zone")
    region = spark.read.parquet(f"{sf_dir}/region.parquet")
    short = region.select(F.concat_ws(",", F.col("r_regionkey").cast("string"), "r_name").alias("value"))
    wordy = region.select(F.concat(F.lit("x"), F.concat_ws(",", "r_name", F.lit("a"), F.lit("b"), F.lit("c"))).alias("value"))
    path = _folder(spark, "zones")
    header = ",".join(zones.columns)
    lines = zones.select(text.alias("value")).unionByName(short).unionByName(wordy)
    lines.coalesce(1).select(F.concat(F.when(F.monotonically_increasing_id() == 0, header + "\n").otherwise(""), "value")).write.text(path)
    good, rejected = read_zones_checked(spark, path)
    marked = good.withColumn("line", F.lit(None).cast("string"))
    return marked.unionByName(rejected, allowMissingColumns=True)


def _bounded(errors: DataFrame, kind: str, bound: float, *by: str) -> DataFrame:
    return errors.select(F.lit(kind).alias("kind"), *by, "measure", "quantile", "rows", (F.col("rank_error") <= bound).alias("bounded"))


def median_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether medians per feed are within their promised rank: the one-scan form, and sketches stored by month."""
    trips = tv.cleaned_trips(spark, sf_dir)
    values = trips.select("color", duration_minutes().alias("duration_min"), "distance_km", "speed_kmh").filter(
        F.col("duration_min").isNotNull() & F.col("distance_km").isNotNull() & F.col("speed_kmh").isNotNull()
    )
    claim = lambda m: F.array(F.struct(F.lit(0.5).alias("quantile"), F.col(m).alias("value")))
    quick = values.groupBy("color").agg(*[F.percentile_approx(m, 0.5, 10_000).alias(m) for m in stored.MEASURES])
    merged = sketches.merged_stats(stored.feed_sketches(trips), stored.MEASURES, ["color"])
    kept = merged.select("color", *[F.col(f"median_{m}").alias(m) for m in stored.MEASURES])
    parts = []
    for kind, frame, bound in (("one_scan", quick, 1e-4), ("sketch", kept, sketches.RANK_ERROR)):
        claims = frame.select("color", *[claim(m).alias(m) for m in stored.MEASURES])
        parts.append(_bounded(sketches.rank_errors(values, claims, stored.MEASURES, ["color"]), kind, bound, "color"))
    return parts[0].unionByName(parts[1])


def quartile_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the quartiles of ``summary_approx`` are within their promised rank, for every numeric column."""
    feeds = tv.cleaned_feeds(spark, sf_dir)
    columns = numeric_columns(feeds)
    lines = profile.summary(feeds, columns)
    pairs = F.array(*[F.struct(F.lit(q).alias("quantile"), F.col(p).alias("value")) for q, p in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))])
    claims = lines.agg(*[F.max(F.when(F.col("column") == c, pairs)).alias(c) for c in columns])
    errors = sketches.rank_errors(feeds.select(*[F.col(c).cast("double").alias(c) for c in columns]), claims, columns)
    return _bounded(errors, "one_scan", 1e-4)


QUERIES = {
    "stored_cells": stored_cells,
    "stored_pair_share": stored_pair_share,
    "stored_baseline": stored_baseline,
    "bucketed_baseline": bucketed_baseline,
    "zones_from_csv": zones_from_csv,
    "median_ranks": median_ranks,
    "quartile_ranks": quartile_ranks,
}
