"""Reports as stored tables that the next step reads: trips, cells and feed statistics by month."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.functions.calendar import month_key
from faremill.functions.trip import duration_minutes
from faremill.operators import baseline, sketches
from faremill.plans import reports
from faremill.schema import CELL_KEYS
from faremill.sources.versions import publish, refresh_partitions, save_bucketed, version_path

MEASURES = ("duration_min", "distance_km", "speed_kmh")


def feed_sketches(trips: DataFrame) -> DataFrame:
    """Sketches of duration, distance and speed per feed and month, over trips that have all three."""
    known = F.col("duration_sec").isNotNull() & F.col("distance_km").isNotNull() & F.col("speed_kmh").isNotNull()
    values = {"duration_min": duration_minutes(), "distance_km": F.col("distance_km"), "speed_kmh": F.col("speed_kmh")}
    return sketches.month_sketches(trips.filter(known), values, ["color"], "pickup_month")


@dataclass(frozen=True)
class StoredReports:
    """Three published tables in month folders: trips, cells of trips, and sketches of the feeds."""

    spark: SparkSession
    name: str
    folder: str
    money: str = "round"

    def _tables(self, trips: DataFrame) -> dict[str, tuple[DataFrame, str]]:
        return {
            "trips": (trips.withColumn("pickup_month", month_key()), "pickup_month"),
            "cells": (reports.cell_stats(trips, self.money), "month_ym"),
            "sketches": (feed_sketches(trips), "pickup_month"),
        }

    def save(self, trips: DataFrame) -> None:
        """Trips are stored first; the other tables are derived from what was stored."""
        table, by = self._tables(trips)["trips"]
        publish(table, f"{self.name}_trips", self.folder, [by])
        for kind, (table, by) in self._tables(self.trips()).items():
            if kind != "trips":
                publish(table, f"{self.name}_{kind}", self.folder, [by])

    def refresh(self, trips: DataFrame, months: Sequence[str]) -> None:
        """Replace the trips of these months and rebuild what depends on them; other months' files stay."""
        changed = trips.filter(month_key().isin(list(months)))
        table, by = self._tables(changed)["trips"]
        refresh_partitions(table, version_path(self.spark, f"{self.name}_trips"), by, months)
        fresh = self.trips().filter(F.col("pickup_month").isin(list(months)))
        for kind, (table, by) in self._tables(fresh).items():
            if kind != "trips":
                refresh_partitions(table, version_path(self.spark, f"{self.name}_{kind}"), by, months)

    def _read(self, kind: str) -> DataFrame:
        self.spark.catalog.refreshTable(f"{self.name}_{kind}")
        return self.spark.table(f"{self.name}_{kind}")

    def trips(self) -> DataFrame:
        return self._read("trips")

    def cells(self) -> DataFrame:
        return self._read("cells").select(*CELL_KEYS, "total_trips", "avg_distance_km", "avg_amount_per_trip", "total_amount_paid")

    def feed_stats(self, months: Sequence[str] | None = None) -> DataFrame:
        """Average, median, minimum and maximum per feed over any months, from the sketches alone."""
        kept = self._read("sketches")
        if months is not None:
            kept = kept.filter(F.col("pickup_month").isin(list(months)))
        return sketches.merged_stats(kept, MEASURES, ["color"])


def bucketed_baseline(
    trips: DataFrame, cells: DataFrame, test_months: Sequence[str], name: str, folder: str, buckets: int
) -> DataFrame:
    """Errors of the lookup per cell from two tables stored in buckets of the six keys.

    Neither side of the join is shuffled: (keys, trips, cell average, sum of squared errors).
    """
    fact = save_bucketed(baseline.holdout_rows(trips, test_months), f"{name}_fact", f"{folder}/{name}_fact", CELL_KEYS, buckets)
    lookup = save_bucketed(
        baseline.lookup_table(cells, None, test_months), f"{name}_lookup", f"{folder}/{name}_lookup", CELL_KEYS, buckets
    )
    joined = fact.hint("merge").join(lookup, list(CELL_KEYS), "left")
    error = F.pow(F.col("y_true") - F.col("avg_amount_per_trip"), F.lit(2))
    return joined.groupBy(*CELL_KEYS).agg(
        F.count(F.lit(1)).alias("trips"), F.max("avg_amount_per_trip").alias("average"), F.sum(error).alias("squared_error")
    )
