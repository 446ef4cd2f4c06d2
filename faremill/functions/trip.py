"""Measures derived from one trip row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KM_PER_MILE = 1.60934


def duration_seconds(start: str = "pickup_ts", end: str = "dropoff_ts") -> Column:
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def distance_km(miles: str = "trip_distance") -> Column:
    return F.col(miles).cast("double") * F.lit(KM_PER_MILE)


def speed_kmh(km: Column, seconds: Column) -> Column:
    """Average speed, NULL when the duration is not positive."""
    return F.when(seconds > 0, km / (seconds / F.lit(3600.0)))


def derive_measures(trips: DataFrame) -> DataFrame:
    """Add ``duration_sec``, ``distance_km`` and ``speed_kmh``."""
    return trips.withColumns(
        {"duration_sec": duration_seconds(), "distance_km": distance_km()}
    ).withColumn("speed_kmh", speed_kmh(F.col("distance_km"), F.col("duration_sec")))


def duration_minutes(seconds: str = "duration_sec") -> Column:
    """Minutes rounded to six decimals (the scale of a decimal division by 60)."""
    sixty = F.lit(60).cast("decimal(3,1)")
    return (F.col(seconds).cast("bigint") / sixty).cast("double")
