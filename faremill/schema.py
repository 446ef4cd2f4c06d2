"""Column contracts of the trip and zone tables, and the feed normaliser."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names of the trip feeds and of the zone dimension.
TRIP_CONTRACT = T.StructType(
    [
        T.StructField("pickup_ts", T.TimestampType()),
        T.StructField("dropoff_ts", T.TimestampType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("passenger_count", T.DoubleType()),
        T.StructField("payment_type", T.LongType()),
        T.StructField("PULocationID", T.IntegerType()),
        T.StructField("DOLocationID", T.IntegerType()),
    ]
)
OPTIONAL_MEASURES = T.StructType(
    [
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("ehail_fee", T.DoubleType()),
        T.StructField("trip_type", T.DoubleType()),
        T.StructField("airport_fee", T.DoubleType()),
    ]
)
ZONE_CONTRACT = T.StructType(
    [
        T.StructField("LocationID", T.IntegerType()),
        T.StructField("Borough", T.StringType()),
        T.StructField("Zone", T.StringType()),
        T.StructField("service_zone", T.StringType()),
    ]
)

# Grain of the stored cell statistics.
CELL_KEYS = ("color", "pu_borough", "do_borough", "month_ym", "dow_name", "hour_of_day")


class SchemaMismatch(ValueError):
    """A feed lacks a column that the trip contract requires."""


@dataclass(frozen=True)
class FeedSpec:
    """How one feed names its timestamps and which columns it must be padded with."""

    color: str
    pickup_column: str
    dropoff_column: str
    fillers: Mapping[str, float] = field(default_factory=dict)


YELLOW_FEED = FeedSpec(
    color="yellow",
    pickup_column="tpep_pickup_datetime",
    dropoff_column="tpep_dropoff_datetime",
    fillers={"ehail_fee": 0.0, "trip_type": 0.0},
)
GREEN_FEED = FeedSpec(
    color="green",
    pickup_column="lpep_pickup_datetime",
    dropoff_column="lpep_dropoff_datetime",
    fillers={"airport_fee": 0.0},
)


def conform(feed: DataFrame, spec: FeedSpec) -> DataFrame:
    """Project one raw feed onto the trip contract in a single ``select``.

    Contract columns are matched case-insensitively, spelled canonically and cast to
    their contract type; columns outside the contract pass through. The two feed-specific
    timestamps become ``pickup_ts`` / ``dropoff_ts`` and ``color`` marks the feed.
    """
    by_lower = {name.lower(): name for name in feed.columns}
    sources = {"pickup_ts": spec.pickup_column, "dropoff_ts": spec.dropoff_column}
    missing = [
        wanted
        for wanted in (sources.get(f.name, f.name) for f in TRIP_CONTRACT)
        if wanted.lower() not in by_lower
    ]
    if missing:
        raise SchemaMismatch(f"feed {spec.color!r} lacks {', '.join(missing)}")

    projected: list[Column] = []
    used: set[str] = set()
    for contract_field in [*TRIP_CONTRACT, *OPTIONAL_MEASURES]:
        source = by_lower.get(sources.get(contract_field.name, contract_field.name).lower())
        if source is None:
            continue
        used.add(source)
        projected.append(
            F.col(f"`{source}`").cast(contract_field.dataType).alias(contract_field.name)
        )
    projected += [F.col(f"`{name}`") for name in feed.columns if name not in used]
    projected += [
        F.lit(float(value)).alias(name)
        for name, value in spec.fillers.items()
        if name.lower() not in by_lower
    ]
    projected.append(F.lit(spec.color).alias("color"))
    return feed.select(*projected)
