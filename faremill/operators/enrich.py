"""Union of feeds and the role-playing zone joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_feeds(*feeds: DataFrame) -> DataFrame:
    """Union by name; a column that one feed lacks and no filler supplies becomes NULL."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), feeds)


def unique_by_key(dimension: DataFrame, key: str) -> DataFrame:
    """The dimension with its key proven unique when the plan runs.

    A repeated key would multiply fact rows in a join. The check is part of the plan (an
    aggregate over the small side), so it costs no extra job and cannot be forgotten.
    """
    attributes = [name for name in dimension.columns if name != key]
    counted = (
        dimension.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("_copies"), *[F.first(a).alias(a) for a in attributes])
    )
    duplicate = F.raise_error(
        F.concat(F.lit(f"duplicate key in dimension, {key} = "), F.col(key).cast("string"))
    )
    proven = F.when(F.col("_copies") == 1, F.col(key)).otherwise(duplicate.cast("int"))
    return counted.select(proven.alias(key), *attributes)


def role_join(
    trips: DataFrame,
    dimension: DataFrame,
    role: str,
    fact_key: str,
    dimension_key: str = "LocationID",
) -> DataFrame:
    """Left-join the dimension in one role, its attributes prefixed with ``role``.

    No broadcast hint: a zone table is far below ``spark.sql.autoBroadcastJoinThreshold``
    and is broadcast on its measured size, while an unexpectedly large dimension falls
    back to a shuffled join that adaptive execution splits on hot keys.
    """
    key = f"_{role}_key"
    renamed = dimension.select(
        F.col(dimension_key).alias(key),
        *[
            F.col(name).alias(f"{role}_{name.lower()}")
            for name in dimension.columns
            if name != dimension_key
        ],
    )
    return trips.join(renamed, F.col(fact_key).cast("int") == F.col(key), "left").drop(key)


def enrich(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Attach pick-up (``pu_*``) and drop-off (``do_*``) zone attributes."""
    proven = unique_by_key(zones, "LocationID")
    with_pickup = role_join(trips, proven, "pu", "PULocationID")
    return role_join(with_pickup, proven, "do", "DOLocationID")


def match_report(enriched: DataFrame) -> DataFrame:
    """How many trips found no zone, per role."""
    return enriched.agg(
        F.count_if(F.col("pu_borough").isNull()).alias("missing_pu"),
        F.count_if(F.col("do_borough").isNull()).alias("missing_do"),
        F.count(F.lit(1)).alias("total_rows"),
    )


def unmatched_keys(enriched: DataFrame) -> DataFrame:
    """Distinct location ids without a zone, per role, with their trip counts.

    Both roles come from one scan: each row emits only the roles that failed to match.
    """
    def miss(role: str, key: str):
        return F.when(
            F.col(f"{role}_borough").isNull(),
            F.struct(F.lit(role).alias("role"), F.col(key).cast("int").alias("location_id")),
        )

    misses = F.array_compact(F.array(miss("pu", "PULocationID"), miss("do", "DOLocationID")))
    return (
        enriched.select(F.inline(misses))
        .groupBy("role", "location_id")
        .agg(F.count(F.lit(1)).alias("trips"))
    )
