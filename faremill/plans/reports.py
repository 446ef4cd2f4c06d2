"""Business reports over the enriched trip table. Every function returns a lazy DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faremill.functions.bins import DURATION_BINS, Bins
from faremill.functions.calendar import (
    hour_of_day,
    in_year,
    month_key,
    month_label,
    month_start,
    weekday_name,
    weekday_number,
)
from faremill.functions.money import average_money, to_cents
from faremill.functions.trip import duration_minutes
from faremill.operators.quantiles import exact_quantiles
from faremill.operators.ranking import top_per_group, top_ranks, total_of
from faremill.schema import CELL_KEYS

# --- demand and averages per month ------------------------------------------------------


def monthly(trips: DataFrame, **measures: Column) -> DataFrame:
    """Any set of aggregates per pick-up month, labelled after the aggregation."""
    grouped = (
        trips.filter(F.col("pickup_ts").isNotNull())
        .groupBy(month_start().alias("month_start"))
        .agg(*[column.alias(name) for name, column in measures.items()])
    )
    return grouped.select(*_month_columns(), *measures).orderBy("month_start")


def trips_per_month(trips: DataFrame) -> DataFrame:
    return monthly(trips, total_trips=F.count(F.lit(1)))


def average_passengers(trips: DataFrame) -> DataFrame:
    """Mean passengers per trip: zeros count, NULLs do not."""
    return monthly(trips, avg_passengers_per_trip=F.round(F.avg("passenger_count"), 2))


def average_amount(trips: DataFrame, money: str = "round") -> DataFrame:
    return monthly(trips, avg_amount_per_trip=average_money("total_amount", money))


def amount_per_passenger(trips: DataFrame) -> DataFrame:
    """Mean of the per-trip amount per passenger, over trips that carried passengers."""
    carried = F.col("passenger_count") > 0
    per_head = F.when(carried, F.col("total_amount") / F.col("passenger_count"))
    return monthly(trips, avg_amount_per_passenger=F.round(F.avg(per_head), 2))


def busiest_weekday(trips: DataFrame) -> DataFrame:
    """Weekday with most trips per month; ties go to the first name in the alphabet."""
    counts = (
        _trips_by_month_and(trips, weekday_number().alias("dow"))
        .withColumn("top_day_of_week", weekday_name("dow"))
        .drop("dow")
    )
    return _top_of_month(counts, "top_day_of_week", "trips_on_top_dow")


def busiest_hour(trips: DataFrame) -> DataFrame:
    """Hour with most trips per month; ties go to the earlier hour."""
    counts = _trips_by_month_and(trips, hour_of_day().alias("top_hour_of_day"))
    return _top_of_month(counts, "top_hour_of_day", "trips_in_top_hour")


def _trips_by_month_and(trips: DataFrame, slot: Column) -> DataFrame:
    return (
        trips.filter(F.col("pickup_ts").isNotNull())
        .groupBy(month_start().alias("month_start"), slot)
        .agg(F.count(F.lit(1)).alias("trips"))
    )


def _top_of_month(counts: DataFrame, slot: str, measure: str) -> DataFrame:
    top = top_per_group(counts, ["month_start"], [F.col("trips").desc(), F.col(slot).asc()])
    return top.select(
        month_label("month_start").alias("month_label"),
        month_key("month_start").alias("month_ym"),
        slot,
        F.col("trips").alias(measure),
    ).orderBy("month_ym")


def _month_columns() -> list[Column]:
    return [
        F.col("month_start"),
        month_key("month_start").alias("month_ym"),
        month_label("month_start").alias("month_label"),
    ]


# --- statistics per feed and per cell ---------------------------------------------------


def color_stats(trips: DataFrame, median: str = "approx", accuracy: int = 10_000) -> DataFrame:
    """Average, median, minimum and maximum of duration, distance and speed per feed.

    ``median="approx"`` is the one-scan sketch at ``accuracy``; ``"exact"`` returns the
    lower middle element at the price of a second scan.
    """
    measures = ("duration_min", "distance_km", "speed_kmh")
    measured = [F.col(c).isNotNull() for c in ("duration_sec", "distance_km", "speed_kmh")]
    base = trips.filter(measured[0] & measured[1] & measured[2]).select(
        "color", duration_minutes().alias("duration_min"), "distance_km", "speed_kmh"
    )
    kinds = {"avg": F.avg, "min": F.min, "max": F.max}
    if median == "approx":
        kinds["median"] = lambda value: F.percentile_approx(value, 0.5, accuracy)
        stats = {f"{k}_{m}": f(F.col(m)) for m in measures for k, f in kinds.items()}
        grouped = base.groupBy("color")
    elif median == "exact":
        lines = exact_quantiles(
            base, measures, [0.5], by=["color"], accuracy=accuracy, facts=kinds
        ).withColumnRenamed("quantile", "median")
        stats = {
            f"{k}_{m}": F.max(F.when(F.col("column") == m, F.col(k)))
            for m in measures
            for k in (*kinds, "median")
        }
        grouped = lines.groupBy("color")
    else:
        raise ValueError(f"unknown median {median!r}")
    rounded = [
        F.round(stats[f"{kind}_{m}"], 2).alias(f"{kind}_{m}")
        for m in measures
        for kind in ("avg", "median", "min", "max")
    ]
    return grouped.agg(*rounded).orderBy("color")


def cell_stats(trips: DataFrame, money: str = "round") -> DataFrame:
    """Trips, distance and amounts per colour, borough pair, month, weekday and hour."""
    grouped = (
        trips.filter(
            F.col("pickup_ts").isNotNull()
            & F.col("pu_borough").isNotNull()
            & F.col("do_borough").isNotNull()
        )
        .groupBy(
            "color",
            "pu_borough",
            "do_borough",
            month_start().alias("month_start"),
            weekday_number().alias("dow"),
            hour_of_day().alias("hour_of_day"),
        )
        .agg(
            F.count(F.lit(1)).alias("total_trips"),
            F.round(F.avg("distance_km"), 2).alias("avg_distance_km"),
            average_money("total_amount", money).alias("avg_amount_per_trip"),
            (F.sum(to_cents("total_amount")) / 100).alias("total_amount_paid"),
        )
    )
    labels = {"month_ym": month_key("month_start"), "dow_name": weekday_name("dow")}
    return grouped.withColumns(labels).select(
        *CELL_KEYS,
        "total_trips",
        "avg_distance_km",
        "avg_amount_per_trip",
        "total_amount_paid",
    )


# --- revenue ----------------------------------------------------------------------------


def pair_revenue_share(trips: DataFrame, year: int, top: int = 10) -> DataFrame:
    """Revenue share of the top borough pairs of one year (rank ties are all kept)."""
    pairs = (
        trips.filter(
            in_year(year, trips=trips) & F.col("pu_borough").isNotNull() & F.col("do_borough").isNotNull()
        )
        .groupBy("pu_borough", "do_borough")
        .agg(F.sum(to_cents("total_amount")).alias("cents"))
    )
    # whole cents: ranks, cut and total are the same in every evaluation
    leaders = top_ranks(pairs, "cents", top)
    share = F.try_divide(F.col("cents") * 100, total_of(pairs, "cents"))
    return leaders.select(
        "pu_borough",
        "do_borough",
        (F.col("cents") / 100).alias("total_revenue"),
        F.round(share, 2).alias("revenue_share_pct"),
    ).orderBy(F.col("total_revenue").desc(), "pu_borough", "do_borough")


# --- tips and duration bins -------------------------------------------------------------


def tip_shares(trips: DataFrame) -> DataFrame:
    """Share of trips with a tip, and of tipped trips with a tip of 15 or more."""
    return _measured_and_paid(trips).agg(*_tip_counters()).select(*_tip_percentages())


def duration_bins(trips: DataFrame, bins: Bins = DURATION_BINS) -> DataFrame:
    """Speed and km per dollar by duration bin, with the overall tip shares on each row.

    The tip totals are sums of per-bin counters, so both halves come from one scan; the
    list gathered in between has one entry per bin.
    """
    counters = ("trips", "tipped", "tipped_15")
    per_bin = (
        _measured_and_paid(trips)
        .groupBy(bins.order(duration_minutes()).alias("bin_order"))
        .agg(
            F.avg("speed_kmh").alias("speed"),
            F.avg(F.col("distance_km") / F.col("total_amount")).alias("km_per_dollar"),
            *_tip_counters(),
        )
    )
    line = F.struct("bin_order", "speed", "km_per_dollar")
    return (
        per_bin.agg(F.collect_list(line).alias("lines"), *[F.sum(c).alias(c) for c in counters])
        .select(*_tip_percentages(), F.inline("lines"))
        .orderBy("bin_order")
        .select(
            "pct_trips_with_tips",
            "pct_tips_ge_15",
            bins.label("bin_order").alias("duration_bin"),
            F.round("speed", 2).alias("avg_speed_kmh"),
            F.round("km_per_dollar", 4).alias("avg_km_per_dollar"),
        )
    )


def duration_bin_revenue(
    trips: DataFrame, bins: Bins = DURATION_BINS, money: str = "round"
) -> DataFrame:
    """Revenue, speed and km per dollar by duration bin, best revenue first.

    Zero and negative amounts stay in; a zero amount has no km-per-dollar ratio.
    """
    ratio = F.try_divide(F.col("distance_km"), F.col("total_amount"))
    return (
        trips.filter(F.col("duration_sec").isNotNull() & F.col("total_amount").isNotNull())
        .groupBy(bins.order(duration_minutes()).alias("bin_order"))
        .agg(
            average_money("total_amount", money).alias("avg_revenue_per_trip"),
            F.round(F.avg("speed_kmh"), 2).alias("avg_speed_kmh"),
            F.round(F.avg(ratio), 4).alias("avg_km_per_dollar"),
        )
        .orderBy(F.col("avg_revenue_per_trip").desc(), "bin_order")
        .select(
            bins.label("bin_order").alias("duration_bin"),
            "avg_revenue_per_trip",
            "avg_speed_kmh",
            "avg_km_per_dollar",
        )
    )


def _measured_and_paid(trips: DataFrame) -> DataFrame:
    measured = [F.col(c).isNotNull() for c in ("duration_sec", "distance_km", "speed_kmh")]
    return trips.filter(measured[0] & measured[1] & measured[2] & (F.col("total_amount") > 0))


def _tip_counters() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("trips"),
        F.count_if(F.col("tip_amount") > 0).alias("tipped"),
        F.count_if(F.col("tip_amount") >= 15).alias("tipped_15"),
    ]


def _tip_percentages() -> list[Column]:
    def percent(part: str, whole: str) -> Column:
        hundredfold = F.col(part).cast("decimal(20,0)") * 100
        return F.round(F.try_divide(hundredfold, F.col(whole).cast("decimal(20,0)")), 2)

    return [
        percent("tipped", "trips").cast("double").alias("pct_trips_with_tips"),
        percent("tipped_15", "tipped").cast("double").alias("pct_tips_ge_15"),
    ]
