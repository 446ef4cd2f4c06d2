"""Registered queries: library calls on the trip view."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.functions.calendar import calendar_features, month_key
from faremill.functions.money import clean_target
from faremill.functions.portions import unit_hash
from faremill.operators import baseline, enrich, features, profile, quality, sampling
from faremill.plans import modelling, reports
from faremill.session import stored
from harness import models, tables
from harness import trip_view as tv
from harness.models import ROW_KEYS

Query = Callable[[SparkSession, str], DataFrame]

# The columns that the published analysis lists.
EDA_COLUMNS = [
    "passenger_count",
    "distance_km",
    "duration_sec",
    "speed_kmh",
    "total_amount",
    "tip_amount",
]
CATEGORIES = ["color", "pu_borough", "do_borough", "payment_type", "day_of_week"]
EXACT = "exact_cents"


def _on_enriched(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(tv.enriched_trips(spark, sf_dir))


def _on_cleaned(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(tv.cleaned_trips(spark, sf_dir))


def _on_feeds(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(tv.cleaned_feeds(spark, sf_dir))


def _on_raw(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(tv.raw_trips(spark, sf_dir))


def _cells(trips: DataFrame) -> DataFrame:
    return reports.cell_stats(trips, money=EXACT)


def _rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, digits) for name in names})


def _with_month(trips: DataFrame) -> DataFrame:
    """Rows the models use: a known amount, with their month."""
    return trips.filter(F.col("total_amount").isNotNull()).withColumn("month", month_key())


def _fractions(trips: DataFrame) -> DataFrame:
    return sampling.month_fractions(_with_month(trips), tv.TEST_MONTHS)


def _sample(trips: DataFrame) -> DataFrame:
    picked = sampling.temporal_sample(_with_month(trips), tv.TEST_MONTHS, unit_hash(*ROW_KEYS))
    return picked.select("month", *ROW_KEYS, "total_amount")


def _simple_fraction(trips: DataFrame) -> DataFrame:
    return sampling.fraction(trips, 0.05, keys=ROW_KEYS, seed=7).select(*ROW_KEYS, "total_amount")


def _split(trips: DataFrame) -> DataFrame:
    labelled = sampling.temporal_split(
        _with_month(trips), tv.TEST_MONTHS, unit_hash(*ROW_KEYS, seed=43)
    )
    return labelled.groupBy("split", "month").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("total_amount"), 2).alias("amount")
    )


def _native_sample(trips: DataFrame) -> DataFrame:
    dated = _with_month(trips)
    picked = sampling.stratified_sample_native(dated, _fractions(trips))
    return sampling.fraction(picked, 0.5).groupBy("month").agg(F.count(F.lit(1)).alias("rows"))


def _native_split(trips: DataFrame) -> DataFrame:
    parts = sampling.temporal_split_native(_with_month(trips), tv.TEST_MONTHS)
    named = [
        part.groupBy("month").agg(F.count(F.lit(1)).alias("rows")).withColumn("split", F.lit(name))
        for name, part in zip(("train", "val", "test"), parts)
    ]
    return named[0].unionByName(named[1]).unionByName(named[2])


def _baseline_rows(trips: DataFrame) -> DataFrame:
    """Cells, colour means and rows are three reads, so the trips of the test months are stored once."""
    columns = ["color", "pu_borough", "do_borough", "pickup_ts", "distance_km", "total_amount"]
    needed = stored(baseline.needed_trips(trips, tv.TEST_MONTHS).select(*columns), "test-trips")
    predicted = baseline.baseline_predictions(needed, _cells(needed), tv.TEST_MONTHS)
    return _rounded(predicted, 6, "y_hat")


def _baseline_metrics(trips: DataFrame) -> DataFrame:
    cells = _cells(baseline.needed_trips(trips, tv.TEST_MONTHS))
    scored = baseline.baseline_metrics(trips, cells, tv.TEST_MONTHS)
    return _rounded(scored, 6, "coverage", "rmse")


def _baseline_history(trips: DataFrame) -> DataFrame:
    cells = _cells(baseline.needed_trips(trips, tv.TEST_MONTHS, tv.TEST_MONTHS[0]))
    scored = baseline.baseline_metrics(trips, cells, tv.TEST_MONTHS, history_before=tv.TEST_MONTHS[0])
    return _rounded(scored, 6, "coverage", "rmse")


def _log_target(trips: DataFrame) -> DataFrame:
    cleaned = trips.withColumn("target", clean_target("total_amount"))
    return cleaned.select(
        *ROW_KEYS,
        "target",
        F.round(F.log1p("target"), 9).alias("log_target"),
        F.round(F.expm1(F.log1p("target")), 6).alias("restored"),
    )


def _violations(trips: DataFrame) -> DataFrame:
    return quality.violations(trips, limits=tv.LIMITS).select(
        "failed_rule", *ROW_KEYS, "pickup_ts", "dropoff_ts", "duration_sec", "total_amount"
    )


def _modes(trips: DataFrame) -> DataFrame:
    return features.column_modes(modelling.model_frame(trips), features.CATEGORICAL)


# Reports that need no zone run on the cleaned trips: a left join cannot change them.
QUERIES: dict[str, Query] = {
    # cleaning and enrichment
    "cleaned_trips": _on_cleaned(lambda t: t),
    "attrition": _on_raw(lambda t: quality.attrition(t, limits=tv.LIMITS)),
    "violations": _on_raw(_violations),
    "speed_offenders": _on_raw(lambda t: quality.speed_offenders(t, tv.LIMITS)),
    "enriched_trips": tv.enriched_feeds,
    "zone_match": _on_enriched(enrich.match_report),
    "unmatched_zones": _on_enriched(enrich.unmatched_keys),
    "residual_negative_speed": _on_cleaned(quality.negative_speed_check),
    # reports
    "trips_per_month": _on_cleaned(reports.trips_per_month),
    "busiest_weekday": _on_cleaned(reports.busiest_weekday),
    "busiest_hour": _on_cleaned(reports.busiest_hour),
    "avg_passengers": _on_cleaned(reports.average_passengers),
    "avg_amount": _on_cleaned(lambda t: reports.average_amount(t, EXACT)),
    "amount_per_passenger": _on_cleaned(reports.amount_per_passenger),
    "color_stats": _on_cleaned(lambda t: reports.color_stats(t, median="exact")),
    "color_stats_approx": _on_cleaned(reports.color_stats),
    "cell_stats": _on_enriched(_cells),
    "pair_revenue_share": _on_enriched(lambda t: reports.pair_revenue_share(t, tv.REPORT_YEAR)),
    "tip_shares": _on_cleaned(reports.tip_shares),
    "duration_bins": _on_cleaned(reports.duration_bins),
    "duration_bin_revenue": _on_cleaned(lambda t: reports.duration_bin_revenue(t, money=EXACT)),
    # profiling
    "summary": _on_feeds(
        lambda t: _rounded(
            profile.summary(t, quartiles="exact"),
            6,
            *["mean", "stddev", "min", "max", "p25", "p50", "p75"],
        )
    ),
    "summary_approx": _on_feeds(profile.summary),
    "text_summary": _on_enriched(profile.text_summary),
    "target_correlation": _on_feeds(
        lambda t: _rounded(profile.target_correlation(t), 9, "correlation")
    ),
    "correlation_matrix": _on_cleaned(
        lambda t: _rounded(profile.correlation_matrix(t, EDA_COLUMNS), 9, "correlation")
    ),
    "amount_histogram": _on_cleaned(lambda t: profile.histogram(t, "total_amount")),
    "category_shares": _on_enriched(
        lambda t: profile.category_shares(calendar_features(t), CATEGORIES)
    ),
    # sampling and baseline
    "sampling_fractions": _on_cleaned(lambda t: _rounded(_fractions(t), 9, "fraction")),
    "stratified_sample": _on_cleaned(_sample),
    "simple_fraction": _on_cleaned(_simple_fraction),
    "temporal_split": _on_cleaned(_split),
    "native_sample": _on_cleaned(_native_sample),
    "native_split": _on_cleaned(_native_split),
    "baseline_predictions": _on_enriched(_baseline_rows),
    "baseline_metrics": _on_enriched(_baseline_metrics),
    "baseline_history": _on_enriched(_baseline_history),
    # modelling
    "mode_imputation": _on_enriched(_modes),
    "log_target": _on_cleaned(_log_target),
    "linear_metrics": _on_enriched(lambda t: modelling.linear_metrics(models.prepared(t, False))),
    "ridge_metrics": _on_enriched(lambda t: modelling.ridge_metrics(models.prepared(t, False))),
    "huber_metrics": _on_enriched(lambda t: modelling.huber_metrics(models.prepared(t))),
    "mlp_metrics": _on_enriched(lambda t: modelling.mlp_metrics(models.prepared(t))),
    **{name: _on_enriched(query) for name, query in models.QUERIES.items()},
    # stored tables and sketches
    **tables.QUERIES,
}
