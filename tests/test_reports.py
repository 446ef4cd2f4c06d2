from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from faremill.functions import DURATION_BINS, Bins, average_money, clean_target, duration_minutes
from faremill.functions.calendar import calendar_features, in_months
from faremill.functions.trip import derive_measures
from faremill.operators.ranking import top_per_group, top_ranks
from faremill.plans import reports
from helpers import NOON, trip, trips


def enriched(spark, rows):
    df = derive_measures(trips(spark, rows))
    return df.withColumns(
        {
            "pu_borough": F.when(F.col("PULocationID") < 90, F.concat(F.lit("B"), F.col("PULocationID"))),
            "do_borough": F.when(F.col("DOLocationID") < 90, F.concat(F.lit("B"), F.col("DOLocationID"))),
        }
    )


def test_month_reports(spark):
    rows = [
        trip(passengers=0.0, amount=10.0),
        trip(passengers=None, amount=20.0),
        trip(passengers=3.0, amount=30.0),
        trip(pickup=dt.datetime(2020, 6, 1, 1), amount=-5.0, passengers=0.0),
        trip(pickup=None),
    ]
    df = enriched(spark, rows)
    first, second = reports.trips_per_month(df).collect()
    assert (first.month_ym, first.month_label, first.total_trips) == ("2020-05", "May 2020", 3)
    assert second.month_start == dt.datetime(2020, 6, 1) and second.total_trips == 1
    assert [r.avg_passengers_per_trip for r in reports.average_passengers(df).collect()] == [1.5, 0.0]
    for money in ("round", "exact_cents"):
        assert [r.avg_amount_per_trip for r in reports.average_amount(df, money).collect()] == [20.0, -5.0]
    assert [r.avg_amount_per_passenger for r in reports.amount_per_passenger(df).collect()] == [10.0, None]


def test_busiest_slot_breaks_ties(spark):
    monday, tuesday = NOON, NOON + dt.timedelta(days=1, hours=-3)
    df = enriched(spark, [trip(pickup=monday), trip(pickup=tuesday)])
    assert reports.busiest_weekday(df).first().top_day_of_week == "Monday"
    hour = reports.busiest_hour(df).first()
    assert (hour.top_hour_of_day, hour.trips_in_top_hour) == (9, 1)
    more = enriched(spark, [trip(pickup=tuesday)] * 2 + [trip(pickup=monday)])
    assert reports.busiest_weekday(more).first().top_day_of_week == "Tuesday"


@pytest.mark.parametrize(
    "seconds, number", [(299, 1), (300, 2), (600, 3), (1199, 3), (1200, 4), (1800, 5), (3600, 6)]
)
def test_bin_edges(spark, seconds, number):
    df = spark.createDataFrame([(seconds,)], "duration_sec bigint")
    row = df.select(DURATION_BINS.order(duration_minutes()).alias("o")).select(
        "o", DURATION_BINS.label("o").alias("l")
    ).first()
    assert (row.o, row.l) == (number, DURATION_BINS.labels[number - 1])


def test_bins_reject_bad_definitions():
    with pytest.raises(ValueError):
        Bins((5, 3), ("a", "b", "c"))
    with pytest.raises(ValueError):
        Bins((5,), ("a",))


def test_minutes_have_six_decimals(spark):
    df = spark.createDataFrame([(100,)], "duration_sec bigint")
    assert df.select(duration_minutes()).first()[0] == 1.666667


def test_rank_ties_are_all_kept(spark):
    values = [100 - i for i in range(9)] + [50, 50, 50, 40]
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    assert top_ranks(df, "v", 10).count() == 12
    assert top_ranks(df, "v", 11).count() == 12
    assert top_ranks(df, "v", 13).count() == 13
    assert top_ranks(df.filter("v > 1000"), "v", 3).count() == 0


def test_null_ranks_last(spark):
    df = spark.createDataFrame([(3.0,), (None,), (None,), (1.0,)], "v double")
    assert [r.v for r in top_ranks(df, "v", 2).collect()] == [3.0, 1.0] or top_ranks(df, "v", 2).count() == 2
    assert top_ranks(df, "v", 3).count() == 4


def test_top_per_group(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", 2), ("b", 5)], "k string, v int")
    got = top_per_group(df, ["k"], [F.col("v").desc()])
    assert {(r.k, r.v) for r in got.collect()} == {("a", 3), ("b", 5)}
    assert "WindowGroupLimit" in got._jdf.queryExecution().toString()


def test_pair_share(spark):
    year = dt.datetime(2024, 3, 1)
    rows = [trip(pickup=year, pu=i, do=i, amount=10.0 * (i + 1)) for i in range(12)]
    rows += [trip(pickup=dt.datetime(2023, 12, 31, 23, 59, 59), pu=1, do=1, amount=1e6)]
    rows += [trip(pickup=year, pu=95, amount=1e6)]
    got = reports.pair_revenue_share(enriched(spark, rows), 2024).collect()
    assert len(got) == 10 and got[0].pu_borough == "B11"
    assert got[0].revenue_share_pct == round(100 * 120 / 780, 2)


def test_tip_shares_and_bins_agree(spark):
    rows = [
        trip(tip=0.0),
        trip(tip=20.0, seconds=100),
        trip(tip=15.0, seconds=4000),
        trip(tip=1.0),
        trip(tip=50.0, amount=0.0),
    ]
    df = enriched(spark, rows)
    shares = reports.tip_shares(df).first()
    assert (shares.pct_trips_with_tips, shares.pct_tips_ge_15) == (75.0, 66.67)
    bins = reports.duration_bins(df).collect()
    assert [b.duration_bin for b in bins] == [DURATION_BINS.labels[i] for i in (0, 2, 5)]
    assert {(b.pct_trips_with_tips, b.pct_tips_ge_15) for b in bins} == {(75.0, 66.67)}


def test_no_tips_at_all_gives_null_share(spark):
    shares = reports.tip_shares(enriched(spark, [trip(tip=0.0)])).first()
    assert (shares.pct_trips_with_tips, shares.pct_tips_ge_15) == (0.0, None)


def test_duration_bin_revenue_keeps_zero_amounts(spark):
    df = enriched(spark, [trip(amount=0.0), trip(amount=10.0), trip(seconds=100, amount=4.0)])
    got = reports.duration_bin_revenue(df).collect()
    assert [r.avg_revenue_per_trip for r in got] == [5.0, 4.0]
    assert got[0].avg_km_per_dollar == round(2 * 1.60934 / 10, 4)


def test_color_stats_medians(spark):
    rows = [trip(seconds=60 * m, miles=float(m)) for m in (1, 2, 3, 4, 5, 6)]
    rows += [trip(seconds=600, color="green"), trip(miles=None)]
    df = enriched(spark, rows)
    approx, exact = (reports.color_stats(df, median=m).collect() for m in ("approx", "exact"))
    assert approx == exact
    yellow = approx[1]
    assert (yellow.median_duration_min, yellow.min_duration_min, yellow.max_duration_min) == (3.0, 1.0, 6.0)


def test_cell_stats(spark):
    df = enriched(spark, [trip(amount=10.0), trip(amount=10.01), trip(pu=95), trip(do=99)])
    (cell,) = reports.cell_stats(df, money="exact_cents").collect()
    assert (cell.total_trips, cell.total_amount_paid, cell.avg_amount_per_trip) == (2, 20.01, 10.01)
    assert (cell.month_ym, cell.dow_name, cell.hour_of_day) == ("2020-05", "Monday", 12)


def test_exact_cents_rounds_half_up(spark):
    df = spark.createDataFrame([(0.01,), (0.02,), (None,)], "a double")
    assert df.select(average_money("a", "exact_cents")).first()[0] == 0.02
    down = spark.createDataFrame([(-0.01,), (-0.02,)], "a double")
    assert down.select(average_money("a", "exact_cents")).first()[0] == -0.01
    assert df.filter("a > 1").select(average_money("a", "exact_cents")).first()[0] is None
    with pytest.raises(ValueError):
        average_money("a", "other")


def test_clean_target(spark):
    text = spark.createDataFrame([("12.5",), ("abc",), (None,), ("-3",)], "a string").coalesce(1)
    assert [r[0] for r in text.select(clean_target("a")).collect()] == [12.5, 0.001, 0.001, 0.001]
    number = spark.createDataFrame([(float("nan"),), (0.0005,), (7.0,)], "a double").coalesce(1)
    assert [r[0] for r in number.select(clean_target("a")).collect()] == [0.001, 0.001, 7.0]


def test_calendar_features_and_month_lists(spark):
    rows = [trip(pickup=dt.datetime(2024, m, d)) for m, d in ((9, 30), (10, 1), (12, 31))]
    rows += [trip(pickup=dt.datetime(2025, 1, 1)), trip(pickup=None)]
    df = calendar_features(trips(spark, rows))
    kept = df.filter(in_months(["2024-12", "2024-10", "2024-11"])).orderBy("pickup_ts").collect()
    assert [(r.month, r.day_of_week) for r in kept] == [("2024-10", "Tuesday"), ("2024-12", "Tuesday")]
