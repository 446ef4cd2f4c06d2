from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from faremill.functions import unit_hash
from faremill.functions.trip import derive_measures
from faremill.operators import baseline, sampling
from faremill.plans import reports
from helpers import trip, trips


@pytest.fixture(scope="module")
def dated(spark):
    month = F.concat(F.lit("2024-"), F.lpad((F.col("id") % 10 + 1).cast("string"), 2, "0"))
    return spark.range(20_000).select("id", month.alias("month")).cache()


TEST = ["2024-09", "2024-10"]


def test_month_fractions(dated):
    rows = sampling.month_fractions(dated, TEST).collect()
    assert len(rows) == 10 and sum(r.rows for r in rows) == 20_000
    other = (0.04 - 0.2 * 0.03) / 0.8
    for r in rows:
        assert r.fraction == pytest.approx(0.03 if r.is_test else other)


def test_month_fractions_edges(dated):
    months = [f"2024-{m:02d}" for m in range(1, 11)]
    assert {r.fraction for r in sampling.month_fractions(dated, months).collect()} == {0.03}
    clamped = sampling.month_fractions(dated, TEST, test_fraction=0.9, overall_fraction=0.1)
    assert {r.fraction for r in clamped.filter("NOT is_test").collect()} == {0.0}


def test_hash_sample_ignores_partitioning(dated):
    fractions = sampling.month_fractions(dated, TEST, 0.3, 0.4)
    unit = unit_hash("id")
    once = {r.id for r in sampling.stratified_sample(dated, fractions, unit).collect()}
    again = {r.id for r in sampling.stratified_sample(dated.repartition(7), fractions, unit).collect()}
    by_share = sampling.temporal_sample(dated, TEST, unit, 0.3, 0.4)
    assert {r.id for r in by_share.collect()} == once and by_share.columns == dated.columns
    assert once == again and len(once) == pytest.approx(8000, rel=0.05)


def test_unit_hash_is_uniform_and_seeded(dated):
    values = np.array([r[0] for r in dated.select(unit_hash("id")).collect()])
    assert values.min() >= 0 and values.max() < 1
    assert np.histogram(values, bins=10, range=(0, 1))[0] == pytest.approx(2000, rel=0.1)
    assert dated.filter(unit_hash("id") == unit_hash("id", seed=1)).count() == 0


def test_native_samplers(dated):
    fractions = sampling.month_fractions(dated, TEST, 0.3, 0.4)
    assert sampling.stratified_sample_native(dated, fractions).count() == pytest.approx(8000, rel=0.1)
    assert sampling.fraction(dated, 1.0) is dated
    assert sampling.fraction(dated, 0.05).count() == pytest.approx(1000, rel=0.2)
    assert sampling.fraction(dated, 0.05, keys=["id"]).count() == pytest.approx(1000, rel=0.2)
    train, val, test = sampling.temporal_split_native(dated, TEST)
    assert train.count() + val.count() == 16_000 and test.count() == 4000
    assert train.count() == pytest.approx(12_800, rel=0.05)


def test_temporal_split(dated):
    split = sampling.temporal_split(dated, TEST, unit_hash("id"))
    sizes = {r.split: r["count"] for r in split.groupBy("split").count().collect()}
    assert sizes["test"] == 4000 and sizes["train"] + sizes["val"] == 16_000
    assert sizes["train"] == pytest.approx(12_800, rel=0.05)
    assert split.filter((F.col("split") == "test") != F.col("month").isin(TEST)).count() == 0


def test_first_rows(dated):
    assert [r.id for r in sampling.first_rows(dated, 3, F.col("id").desc()).collect()] == [19999, 19998, 19997]


# --- baseline ---


@pytest.fixture(scope="module")
def history(spark):
    rows = []
    for i in range(400):
        pickup = dt.datetime(2024, 8 + i % 3, 1 + i % 28, i % 24)
        rows.append(trip(pickup=pickup, pu=i % 4, do=i % 3, amount=5.0 + i % 17, color="green" if i % 5 else "yellow"))
    rows.append(trip(pickup=dt.datetime(2024, 10, 3, 4), pu=99, amount=40.0, color="yellow"))
    rows.append(trip(pickup=dt.datetime(2024, 10, 3, 4), amount=None, color="green"))
    rows.append(trip(pickup=dt.datetime(2024, 10, 3, 4), pu=99, color="blue"))
    df = derive_measures(trips(spark, rows))
    borough = lambda c: F.when(F.col(c) < 90, F.concat(F.lit("B"), F.col(c)))
    return df.withColumns({"pu_borough": borough("PULocationID"), "do_borough": borough("DOLocationID")}).cache()


@pytest.mark.parametrize("history_before", [None, "2024-10"])
def test_cell_level_metrics_equal_row_level(history, history_before):
    cells = reports.cell_stats(history)
    rows = baseline.baseline_predictions(history, cells, ["2024-10"], history_before)
    window = Window.partitionBy("color")
    by_window = rows.withColumn(
        "want", F.coalesce("avg_amount_per_trip", F.avg("avg_amount_per_trip").over(window))
    )
    assert by_window.filter(~F.col("want").eqNullSafe(F.col("y_hat")) & (F.abs(F.col("want") - F.col("y_hat")) > 1e-9)).count() == 0
    want = rows.agg(
        F.count(F.lit(1)), F.count("avg_amount_per_trip"),
        F.sqrt(F.avg(F.pow(F.col("y_true") - F.col("y_hat"), F.lit(2)))),
    ).first()
    got = baseline.baseline_metrics(history, cells, ["2024-10"], history_before).first()
    assert (got.test_rows, got.matched_rows) == (want[0], want[1])
    assert got.coverage == pytest.approx(want[1] / want[0])
    assert got.rmse == pytest.approx(want[2])


def test_unmatched_trip_gets_color_mean_or_null(history):
    cells = reports.cell_stats(history)
    rows = baseline.baseline_predictions(history, cells, ["2024-10"]).filter("pu_borough IS NULL").collect()
    by_color = {r.color: r.y_hat for r in rows}
    assert by_color["blue"] is None and by_color["yellow"] is not None


def test_no_test_rows(history):
    got = baseline.baseline_metrics(history, reports.cell_stats(history), ["2031-01"]).first()
    assert (got.test_rows, got.matched_rows, got.coverage, got.rmse) == (0, 0, None, None)
