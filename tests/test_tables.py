"""Stored, refreshed and replaced tables; sketches; category tables; rejected lines."""

from __future__ import annotations

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from faremill import sources
from faremill.operators import category_index as ci
from faremill.operators import sketches
from faremill.plans import stored
from helpers import trip, trips


@pytest.fixture
def rows(spark):
    """Trips of three months and two feeds, with zones."""
    made = trips(spark, [trip() for _ in range(12)]).limit(12)
    numbered = made.withColumn("n", F.monotonically_increasing_id())
    moved = numbered.withColumn("pickup_ts", F.expr("timestamp'2024-01-05 10:00:00' + make_ym_interval(0, cast(n % 3 as int))"))
    dressed = moved.withColumns(
        {
            "color": F.when(F.col("n") % 2 == 0, "green").otherwise("yellow"),
            "pu_borough": F.lit("A"),
            "do_borough": F.lit("B"),
            "duration_sec": F.lit(600) + F.col("n"),
            "distance_km": F.lit(2.0) + F.col("n"),
            "speed_kmh": F.lit(12.0),
            "total_amount": F.lit(10.0) + F.col("n"),
        }
    )
    return dressed.drop("n")


def _files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_refresh_rebuilds_the_named_months_only(spark, rows, tmp_path):
    tables = stored.StoredReports(spark, "refreshed", str(tmp_path))
    tables.save(rows.filter("NOT (color = 'green' AND month(pickup_ts) = 2)"))
    path = sources.version_path(spark, "refreshed_trips").removeprefix("file:")
    before = _files(path)
    tables.refresh(rows, ["2024-02"])
    after = _files(path)
    untouched = {f: t for f, t in before.items() if "2024-02" not in f}
    assert untouched and all(after[f] == t for f, t in untouched.items())
    assert not {f for f in before if "2024-02" in f} & set(after)
    assert tables.trips().count() == rows.count()
    assert {r.month_ym: r.total_trips for r in tables.cells().groupBy("month_ym").agg(F.sum("total_trips").alias("total_trips")).collect()} == {
        f"2024-0{m}": rows.filter(f"month(pickup_ts) = {m}").count() for m in (1, 2, 3)
    }
    tables.refresh(rows.filter("month(pickup_ts) <> 3"), ["2024-03"])  # nothing left of a month
    assert tables.trips().filter("month(pickup_ts) = 3").count() == 0 and tables.cells().filter("month_ym = '2024-03'").count() == 0


def test_a_table_is_replaced_by_a_query_on_itself_with_one_column_more(spark, rows, tmp_path):
    first = sources.publish(rows.select("color", "total_amount"), "replaced", str(tmp_path))
    held = first.count()
    second = sources.publish(spark.table("replaced").withColumn("double", F.col("total_amount") * 2), "replaced", str(tmp_path))
    assert second.columns == ["color", "total_amount", "double"] and second.count() == held
    assert first.count() == held  # a reader of the old version still finds its files


def test_a_table_that_has_the_name_is_kept_under_another(spark, rows, tmp_path):
    rows.select("color").write.saveAsTable("named_before")
    made = sources.publish(spark.table("named_before").withColumn("one", F.lit(1)), "named_before", str(tmp_path))
    assert made.columns == ["color", "one"] and made.count() == rows.count()
    kept = [t.name for t in spark.catalog.listTables() if t.name.startswith("named_before_before_")]
    assert len(kept) == 1 and spark.table(kept[0]).count() == rows.count()


def test_bucketed_join_shuffles_neither_side(spark, rows, tmp_path):
    cells = stored.reports.cell_stats(rows)
    made = stored.bucketed_baseline(rows, cells, ["2024-01", "2024-02"], "bucketed", str(tmp_path), 4)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert made.agg(F.sum("trips")).first()[0] == rows.filter("month(pickup_ts) < 3").count()


def test_sketches_of_months_merge_to_those_of_the_whole(spark):
    draw = np.random.default_rng(3)
    values = draw.lognormal(2, 1, 20_000)
    frame = spark.createDataFrame([(float(v), i % 5) for i, v in enumerate(values)], "v double, month int")
    parts = sketches.measure_sketches(frame, {"v": F.col("v")}, ["month"]).withColumn("all", F.lit(1))
    got = sketches.merged_stats(parts, ["v"], ["all"]).first()
    rank = (values < got.median_v).mean()
    assert abs(rank - 0.5) <= sketches.RANK_ERROR
    assert (got.min_v, got.max_v) == (values.min(), values.max()) and got.avg_v == pytest.approx(values.mean())
    claims = spark.createDataFrame([([(0.5, float(np.quantile(values, 0.6)))],)], "v array<struct<quantile:double,value:double>>")
    off = sketches.rank_errors(frame, claims, ["v"]).first()
    assert off["rows"] == 20_000 and off["rank_error"] == pytest.approx(0.1, abs=1e-3)


def test_sketches_of_nothing(spark):
    frame = spark.createDataFrame([("a", None), ("b", 2.0)], "g string, v double")
    merged = sketches.merged_stats(sketches.measure_sketches(frame, {"v": F.col("v")}, ["g"]), ["v"], ["g"])
    got = {r.g: r for r in merged.collect()}
    assert got["a"].median_v is None and got["b"].median_v == 2.0


def test_category_tables_number_any_vocabulary(spark):
    values = [f"v{i:04d}" for i in range(3000)]
    train = spark.createDataFrame([(v, "x") for v in values for _ in range(2)] + [(None, "x")], "a string, b string")
    table = ci.category_index(train, ["a", "b"])
    got = {(r["column"], r.value): (r["index"], r.rows) for r in table.collect()}
    assert got == {**{("a", v): (i, 2) for i, v in enumerate(values)}, ("b", "x"): (0, 6001)}
    new = spark.createDataFrame([("v0001", "x"), ("zzz", "y"), (None, None)], "a string, b string")
    indexed = [(r.a_index, r.b_index) for r in ci.with_indices(new, table, ["a", "b"]).orderBy("a").collect()]
    assert sorted(indexed, key=str) == sorted([(1, 0), (None, None), (None, None)], key=str)


def test_rejected_lines_are_kept(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text("LocationID,Borough,Zone,service_zone\n1, North ,Alpha,Standard\nx,Nowhere,Gamma,Standard\n3,short\n,None,Delta,S\n")
    good, rejected = sources.read_zones_checked(spark, str(path))
    assert [(r.LocationID, r.Borough, r.Zone) for r in good.orderBy("Zone").collect()] == [(1, "North", "Alpha"), (None, "None", "Delta")]
    assert sorted(r.line for r in rejected.collect()) == ["3,short", "x,Nowhere,Gamma,Standard"]


def test_files_are_listed_without_reading_rows(spark, tmp_path):
    spark.range(100).repartition(3).write.parquet(str(tmp_path / "t"))
    listed = sources.list_files(spark.read.parquet(str(tmp_path / "t")))
    assert "FileScan parquet" not in listed._jdf.queryExecution().executedPlan().toString()
    got = {os.path.basename(r.file_path): r.file_size for r in listed.collect()}
    assert got == {f: os.path.getsize(tmp_path / "t" / f) for f in os.listdir(tmp_path / "t") if f.endswith(".parquet")}
