from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from faremill import sources
from faremill.operators.enrich import (
    enrich,
    match_report,
    unique_by_key,
    unmatched_keys,
    union_feeds,
)
from faremill.functions.trip import derive_measures
from faremill.plans.cleaning import build_trips
from faremill.schema import GREEN_FEED, YELLOW_FEED, SchemaMismatch, conform
from helpers import NOON, trip, trips

ZONES_CSV = """LocationID,Borough,Zone,service_zone
1, North ,Alpha,Standard
2,South, Beta ,Standard
x,Nowhere,Gamma,Standard
"""


def feed(spark, spec, rows, **extras):
    renamed = trips(spark, rows).drop("color").withColumnsRenamed(
        {"pickup_ts": spec.pickup_column, "dropoff_ts": spec.dropoff_column}
    )
    return renamed.withColumns({name: F.lit(value) for name, value in extras.items()})


@pytest.fixture(scope="module")
def zones_path(tmp_path_factory):
    path = tmp_path_factory.mktemp("zones") / "zones.csv"
    path.write_text(ZONES_CSV)
    return str(path)


def test_read_zones_trims_and_casts(spark, zones_path):
    rows = sources.read_zones(spark, zones_path).collect()
    assert [r.LocationID for r in rows] == [1, 2, None]
    assert (rows[0].Borough, rows[1].Zone) == ("North", "Beta")


def test_conform_renames_fills_and_matches_case_insensitively(spark):
    yellow = conform(feed(spark, YELLOW_FEED, [trip()], Airport_fee=2), YELLOW_FEED)
    green = conform(feed(spark, GREEN_FEED, [trip(), trip()], ehail_fee=1.5, trip_type=1.0), GREEN_FEED)
    both = union_feeds(yellow, green)
    assert [c for c in both.columns if c.lower() == "airport_fee"] == ["airport_fee"]
    assert dict(both.dtypes)["airport_fee"] == "double"
    assert not {"tpep_pickup_datetime", "lpep_pickup_datetime"} & set(both.columns)
    assert both.count() == 3
    got = {r.color: r for r in both.collect()}
    assert (got["yellow"].airport_fee, got["yellow"].ehail_fee, got["yellow"].trip_type) == (2.0, 0.0, 0.0)
    assert (got["green"].airport_fee, got["green"].ehail_fee) == (0.0, 1.5)
    assert got["green"].pickup_ts == NOON


def test_union_fills_other_missing_columns_with_null(spark):
    yellow = conform(feed(spark, YELLOW_FEED, [trip()], surcharge=1.0), YELLOW_FEED)
    green = conform(feed(spark, GREEN_FEED, [trip()]), GREEN_FEED)
    got = {r.color: r.surcharge for r in union_feeds(yellow, green).collect()}
    assert got == {"yellow": 1.0, "green": None}


def test_missing_required_column_fails(spark):
    broken = feed(spark, YELLOW_FEED, [trip()]).drop("trip_distance")
    with pytest.raises(SchemaMismatch, match="trip_distance"):
        conform(broken, YELLOW_FEED)


def test_enrich_keeps_rows_and_reports_unmatched(spark, zones_path):
    zones = sources.read_zones(spark, zones_path)
    rows = [trip(pu=1, do=2), trip(pu=9, do=1), trip(pu=None, do=8), trip(pu=9, do=8)]
    enriched = enrich(trips(spark, rows), zones)
    assert enriched.count() == len(rows)
    assert "LocationID" not in enriched.columns and "_pu_key" not in enriched.columns
    matched = enriched.filter("pu_borough = 'North'").first()
    assert (matched.do_zone, matched.do_service_zone) == ("Beta", "Standard")
    report = match_report(enriched).first()
    assert (report.missing_pu, report.missing_do, report.total_rows) == (3, 2, 4)
    unmatched = {(r.role, r.location_id): r.trips for r in unmatched_keys(enriched).collect()}
    assert unmatched == {("pu", 9): 2, ("pu", None): 1, ("do", 8): 2}


def test_duplicate_dimension_key_fails(spark):
    zones = spark.createDataFrame(
        [(1, "a", "x", "s"), (1, "b", "y", "s")],
        "LocationID int, Borough string, Zone string, service_zone string",
    )
    with pytest.raises(Exception, match="duplicate key"):
        unique_by_key(zones, "LocationID").collect()
    with pytest.raises(Exception, match="duplicate key"):
        enrich(trips(spark, [trip()]), zones).count()


def test_broadcast_is_by_measured_size(spark, zones_path):
    joined = enrich(trips(spark, [trip()]), sources.read_zones(spark, zones_path))
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        again = enrich(trips(spark, [trip()]), sources.read_zones(spark, zones_path))
        assert "BroadcastHashJoin" not in again._jdf.queryExecution().toString()
        assert again.count() == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_full_run_is_stored_by_month_and_read_back(spark, zones_path, tmp_path):
    folder = str(tmp_path / "yellow")
    feed(spark, YELLOW_FEED, [trip(), trip(amount=1.0)]).write.parquet(folder)
    yellow = sources.read_trips(spark, folder)
    green = feed(spark, GREEN_FEED, [trip(), trip(seconds=30, miles=0.5)])
    run = build_trips([(YELLOW_FEED, yellow), (GREEN_FEED, green)], sources.read_zones(spark, zones_path))
    stored = run.save("trips_final")
    assert stored.count() == 2 == run.enriched.count()
    assert {r.pickup_month for r in stored.collect()} == {"2020-05"}
    assert {r.rule for r in run.attrition().filter("dropped > 0").collect()} == {"rule_5", "rule_7", "overall"}
    names = [r.name for r in sources.list_tables(spark).collect()]
    assert "trips_final" in names
    assert sources.list_files(yellow).count() >= 1
    assert sources.table(spark, "trips_final").count() == 2


def test_save_table_replaces_the_schema(spark):
    sources.save_table(spark.range(3), "replaced")
    again = sources.save_table(spark.range(2).selectExpr("id AS other", "'x' AS extra"), "replaced")
    assert again.columns == ["other", "extra"] and again.count() == 2


def test_view_and_schema_tools(spark):
    df = derive_measures(trips(spark, [trip()]))
    view = sources.temp_view(df, "trips_tmp")
    assert view.count() == 1 and spark.sql("SELECT * FROM trips_tmp").count() == 1
    report = {r.name: r.type for r in sources.schema_report(df).collect()}
    assert report["duration_sec"] == "bigint" and len(report) == len(sources.column_names(df))
    assert "color" not in sources.numeric_columns(df)
    assert sources.numeric_columns(df, exclude=("total_amount",)).count("total_amount") == 0
    assert sources.preview(df, 5, "pickup_ts").count() == 1


def test_date_filter_reaches_the_scan(spark, tmp_path):
    from faremill.functions.calendar import in_months, in_year

    folder = str(tmp_path / "raw")
    trips(spark, [trip()]).write.parquet(folder)
    for condition in (in_year(2020), in_months(["2020-04", "2020-05"])):
        plan = spark.read.parquet(folder).filter(condition)._jdf.queryExecution().toString()
        assert "GreaterThanOrEqual(pickup_ts" in plan and "LessThan(pickup_ts" in plan


def test_date_filter_prunes_the_stored_tables_months(spark):
    from faremill.functions.calendar import in_months, in_year

    stored = sources.save_trips(trips(spark, [trip()]), "trips_by_month")
    for condition in (in_year(2020, trips=stored), in_months(["2020-04", "2020-05"], trips=stored)):
        plan = stored.filter(condition)._jdf.queryExecution().executedPlan().toString()
        assert "pickup_month" in plan.split("PartitionFilters: [")[1].split("]")[0]
