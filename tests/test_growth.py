"""Large inputs: what queries shuffle, broadcast and read again."""

from __future__ import annotations

from pyspark.sql import functions as F

from faremill.functions.calendar import month_key
from faremill.functions.trip import duration_minutes
from faremill.operators import sketches
from faremill.plans import stored
from harness import registry, trip_view

SF = "/root/testdata/sf0.001"


def final_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_orders_are_joined_by_shuffle_at_any_size(spark):
    """Both sides grow alike: a broadcast of all orders would be held by every task."""
    plan = final_plan(trip_view.raw_trips(spark, SF))
    assert "ShuffledHashJoin" in plan and "BroadcastHashJoin" not in plan and "SortMergeJoin" not in plan


def test_line_items_are_joined_once_where_rows_are_read_again(spark):
    for name in ("baseline_predictions", "encoded_rows", "onehot_counts"):
        assert "lineitem" not in final_plan(registry.QUERIES[name](spark, SF)), name


def nodes(plan):
    """The operators that ran, stages included."""
    yield plan
    name = plan.nodeName()
    if name.startswith("AdaptiveSparkPlan"):
        inner = [plan.executedPlan()]
    elif "QueryStage" in name:
        inner = [plan.plan()]
    else:
        inner = [plan.children().apply(i) for i in range(plan.children().size())]
    for child in inner:
        yield from nodes(child)


def test_sketches_of_many_months_collect_no_rows(spark):
    """With 144 feeds and months in one task, grouping by month sorts the task's rows."""
    months = F.make_ym_interval(F.lit(0), F.pmod("id", F.lit(72)).cast("int"))
    rows = spark.range(0, 3000, 1, 1).select(
        F.when(F.col("id") % 5 < 2, "green").otherwise("yellow").alias("color"),
        F.when(F.col("id") % 1000 != 7, F.lit("2019-01-31 23:59:59").cast("timestamp") + months).alias("pickup_ts"),
        (F.pmod(F.xxhash64("id"), F.lit(240)) * 15).alias("duration_sec"),  # sums are exact
        (F.col("id") / 8).alias("distance_km"),
        F.when(F.col("id") % 11 != 0, F.col("id") % 90 + 0.5).alias("speed_kmh"),
    )
    made = stored.feed_sketches(rows)
    columns = ["color", "pickup_month", *[f"{m}_{x}" for m in stored.MEASURES for x in ("n", "sum", "min", "max")]]
    found = made.collect()
    fallen = [n.metrics().apply("numTasksFallBacked").value() for n in nodes(made._jdf.queryExecution().executedPlan()) if n.nodeName() == "ObjectHashAggregate"]
    assert len(fallen) == 2 and sum(fallen) == 0
    known = rows.where("speed_kmh IS NOT NULL")
    values = {"duration_min": duration_minutes(), "distance_km": F.col("distance_km"), "speed_kmh": F.col("speed_kmh")}
    want = sketches.measure_sketches(known, values, ["color", month_key().alias("pickup_month")])
    assert len(found) == want.count() > 128
    as_lines = lambda lines: sorted(str([row[c] for c in columns]) for row in lines)
    assert as_lines(found) == as_lines(want.collect())
    # so few values to a month that sketches hold all of them
    medians = [sketches.merged_stats(s, stored.MEASURES, ["color", "pickup_month"]).collect() for s in (made, want)]
    assert sorted(map(str, medians[0])) == sorted(map(str, medians[1]))
