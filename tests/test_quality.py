from __future__ import annotations

import datetime as dt
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from faremill.functions.trip import derive_measures
from faremill.operators import quality
from faremill.operators.quality import Limits
from helpers import NOON, trip, trips

MILES_PER_KM = 1 / 1.60934


def verdicts(spark, rows, limits=Limits()):
    df = derive_measures(trips(spark, rows)).coalesce(1)
    return [r[0] for r in df.select(quality.first_failed_rule(limits)).collect()]


@pytest.mark.parametrize(
    "row, expected",
    [
        (trip(), None),
        (trip(pickup=None), "rule_1"),
        (trip(seconds=None), "rule_1"),
        (trip(seconds=-1), "rule_1"),
        (trip(seconds=0), "rule_5"),
        (trip(miles=-1.0), "rule_3"),
        (trip(miles=math.nan), "rule_4"),
        (trip(miles=None), "rule_6"),
        (trip(pickup=dt.datetime(2013, 12, 31, 23, 59, 59)), "rule_2"),
        (trip(pickup=dt.datetime(2014, 1, 1)), None),
        (trip(pickup=dt.datetime(2024, 12, 31)), None),
        (trip(pickup=dt.datetime(2024, 12, 31, 0, 0, 1)), "rule_2"),
        (trip(miles=200.0), "rule_4"),
        (trip(seconds=59, miles=0.5), "rule_5"),
        (trip(seconds=60, miles=0.5), None),
        (trip(seconds=21600), None),
        (trip(seconds=21601), "rule_5"),
        (trip(miles=0.19 * MILES_PER_KM), "rule_6"),
        (trip(seconds=21600, miles=201 * MILES_PER_KM), "rule_6"),
        (trip(amount=3.3), None),
        (trip(amount=3.29), "rule_7"),
        (trip(amount=3.29, payment=4), None),
        (trip(amount=None, payment=3), None),
        (trip(amount=None, payment=1), "rule_7"),
        (trip(amount=1.0, payment=None), "rule_7"),
    ],
)
def test_first_failed_rule(spark, row, expected):
    assert verdicts(spark, [row]) == [expected]


def test_speed_exactly_at_limit_is_kept(spark):
    df = spark.createDataFrame([(150.0,), (150.0001,), (None,), (math.nan,)], "speed_kmh double")
    rule = {r.rule_id: r for r in quality.RULES}["rule_4"]
    assert [r[0] for r in df.coalesce(1).select(rule.keep(Limits())).collect()] == [True, False, True, False]


def test_inclusive_end_day(spark):
    late = trip(pickup=dt.datetime(2024, 12, 31, 23, 0))
    assert verdicts(spark, [late], Limits(inclusive_end_day=True)) == [None]
    assert verdicts(spark, [trip(pickup=dt.datetime(2025, 1, 1))], Limits(inclusive_end_day=True)) == ["rule_2"]


ROW = st.builds(
    trip,
    pickup=st.sampled_from([None, NOON, dt.datetime(2010, 1, 1), dt.datetime(2024, 12, 31, 5)]),
    seconds=st.sampled_from([None, -5, 0, 30, 60, 600, 21600, 30000]),
    miles=st.sampled_from([None, math.nan, -1.0, 0.0, 0.05, 2.0, 60.0, 500.0]),
    amount=st.sampled_from([None, -4.0, 0.0, 3.3, 50.0]),
    payment=st.sampled_from([None, 1, 3, 6]),
    color=st.sampled_from(["yellow", "green"]),
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ROW, min_size=1, max_size=25))
def test_attrition_matches_rule_by_rule_counts(spark, rows):
    df = derive_measures(trips(spark, rows)).cache()
    report = {(r.color, r.rule): r for r in quality.attrition(df).collect()}
    for color in {r[-1] for r in rows}:
        left = df.filter(F.col("color") == color)
        raw = before = left.count()
        for rule in quality.RULES:
            left = left.filter(rule.keep(Limits()))
            after = left.count()
            line = report[color, rule.rule_id]
            assert (line.rows_before, line.rows_after, line.dropped) == (before, after, before - after)
            before = after
        overall = report[color, "overall"]
        assert (overall.rows_before, overall.rows_after) == (raw, before)
        assert overall.dropped_pct == pytest.approx(100 * (raw - before) / raw, abs=0.005001)
    kept, dropped = quality.clean(df).count(), quality.violations(df).count()
    assert kept + dropped == len(rows)
    assert dropped == sum(quality.violations(df, r.rule_id).count() for r in quality.RULES)
    df.unpersist()


def test_speed_offenders_are_sorted_and_limited(spark):
    rows = [trip(miles=100.0 + i) for i in range(15)] + [trip(), trip(seconds=-5, miles=900.0)]
    both = derive_measures(trips(spark, rows)).withColumn("color", F.explode(F.array(F.lit("green"), F.lit("yellow"))))
    got = quality.speed_offenders(both, n=10).collect()
    assert [r.color for r in got] == ["green"] * 10 + ["yellow"] * 10
    got = got[:10]
    speeds = [r.speed_kmh for r in got]
    assert len(speeds) == 10 and speeds == sorted(speeds, reverse=True)
    assert speeds[0] == pytest.approx(114 * 1.60934 * 6)


def test_negative_speed_check(spark):
    df = derive_measures(trips(spark, [trip(), trip(miles=-1.0), trip(miles=None), trip()]))
    row = quality.negative_speed_check(df).first()
    assert (row.negative_speeds, row.total_rows, row.negative_pct) == (1, 4, 25.0)
    assert quality.negative_speed_check(quality.clean(df)).first().negative_speeds == 0
