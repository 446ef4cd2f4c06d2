from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from faremill.operators import profile
from faremill.operators.quantiles import exact_quantiles

RELAXED = settings(
    max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def frame(spark, values, schema="v double"):
    return spark.createDataFrame([(v,) for v in values], schema)


@RELAXED
@given(
    st.lists(
        st.one_of(st.none(), st.integers(-50, 50).map(float), st.floats(-1e3, 1e3, allow_nan=False)),
        min_size=1,
        max_size=60,
    )
)
def test_exact_quantiles_match_sorting(spark, values):
    known = sorted(v for v in values if v is not None)
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    df = frame(spark, values)
    linear = {r.probability: r.quantile for r in exact_quantiles(df, ["v"], probs, interpolation="linear").collect()}
    lower = {r.probability: r.quantile for r in exact_quantiles(df, ["v"], probs).collect()}
    if not known:
        assert set(linear.values()) == set(lower.values()) == {None}
        return
    for p in probs:
        assert linear[p] == pytest.approx(float(np.quantile(known, p)), abs=1e-9)
        assert lower[p] == known[max(math.ceil(p * len(known)), 1) - 1]


@pytest.mark.parametrize("accuracy", [20, 100, 10_000])
def test_exact_quantiles_with_coarse_sketch_and_hot_value(spark, accuracy):
    # a third of all rows share one value; groups differ in scale
    df = spark.range(30_000).select(
        F.when(F.col("id") % 5 == 0, "b").otherwise("a").alias("g"),
        F.when(F.col("id") % 3 == 0, 0.5).otherwise((F.col("id") * 7919 % 30011) / 30011.0).alias("v"),
    ).withColumn("w", F.col("v") * F.when(F.col("g") == "b", 1e6).otherwise(1e-6))
    got = exact_quantiles(df, ["v", "w"], [0.1, 0.5, 0.9], by=["g"], accuracy=accuracy)
    pdf = df.toPandas()
    for r in got.collect():
        values = np.sort(pdf[pdf.g == r.g][r.column].to_numpy())
        assert r.quantile == values[math.ceil(r.probability * len(values)) - 1]
    assert got.count() == 12


def test_exact_quantiles_keep_a_null_group_and_facts(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", None), (None, 9.0)], "g string, v double")
    got = {r.g: r for r in exact_quantiles(df, ["v"], [0.5], by=["g"], facts={"top": F.max}).collect()}
    assert (got[None].quantile, got[None].top) == (3.0, 9.0)
    assert (got["a"].quantile, got["a"].top) == (None, None)


def test_summary_against_pandas(spark):
    values = [3.0, None, 1.0, 4.0, 1.0, 5.0]
    df = frame(spark, values).withColumn("t", F.lit("x"))
    want = pd.Series(values, dtype=float).describe()
    row = profile.summary(df, quartiles="exact").first()
    assert row["count"] == 5 and row.column == "v"
    for name, key in [("mean", "mean"), ("stddev", "std"), ("min", "min"), ("max", "max"),
                      ("p25", "25%"), ("p50", "50%"), ("p75", "75%")]:
        assert row[name] == pytest.approx(want[key])
    assert profile.summary(df, quartiles="approx").first().p50 == 3.0
    text = profile.text_summary(df).first()
    assert (text["count"], text["min"], text["max"]) == (6, "x", "x")


def test_correlation_null_handling(spark):
    rows = [(1.0, 2.0), (2.0, 4.0), (None, 6.0), (3.0, 6.0)]
    df = spark.createDataFrame(rows, "a double, total_amount double")
    zero = profile.target_correlation(df).first()
    assert zero.correlation == pytest.approx(df.stat.corr("a", "total_amount"))
    pairwise = profile.target_correlation(df, nulls="pairwise").first()
    assert pairwise.correlation == pytest.approx(1.0)


def test_target_correlation_order_and_exclusions(spark):
    df = spark.range(50).select(
        F.col("id").cast("double").alias("total_amount"),
        (-F.col("id")).alias("strong"),
        (F.col("id") * 37 % 11).alias("weak"),
        F.col("id").alias("fare_amount"),
        F.lit("x").alias("label"),
    )
    got = profile.target_correlation(df).collect()
    assert [r.column for r in got] == ["strong", "weak"] and got[0].correlation == pytest.approx(-1)


def test_correlation_matrix_against_pandas(spark):
    pdf = pd.DataFrame({"a": [1.0, 2, 3, None, 5], "b": [2.0, 1, None, 4, 5], "c": [5.0, 3, 2, 2, 1]})
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "a double, b double, c double")
    want = pdf.corr()
    got = profile.correlation_matrix(df, ["a", "b", "c"]).collect()
    assert len(got) == 9
    for r in got:
        assert r.correlation == pytest.approx(want.loc[r.column_a, r.column_b])


def test_histogram_edges(spark):
    df = frame(spark, [0.0, 1.999, 2.0, 199.9, 200.0, 200.1, -0.1, None])
    got = {r.bin: r.frequency for r in profile.histogram(df, "v").collect()}
    assert len(got) == 100 and sum(got.values()) == 5
    assert (got[0], got[1], got[99], got[50]) == (2, 1, 2, 0)


def test_category_shares(spark):
    rows = [("a", 1)] * 3 + [("b", 2)] + [(None, 3)] * 2
    df = spark.createDataFrame(rows, "color string, payment_type int")
    got = {(r.column, r.value): r.share for r in profile.category_shares(df, ["color", "payment_type"], top=2).collect()}
    assert got == {("color", "a"): 0.75, ("color", "b"): 0.25, ("payment_type", "1"): 0.5, ("payment_type", "3"): 0.333}


def test_quantiles_of_many_groups(spark):
    df = spark.range(30_000).select((F.col("id") % 10_000).alias("k"), F.col("id").cast("double").alias("v"))
    got = exact_quantiles(df, ["v"], [0.5], by=["k"])
    assert got.count() == 10_000
    assert got.filter(F.col("quantile") != F.col("k") + 10_000).count() == 0
