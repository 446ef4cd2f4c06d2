"""Queries on tables in which one key holds a third of all rows and NULLs occur everywhere."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as contract
from harness import compare

SOURCE = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SOURCE), reason="provided tables not present")

LINES = """
SELECT
  CASE WHEN rn % 3 = 0 THEN 77 WHEN rn % 101 = 5 THEN NULL ELSE l_orderkey END AS l_orderkey,
  CASE WHEN rn % 103 = 7 THEN NULL WHEN rn % 6 = 0 THEN 500 ELSE l_partkey END AS l_partkey,
  CASE WHEN rn % 107 = 9 THEN NULL WHEN rn % 3 = 0 THEN 42 ELSE l_suppkey END AS l_suppkey,
  CAST(CASE WHEN rn % 109 = 1 THEN NULL WHEN rn % 6 = 0 THEN 3 ELSE l_linenumber END AS INTEGER) AS l_linenumber,
  CASE WHEN rn % 53 = 1 THEN NULL WHEN rn % 12 = 0 THEN 20.0 ELSE l_quantity END AS l_quantity,
  CASE WHEN rn % 31 = 4 THEN NULL WHEN rn % 12 = 0 THEN 50000.0 ELSE l_extendedprice END AS l_extendedprice,
  CASE WHEN rn % 12 = 0 THEN 0.05 ELSE l_discount END AS l_discount,
  CASE WHEN rn % 37 = 2 THEN NULL ELSE l_tax END AS l_tax,
  CASE WHEN rn % 41 = 3 THEN NULL ELSE l_returnflag END AS l_returnflag,
  l_linestatus, l_shipdate
FROM (SELECT *, row_number() OVER () AS rn FROM '{source}/lineitem.parquet')
"""
ORDERS = """
SELECT * REPLACE (CASE WHEN o_orderkey % 97 = 3 THEN NULL WHEN o_orderkey = 77 THEN TIMESTAMP '2000-02-03'
  ELSE o_orderdate END AS o_orderdate) FROM '{source}/orders.parquet'
"""
NATION = """
SELECT * REPLACE (CAST(CASE WHEN n_nationkey = 11 THEN NULL ELSE n_regionkey END AS INTEGER) AS n_regionkey)
FROM '{source}/nation.parquet'
"""


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    changed = {"lineitem": LINES, "orders": ORDERS, "nation": NATION}
    for name in compare.TABLES:
        target = folder / f"{name}.parquet"
        if name in changed:
            duckdb.execute(f"COPY ({changed[name].format(source=SOURCE)}) TO '{target}'")
        else:
            os.symlink(f"{SOURCE}/{name}.parquet", target)
    return str(folder)


@pytest.fixture(scope="module")
def connection(skewed):
    return compare.connect(skewed)


@pytest.mark.parametrize(
    "name",
    [
        "attrition",
        "violations",
        "enriched_trips",
        "unmatched_zones",
        "busiest_weekday",
        "color_stats",
        "cell_stats",
        "pair_revenue_share",
        "duration_bins",
        "category_shares",
        "stratified_sample",
        "baseline_predictions",
        "baseline_metrics",
        "baseline_history",
        "mode_imputation",
    ],
)
def test_query_equals_oracle_on_skewed_tables(spark, skewed, connection, name):
    actual = contract.queries()[name](spark, skewed)
    assert compare.difference(actual, connection, contract.oracle_sql()[name]) is None


def test_shuffled_joins_give_the_same_rows(spark, skewed, connection):
    settings = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in settings:
        spark.conf.set(key, "-1")
    try:
        for name in ("zone_match", "cell_stats", "baseline_predictions"):
            actual = contract.queries()[name](spark, skewed)
            assert compare.difference(actual, connection, contract.oracle_sql()[name]) is None
    finally:
        for key in settings:
            spark.conf.unset(key)
