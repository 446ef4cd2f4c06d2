"""Registered queries against their DuckDB SQL on the smallest provided tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from faremill.sources.catalog import numeric_columns
from harness import compare

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="provided tables not present")


@pytest.fixture(scope="module")
def connection():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_oracle(spark, connection, name):
    actual = contract.queries()[name](spark, SF_DIR)
    assert compare.difference(actual, connection, contract.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(contract.oracle_sql())))
def test_query_without_oracle_runs(spark, name):
    assert contract.queries()[name](spark, SF_DIR).count() > 0


def test_entry_is_lazy_and_has_66_months(spark):
    assert contract.entry(spark).count() == 66


# Rows left after each rule (green, yellow) on the smallest tables.
KEPT = {"rule_1": (1802, 3709), "rule_2": (1468, 3016), "rule_5": (1148, 2364), "rule_7": (1036, 2149)}


def test_attrition_golden_numbers(spark):
    if not SF_DIR.endswith("sf0.001"):
        pytest.skip("golden numbers are for sf0.001")
    rows = contract.queries()["attrition"](spark, SF_DIR).collect()
    got = {(r.color, r.rule): r.rows_after for r in rows}
    for rule, (green, yellow) in KEPT.items():
        assert (got["green", rule], got["yellow", rule]) == (green, yellow)


def test_profiles_cover_all_numeric_columns_of_the_feeds(spark):
    numeric = set(numeric_columns(contract.queries()["enriched_trips"](spark, SF_DIR)))
    assert len(numeric) == 13 and {"ehail_fee", "trip_type", "airport_fee"} < numeric
    for name, left_out in (("summary", set()), ("summary_approx", set()), ("target_correlation", {"total_amount"})):
        got = {r["column"] for r in contract.queries()[name](spark, SF_DIR).collect()}
        assert got == numeric - left_out
