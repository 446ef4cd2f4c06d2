"""DuckDB SQL of the queries on stored tables and quantile ranks."""

from __future__ import annotations

from harness.oracle import _HOLDOUT, ORACLE as REPORTS, _round, _with

_FEED_COLUMNS = (
    'trip_distance total_amount tip_amount passenger_count payment_type "PULocationID" "DOLocationID" '
    "duration_sec distance_km speed_kmh ehail_fee trip_type airport_fee"
).split()


def _quartiles() -> str:
    lines = [
        f"""SELECT 'one_scan' AS kind, '{c.strip('"')}' AS measure, CAST(q AS DOUBLE) AS quantile, count({c}) AS "rows", true AS bounded
        FROM feeds CROSS JOIN (VALUES (0.25), (0.5), (0.75)) AS t(q) GROUP BY q"""
        for c in _FEED_COLUMNS
    ]
    return f"WITH feeds AS ({REPORTS['enriched_trips']}) {' UNION ALL '.join(lines)}"


def _medians() -> str:
    lines = [
        f"""SELECT kind, color, '{m}' AS measure, 0.5e0 AS quantile, count(*) AS "rows", true AS bounded
        FROM trips CROSS JOIN (VALUES ('one_scan'), ('sketch')) AS t(kind)
        WHERE duration_sec IS NOT NULL AND distance_km IS NOT NULL AND speed_kmh IS NOT NULL GROUP BY kind, color"""
        for m in ("duration_min", "distance_km", "speed_kmh")
    ]
    return _with("SELECT * FROM (" + " UNION ALL ".join(lines) + ")")


ORACLE: dict[str, str] = {
    "stored_cells": REPORTS["cell_stats"],
    "stored_pair_share": REPORTS["pair_revenue_share"],
    "stored_baseline": REPORTS["baseline_metrics"],
    "bucketed_baseline": _with(
        f"""{_HOLDOUT}
        SELECT color, pu_borough, do_borough, month_ym, dow_name, hour_of_day, count(*) AS trips,
          max(avg_amount_per_trip) AS average, {_round("sum(pow(y_true - avg_amount_per_trip, 2))", 6)} AS squared_error
        FROM joined GROUP BY ALL""",
        cells=True,
    ),
    "zones_from_csv": """
SELECT n_nationkey AS "LocationID", trim(r_name) AS "Borough", trim(n_name) AS "Zone", 'Standard' AS service_zone,
  CAST(NULL AS VARCHAR) AS line FROM nation JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT NULL, NULL, NULL, NULL, r_regionkey || ',' || r_name FROM region
UNION ALL SELECT NULL, NULL, NULL, NULL, 'x' || r_name || ',a,b,c' FROM region""",
    "median_ranks": _medians(),
    "quartile_ranks": _quartiles(),
}
