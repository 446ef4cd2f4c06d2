"""DuckDB SQL for the registered queries, written against the given tables."""

from __future__ import annotations

_BASE = """
base AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CASE WHEN l_returnflag = 'R' THEN 'green' ELSE 'yellow' END AS color,
    CAST(o_orderdate AS TIMESTAMP) + to_seconds((l_orderkey * 7919 + l_linenumber * 3607) % 86400) AS pickup_ts,
    CAST(o_orderdate AS TIMESTAMP) + to_seconds((l_orderkey * 7919 + l_linenumber * 3607) % 86400
      + (l_partkey * 37 + l_suppkey * 11) % 25200 - 600) AS dropoff_ts,
    l_quantity * l_discount * 30 AS trip_distance,
    floor((l_extendedprice - 3000) / 10) / 1e2 AS total_amount,
    floor(l_tax * l_extendedprice / 2) / 1e2 AS tip_amount,
    CAST(CASE WHEN l_linenumber <> 7 THEN l_linenumber - 1 END AS DOUBLE) AS passenger_count,
    l_suppkey % 6 + 1 AS payment_type,
    CAST(l_suppkey % 27 AS INTEGER) AS "PULocationID",
    CAST(l_partkey % 26 AS INTEGER) AS "DOLocationID"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
timed AS (SELECT *, epoch_us(dropoff_ts) // 1000000 - epoch_us(pickup_ts) // 1000000 AS duration_sec FROM base),
raw AS (
  SELECT *, trip_distance * 1.60934e0 AS distance_km,
    CASE WHEN duration_sec > 0 THEN trip_distance * 1.60934e0 / (duration_sec / 3.6e3) END AS speed_kmh
  FROM timed
),
flagged AS (
  SELECT *, CASE
    WHEN NOT coalesce(dropoff_ts >= pickup_ts, false) THEN 'rule_1'
    WHEN NOT coalesce(speed_kmh IS NULL OR isnan(speed_kmh) OR speed_kmh >= 0, false) THEN 'rule_3'
    WHEN NOT coalesce(pickup_ts >= TIMESTAMP '1996-01-01' AND pickup_ts <= TIMESTAMP '2001-06-30'
      AND dropoff_ts IS NOT NULL, false) THEN 'rule_2'
    WHEN NOT coalesce(speed_kmh IS NULL OR speed_kmh <= 150, false) THEN 'rule_4'
    WHEN NOT coalesce(duration_sec BETWEEN 60 AND 21600, false) THEN 'rule_5'
    WHEN NOT coalesce(distance_km BETWEEN 0.2e0 AND 200, false) THEN 'rule_6'
    WHEN NOT coalesce(total_amount >= 3.3e0 OR payment_type IN (3, 4, 6), false) THEN 'rule_7'
  END AS failed_rule
  FROM raw
),
cleaned AS (SELECT * EXCLUDE (failed_rule) FROM flagged WHERE failed_rule IS NULL),
zones AS (
  SELECT n_nationkey AS id, trim(r_name) AS borough, trim(n_name) AS zone, 'Standard' AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
trips AS (
  SELECT c.*, p.borough AS pu_borough, p.zone AS pu_zone, p.service_zone AS pu_service_zone,
    d.borough AS do_borough, d.zone AS do_zone, d.service_zone AS do_service_zone,
    date_trunc('month', pickup_ts) AS month_start,
    strftime(pickup_ts, '%Y-%m') AS month_ym,
    strftime(pickup_ts, '%b %Y') AS month_label,
    strftime(pickup_ts, '%A') AS dow_name,
    CAST(hour(pickup_ts) AS INTEGER) AS hour_of_day,
    CAST(CAST(duration_sec / 6e1 AS DECIMAL(27, 6)) AS DOUBLE) AS duration_min
  FROM cleaned c
  LEFT JOIN zones p ON c."PULocationID" = p.id
  LEFT JOIN zones d ON c."DOLocationID" = d.id
)"""

_CELLS = """,
cells AS (
  SELECT color, pu_borough, do_borough, month_ym, dow_name, hour_of_day,
    count(*) AS total_trips,
    round(CAST(avg(distance_km) AS DECIMAL(38, 12)), 2)::DOUBLE AS avg_distance_km,
    {exact_average} AS avg_amount_per_trip,
    round(sum(total_amount), 2) AS total_amount_paid
  FROM trips WHERE pu_borough IS NOT NULL AND do_borough IS NOT NULL
  GROUP BY ALL
)"""

_TEST_MONTHS = "('2001-04', '2001-05', '2001-06')"
_ROW_KEYS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"

def _exact_average() -> str:
    # half up in whole cents; taking the non-negative remainder off makes '//' exact
    num = "(2 * sum(CAST(round(total_amount * 100) AS HUGEINT)) + count(total_amount))"
    den = "(2 * count(total_amount))"
    return f"CAST(({num} - ((({num} % {den}) + {den}) % {den})) // {den} AS DOUBLE) / 1e2"


def _round(expression: str, digits: int) -> str:
    """Half-up rounding on the decimal text of a double, with room against rounding twice."""
    return f"round(CAST({expression} AS DECIMAL(38, {12 if digits <= 4 else 18})), {digits})::DOUBLE"


def _unit(seed: int) -> str:
    text = f"'{seed}|' || l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|' || l_suppkey"
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT) / 4294967296e0"


def _with(body: str, cells: bool = False) -> str:
    extra = _CELLS.replace("{exact_average}", _exact_average()) if cells else ""
    return f"WITH {_BASE.strip()}{extra}\n{body.strip()}"


def _monthly(measure: str, name: str) -> str:
    return _with(
        f"SELECT month_start, month_ym, month_label, {measure} AS {name} FROM trips GROUP BY ALL"
    )


def _top_slot(slot: str, slot_name: str, measure: str) -> str:
    return _with(
        f"""
        SELECT month_label, month_ym, {slot} AS {slot_name}, n AS {measure} FROM (
          SELECT *, row_number() OVER (PARTITION BY month_start ORDER BY n DESC, {slot}) AS rn
          FROM (SELECT month_start, month_ym, month_label, {slot}, count(*) AS n FROM trips GROUP BY ALL)
        ) WHERE rn = 1"""
    )


_ATTRITION_STEPS = ["rule_1", "rule_3", "rule_2", "rule_4", "rule_5", "rule_6", "rule_7"]


def _attrition() -> str:
    failed_at = " ".join(f"WHEN '{r}' THEN {i}" for i, r in enumerate(_ATTRITION_STEPS, 1))
    steps = ", ".join(f"({i}, '{r}')" for i, r in enumerate(_ATTRITION_STEPS, 1))
    return _with(
        f"""
        , numbered AS (SELECT color, CASE failed_rule {failed_at} ELSE 99 END AS failed_at FROM flagged),
        steps(step, rule) AS (VALUES {steps}),
        counted AS (
          SELECT color, step, rule, count(*) FILTER (failed_at >= step) AS rows_before,
            count(*) FILTER (failed_at > step) AS rows_after
          FROM numbered CROSS JOIN steps GROUP BY ALL
          UNION ALL
          SELECT color, 8, 'overall', count(*), count(*) FILTER (failed_at = 99) FROM numbered GROUP BY color
        )
        SELECT color, CAST(step AS INTEGER) AS step, rule, rows_before, rows_after,
          rows_before - rows_after AS dropped,
          {_round("100e0 * (rows_before - rows_after) / nullif(rows_before, 0)", 2)} AS dropped_pct
        FROM counted"""
    )


def _color_stats() -> str:
    parts = []
    for name in ("duration_min", "distance_km", "speed_kmh"):
        parts += [
            f"{_round(f'avg({name})', 2)} AS avg_{name}",
            f"{_round(f'quantile_disc({name}, 0.5)', 2)} AS median_{name}",
            f"{_round(f'min({name})', 2)} AS min_{name}",
            f"{_round(f'max({name})', 2)} AS max_{name}",
        ]
    return _with(f"SELECT color, {', '.join(parts)} FROM trips WHERE speed_kmh IS NOT NULL GROUP BY color")


_BIN = """CASE WHEN duration_min < 5 THEN 'Under 5 Mins' WHEN duration_min < 10 THEN '5–10 Mins'
  WHEN duration_min < 20 THEN '10–20 Mins' WHEN duration_min < 30 THEN '20–30 Mins'
  WHEN duration_min < 60 THEN '30–60 Mins' ELSE 'At least 60 Mins' END"""

_TIPS = f"""
  {_round("100e0 * count(*) FILTER (tip_amount > 0) / count(*)", 2)} AS pct_trips_with_tips,
  {_round("100e0 * count(*) FILTER (tip_amount >= 15) / nullif(count(*) FILTER (tip_amount > 0), 0)", 2)}
    AS pct_tips_ge_15"""
_PAID = "duration_sec IS NOT NULL AND distance_km IS NOT NULL AND speed_kmh IS NOT NULL AND total_amount > 0"

_EDA = ["passenger_count", "distance_km", "duration_sec", "speed_kmh", "total_amount", "tip_amount"]
_CORRELATED = [
    "trip_distance",
    "tip_amount",
    "passenger_count",
    "payment_type",
    "PULocationID",
    "DOLocationID",
    "duration_sec",
    "distance_km",
    "speed_kmh",
    "airport_fee",
    "ehail_fee",
    "trip_type",
]
# all numeric columns of the united feeds
_NUMERIC = ["total_amount", *_CORRELATED]
_FEEDS = """(
  SELECT *,
    CASE color WHEN 'green' THEN l_linenumber / 4e0 ELSE 0e0 END AS ehail_fee,
    CASE color WHEN 'green' THEN l_linenumber % 2 + 1e0 ELSE 0e0 END AS trip_type,
    CASE color WHEN 'yellow' THEN CAST(l_linenumber % 3 AS DOUBLE) ELSE 0e0 END AS airport_fee
  FROM trips)"""
_TEXTS = [
    "color",
    "pu_borough",
    "pu_zone",
    "pu_service_zone",
    "do_borough",
    "do_zone",
    "do_service_zone",
]


def _union(parts: list[str]) -> str:
    return "\nUNION ALL ".join(parts)


def _summary() -> str:
    lines = []
    for name in _NUMERIC:
        v = f'CAST("{name}" AS DOUBLE)'
        stats = {
            "mean": f"avg({v})",
            "stddev": f"stddev_samp({v})",
            "min": f"min({v})",
            "max": f"max({v})",
            "p25": f"quantile_cont({v}, 0.25)",
            "p50": f"quantile_cont({v}, 0.5)",
            "p75": f"quantile_cont({v}, 0.75)",
        }
        columns = ", ".join(f'{_round(e, 6)} AS "{k}"' for k, e in stats.items())
        lines.append(f"SELECT '{name}' AS \"column\", count(\"{name}\") AS \"count\", {columns} FROM {_FEEDS}")
    return _with(_union(lines))


def _text_summary() -> str:
    return _with(
        _union(
            [
                f"SELECT '{c}' AS \"column\", count({c}) AS \"count\", min({c}) AS \"min\", max({c}) AS \"max\" FROM trips"
                for c in _TEXTS
            ]
        )
    )


def _target_correlation() -> str:
    return _with(
        _union(
            [
                f"SELECT '{c}' AS \"column\", {_round(f'corr(coalesce(CAST(\"{c}\" AS DOUBLE), 0), coalesce(total_amount, 0))', 9)}"
                f" AS correlation FROM {_FEEDS}"
                for c in _CORRELATED
            ]
        )
    )


def _correlation_matrix() -> str:
    return _with(
        _union(
            [
                f"SELECT '{a}' AS column_a, '{b}' AS column_b, "
                + ("max(1e0)" if a == b else _round(f"corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))", 9))
                + " AS correlation FROM trips"
                for a in _EDA
                for b in _EDA
            ]
        )
    )


def _category_shares() -> str:
    columns = ["color", "pu_borough", "do_borough", "payment_type", "dow_name"]
    counts = _union(
        [
            f"SELECT '{'day_of_week' if c == 'dow_name' else c}' AS \"column\", CAST({c} AS VARCHAR) AS \"value\","
            f" count(*) AS \"rows\" FROM trips WHERE {c} IS NOT NULL GROUP BY {c}"
            for c in columns
        ]
    )
    return _with(
        f"""
        , counts AS ({counts})
        SELECT "column", "value", "rows", share FROM (
          SELECT *, {_round('"rows" / sum("rows") OVER (PARTITION BY "column")::DOUBLE', 3)} AS share,
            row_number() OVER (PARTITION BY "column" ORDER BY "rows" DESC, "value") AS rn
          FROM counts) WHERE rn <= 10"""
    )


_FRACTIONS = f"""
, months AS (SELECT month_ym AS month, count(*) AS n, month_ym IN {_TEST_MONTHS} AS is_test
  FROM trips WHERE total_amount IS NOT NULL GROUP BY ALL),
share AS (SELECT coalesce(sum(n) FILTER (is_test), 0)::DOUBLE / sum(n)::DOUBLE AS p FROM months),
fractions AS (
  SELECT month, n, is_test, CASE WHEN is_test THEN 0.03e0
    ELSE least(greatest(coalesce((0.04e0 - p * 0.03e0) / nullif(1 - p, 0), 0.04e0), 0e0), 1e0) END AS fraction
  FROM months CROSS JOIN share
)"""

_HOLDOUT = f"""
, held AS (SELECT color, pu_borough, do_borough, month_ym, dow_name, hour_of_day, total_amount AS y_true
  FROM trips WHERE month_ym IN {_TEST_MONTHS}),
joined AS (SELECT held.*, avg_amount_per_trip FROM held
  LEFT JOIN cells USING (color, pu_borough, do_borough, month_ym, dow_name, hour_of_day)),
predicted AS (SELECT *, coalesce(avg_amount_per_trip,
  avg(avg_amount_per_trip) OVER (PARTITION BY color)) AS y_hat FROM joined)"""

_METRICS = f"""
SELECT count(*) AS test_rows, count(avg_amount_per_trip) AS matched_rows,
  {_round("count(avg_amount_per_trip) / count(*)::DOUBLE", 6)} AS coverage,
  {_round("sqrt(avg(pow(y_true - y_hat, 2)))", 6)} AS rmse
FROM predicted"""

_HISTORY = f"""
, past AS (
  SELECT color, pu_borough, do_borough, dow_name, hour_of_day,
    sum(avg_amount_per_trip * total_trips)
      / sum(total_trips) FILTER (avg_amount_per_trip IS NOT NULL) AS avg_amount_per_trip
  FROM cells WHERE month_ym < '2001-04' GROUP BY ALL),
held AS (SELECT color, pu_borough, do_borough, dow_name, hour_of_day, total_amount AS y_true
  FROM trips WHERE month_ym IN {_TEST_MONTHS}),
joined AS (SELECT held.*, avg_amount_per_trip FROM held
  LEFT JOIN past USING (color, pu_borough, do_borough, dow_name, hour_of_day)),
predicted AS (SELECT *, coalesce(avg_amount_per_trip,
  avg(avg_amount_per_trip) OVER (PARTITION BY color)) AS y_hat FROM joined)"""

_TRIP_COLUMNS = (
    'pickup_ts, dropoff_ts, trip_distance, total_amount, tip_amount, passenger_count, payment_type,'
    ' "PULocationID", "DOLocationID"'
)

ORACLE: dict[str, str] = {
    "cleaned_trips": _with("SELECT * FROM cleaned"),
    "attrition": _attrition(),
    "violations": _with(
        f"SELECT failed_rule, {_ROW_KEYS}, pickup_ts, dropoff_ts, duration_sec, total_amount"
        " FROM flagged WHERE failed_rule IS NOT NULL"
    ),
    "speed_offenders": _with(
        """
        SELECT color, speed_kmh, distance_km, duration_sec FROM flagged
        WHERE failed_rule = 'rule_4'
        QUALIFY row_number() OVER (
          PARTITION BY color ORDER BY speed_kmh DESC, distance_km DESC, duration_sec DESC) <= 10"""
    ),
    "enriched_trips": _with(
        f"""
        SELECT {_TRIP_COLUMNS}, color, duration_sec, distance_km, speed_kmh,
          CASE color WHEN 'green' THEN l_linenumber / 4e0 ELSE 0e0 END AS ehail_fee,
          CASE color WHEN 'green' THEN l_linenumber % 2 + 1e0 ELSE 0e0 END AS trip_type,
          CASE color WHEN 'yellow' THEN CAST(l_linenumber % 3 AS DOUBLE) ELSE 0e0 END AS airport_fee,
          pu_borough, pu_zone, pu_service_zone, do_borough, do_zone, do_service_zone
        FROM trips"""
    ),
    "zone_match": _with(
        """
        SELECT count(*) FILTER (pu_borough IS NULL) AS missing_pu,
          count(*) FILTER (do_borough IS NULL) AS missing_do, count(*) AS total_rows FROM trips"""
    ),
    "unmatched_zones": _with(
        """
        SELECT 'pu' AS role, "PULocationID" AS location_id, count(*) AS trips
        FROM trips WHERE pu_borough IS NULL GROUP BY ALL
        UNION ALL
        SELECT 'do', "DOLocationID", count(*) FROM trips WHERE do_borough IS NULL GROUP BY ALL"""
    ),
    "residual_negative_speed": _with(
        f"""
        SELECT count(*) FILTER (speed_kmh < 0) AS negative_speeds, count(*) AS total_rows,
          {_round("100e0 * count(*) FILTER (speed_kmh < 0) / nullif(count(*), 0)", 4)} AS negative_pct
        FROM cleaned"""
    ),
    "trips_per_month": _monthly("count(*)", "total_trips"),
    "busiest_weekday": _top_slot("dow_name", "top_day_of_week", "trips_on_top_dow"),
    "busiest_hour": _top_slot("hour_of_day", "top_hour_of_day", "trips_in_top_hour"),
    "avg_passengers": _monthly(_round("avg(passenger_count)", 2), "avg_passengers_per_trip"),
    "avg_amount": _monthly(_exact_average(), "avg_amount_per_trip"),
    "amount_per_passenger": _monthly(
        _round("avg(CASE WHEN passenger_count > 0 THEN total_amount / passenger_count END)", 2),
        "avg_amount_per_passenger",
    ),
    "color_stats": _color_stats(),
    "cell_stats": _with("SELECT * FROM cells", cells=True),
    "pair_revenue_share": _with(
        f"""
        , pairs AS (
          SELECT pu_borough, do_borough, round(sum(total_amount), 2) AS total_revenue FROM trips
          WHERE year(pickup_ts) = 2000 AND pu_borough IS NOT NULL AND do_borough IS NOT NULL GROUP BY ALL)
        SELECT pu_borough, do_borough, total_revenue,
          {_round("100 * total_revenue / (SELECT sum(total_revenue) FROM pairs)", 2)} AS revenue_share_pct
        FROM (SELECT *, rank() OVER (ORDER BY total_revenue DESC) AS rk FROM pairs) WHERE rk <= 10"""
    ),
    "tip_shares": _with(f"SELECT {_TIPS} FROM trips WHERE {_PAID}"),
    "duration_bins": _with(
        f"""
        , tips AS (SELECT {_TIPS} FROM trips WHERE {_PAID})
        SELECT tips.*, b.* FROM (
          SELECT {_BIN} AS duration_bin, {_round("avg(speed_kmh)", 2)} AS avg_speed_kmh,
            {_round("avg(distance_km / total_amount)", 4)} AS avg_km_per_dollar
          FROM trips WHERE {_PAID} GROUP BY 1) b CROSS JOIN tips"""
    ),
    "duration_bin_revenue": _with(
        f"""
        SELECT {_BIN} AS duration_bin, {_exact_average()} AS avg_revenue_per_trip,
          {_round("avg(speed_kmh)", 2)} AS avg_speed_kmh,
          {_round("avg(CASE WHEN total_amount <> 0 THEN distance_km / total_amount END)", 4)} AS avg_km_per_dollar
        FROM trips WHERE duration_sec IS NOT NULL AND total_amount IS NOT NULL GROUP BY 1"""
    ),
    "summary": _summary(),
    "text_summary": _text_summary(),
    "target_correlation": _target_correlation(),
    "correlation_matrix": _correlation_matrix(),
    "amount_histogram": _with(
        """
        , counts AS (
          SELECT least(CAST(floor(total_amount / 2e0) AS INTEGER), 99) AS bin, count(*) AS n
          FROM trips WHERE total_amount BETWEEN 0 AND 200 GROUP BY 1)
        SELECT CAST(r AS INTEGER) AS bin, 2e0 * r AS bin_low, 2e0 * (r + 1) AS bin_high,
          coalesce(n, 0) AS frequency
        FROM range(100) AS t(r) LEFT JOIN counts ON bin = r"""
    ),
    "category_shares": _category_shares(),
    "sampling_fractions": _with(
        f"""{_FRACTIONS}
        SELECT month, n AS "rows", is_test, {_round("fraction", 9)} AS fraction FROM fractions"""
    ),
    "stratified_sample": _with(
        f"""{_FRACTIONS}
        SELECT month_ym AS month, {_ROW_KEYS}, total_amount
        FROM trips JOIN fractions ON month_ym = month
        WHERE total_amount IS NOT NULL AND {_unit(42)} < fraction"""
    ),
    "simple_fraction": _with(f"SELECT {_ROW_KEYS}, total_amount FROM trips WHERE {_unit(7)} < 0.05e0"),
    "temporal_split": _with(
        f"""
        SELECT CASE WHEN month_ym IN {_TEST_MONTHS} THEN 'test' WHEN {_unit(43)} < 0.8e0 THEN 'train'
          ELSE 'val' END AS split, month_ym AS month, count(*) AS "rows", round(sum(total_amount), 2) AS amount
        FROM trips WHERE total_amount IS NOT NULL GROUP BY 1, 2"""
    ),
    "baseline_predictions": _with(
        f"""{_HOLDOUT}
        SELECT * EXCLUDE (y_hat), {_round("y_hat", 6)} AS y_hat FROM predicted""",
        cells=True,
    ),
    "baseline_metrics": _with(_HOLDOUT + _METRICS, cells=True),
    "baseline_history": _with(_HISTORY + _METRICS, cells=True),
    "mode_imputation": _with(
        ", known AS (SELECT * FROM trips WHERE total_amount IS NOT NULL)\n"
        + _union(
            [
                f"""SELECT '{name}' AS "column",
                  (SELECT CAST({c} AS VARCHAR) FROM known WHERE {c} IS NOT NULL
                   GROUP BY {c} ORDER BY count(*) DESC, CAST({c} AS VARCHAR) LIMIT 1) AS mode,
                  (SELECT count(*) FROM known WHERE {c} IS NOT NULL
                   GROUP BY {c} ORDER BY count(*) DESC LIMIT 1) AS "rows",
                  (SELECT count(*) FROM known WHERE {c} IS NULL) AS missing"""
                for name, c in {
                    "color": "color",
                    "pu_borough": "pu_borough",
                    "do_borough": "do_borough",
                    "payment_type": "payment_type",
                    "day_of_week": "dow_name",
                    "month": "month_ym",
                }.items()
            ]
        )
    ),
    "log_target": _with(
        f"""
        SELECT {_ROW_KEYS}, greatest(coalesce(total_amount, 0), 0.001e0) AS target,
          {_round("ln(1 + greatest(coalesce(total_amount, 0), 0.001e0))", 9)} AS log_target,
          {_round("greatest(coalesce(total_amount, 0), 0.001e0)", 6)} AS restored
        FROM trips"""
    ),
}
