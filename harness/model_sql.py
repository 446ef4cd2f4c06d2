"""DuckDB SQL of the queries on the encoder and the models."""

from __future__ import annotations

from faremill.operators.features import CATEGORICAL, NUMERIC
from harness.oracle import _ROW_KEYS, _TEST_MONTHS, _round, _unit, _with

_NUMBERS = ["passenger_count", "distance_km", "CAST(duration_sec AS DOUBLE)", "speed_kmh", "CAST(hour_of_day AS DOUBLE)"]
_TEXTS = ["color", "pu_borough", "do_borough", "CAST(payment_type AS VARCHAR)", "dow_name", "month_ym"]
_N, _T = range(len(_NUMBERS)), range(len(_TEXTS))


def _each(pattern: str, of: range, joint: str = ", ") -> str:
    return joint.join(pattern.replace("#", str(i)) for i in of)


_MODE = """(SELECT t# FROM model_rows WHERE split = 'train' AND t# IS NOT NULL GROUP BY t#
  ORDER BY count(*) DESC, t# LIMIT 1) AS g#"""
_VOCABULARY = """v# AS (SELECT t# AS value, row_number() OVER (ORDER BY t#) - 1 AS idx
  FROM (SELECT DISTINCT t# FROM filled WHERE split = 'train'))"""

#: All rows with split, target and label, numbers n0.. and texts t0.., then filled, scaled and indexed as x0.. and c0..
ENCODED = f"""
, model_rows AS (
  SELECT {_ROW_KEYS}, CASE WHEN month_ym IN {_TEST_MONTHS} THEN 'test' WHEN {_unit(43)} < 0.8e0 THEN 'train' ELSE 'val' END AS split,
    greatest(coalesce(total_amount, 0), 0.001e0) AS target, ln(1 + greatest(coalesce(total_amount, 0), 0.001e0)) AS label,
    {", ".join(f"{n} AS n{i}" for i, n in enumerate(_NUMBERS))}, {", ".join(f"{t} AS t{i}" for i, t in enumerate(_TEXTS))}
  FROM trips WHERE total_amount IS NOT NULL
),
fills AS (SELECT {_each("quantile_disc(n#, 0.5) AS f#", _N)}, {_each(_MODE, _T)} FROM model_rows WHERE split = 'train'),
filled AS (
  SELECT {_ROW_KEYS}, split, target, label, {_each("coalesce(n#, f#) AS n#", _N)}, {_each("coalesce(t#, g#) AS t#", _T)}
  FROM model_rows CROSS JOIN fills
),
scales AS (SELECT {_each("avg(n#) AS m#, stddev_samp(n#) AS s#", _N)} FROM filled WHERE split = 'train'),
{_each(_VOCABULARY, _T, ",")},
encoded AS (
  SELECT {_ROW_KEYS}, split, target, label, {_each("(n# - m#) / s# AS x#", _N)}, {_each("t#", _T)},
    {_each("CAST(coalesce(v#.idx, (SELECT count(*) FROM v#)) AS INTEGER) AS c#", _T)}
  FROM filled CROSS JOIN scales {_each("LEFT JOIN v# ON t# = v#.value", _T, " ")}
)"""


def _inputs(value: str) -> str:
    """(input) for every parameter of a linear model, with ``value`` per kind of input."""
    numbers = [f"SELECT '{n}' AS input, {value.replace('#', f'x{i}')} FROM train" for i, n in enumerate(NUMERIC)]
    texts = [f"SELECT '{c}=' || t{j}, {value.replace('#', '1')} FROM train GROUP BY t{j}" for j, c in enumerate(CATEGORICAL)]
    return " UNION ALL ".join([*numbers, *texts, f"SELECT 'intercept', {value.replace('#', '1')} FROM train"])


def _huber_gradient() -> str:
    guess = " + ".join(["2e0", *[f"{0.1 * (i + 1)}::DOUBLE * x{i}" for i in _N], *[f"0.05e0 * ((c{j} + {j}) % 3)" for j in _T]])
    body = f"""{ENCODED}
    , train AS (SELECT *, greatest(-0.1e0, least(0.1e0, r)) AS slope FROM (SELECT *, {guess} - label AS r FROM encoded WHERE split = 'train')),
    total AS (SELECT count(*) AS n, sum(CASE WHEN abs(r) <= 0.1e0 THEN r * r / 2 ELSE 0.1e0 * abs(r) - 0.005e0 END) AS loss FROM train)
    SELECT input, n AS "rows", {_round("loss", 6)} AS loss, {_round("g", 6)} AS gradient
    FROM ({_inputs("sum(slope * #) AS g")}) CROSS JOIN total"""
    return _with(body)


def _ridge_path() -> str:
    body = f"""{ENCODED}
    , sums AS (SELECT count(*) * var_pop(x1) AS a, count(*) * var_pop(x2) AS b, count(*) * covar_pop(x1, x2) AS c,
        count(*) * covar_pop(x1, label) AS p, count(*) * covar_pop(x2, label) AS q,
        avg(x1) AS m1, avg(x2) AS m2, avg(label) AS m FROM encoded WHERE split = 'train'),
    solved AS (SELECT alpha, ((b + alpha) * p - c * q) / d AS u, ((a + alpha) * q - c * p) / d AS v, m, m1, m2
      FROM (SELECT *, (a + alpha) * (b + alpha) - c * c AS d FROM sums CROSS JOIN (VALUES (0e0), (1e0), (100e0), (10000e0)) AS t(alpha)))
    SELECT alpha, {_round("u", 8)} AS distance, {_round("v", 8)} AS duration, {_round("m - u * m1 - v * m2", 8)} AS intercept FROM solved"""
    return _with(body)


def _ols() -> str:
    lines = [
        f"""SELECT '{name}' AS input, {_round(f"regr_slope(label, x{i})", 8)} AS slope,
          {_round(f"regr_intercept(label, x{i})", 8)} AS intercept,
          {_round(f"var_pop(label) * (1 - regr_r2(label, x{i}))", 8)} AS mean_squared_error
        FROM encoded WHERE split = 'train'"""
        for i, name in enumerate(NUMERIC)
    ]
    return _with(f"{ENCODED} {' UNION ALL '.join(lines)}")


def _optimality() -> str:
    return _with(
        f"""{ENCODED}, train AS (SELECT * FROM encoded WHERE split = 'train')
        SELECT model, input, true AS optimal FROM (SELECT DISTINCT input FROM ({_inputs("count(#) AS n")}))
        CROSS JOIN (VALUES ('linear'), ('ridge'), ('huber')) AS t(model)"""
    )


def _network() -> str:
    hidden = []
    for k in range(3):
        terms = [f"{((3 * i + k) % 5 - 2) / 10}::DOUBLE * x{i}" for i in _N]
        hidden.append(f"{(k + 1) / 10}::DOUBLE * greatest(0e0, {' + '.join(terms)} + {k / 10}::DOUBLE)")
    body = f"""{ENCODED}
    , scored AS (SELECT split, target, exp(least(6e0, {" + ".join(hidden)} + 2e0)) - 1 AS guess FROM encoded)
    SELECT 'network' AS model, split, count(*) AS "rows", {_round("sqrt(avg(pow(target - guess, 2)))", 6)} AS rmse,
      {_round("avg(abs(target - guess))", 6)} AS mae FROM scored GROUP BY split"""
    return _with(body)


def _onehot() -> str:
    lines = [
        f"""SELECT r.split, '{c}' AS "column", v.idx AS index, count(*) AS "rows" FROM model_rows r
        LEFT JOIN (SELECT value, row_number() OVER (ORDER BY value) - 1 AS idx
          FROM (SELECT DISTINCT t{j} AS value FROM model_rows WHERE split = 'train' AND t{j} IS NOT NULL)) v
        ON r.t{j} = v.value GROUP BY ALL"""
        for j, c in enumerate(CATEGORICAL)
    ]
    return _with(f"{ENCODED} {' UNION ALL '.join(lines)}")


ORACLE: dict[str, str] = {
    "encoded_rows": _with(
        f"""{ENCODED} SELECT {_ROW_KEYS}, split, {", ".join(f"{_round(f'x{i}', 6)} AS x{i}" for i in _N)}, {_each("c#", _T)} FROM encoded"""
    ),
    "onehot_counts": _onehot(),
    "huber_gradient": _huber_gradient(),
    "ridge_path": _ridge_path(),
    "ols_closed_form": _ols(),
    "model_optimality": _optimality(),
    "network_forward": _network(),
    "saved_models": _with(
        f"""{ENCODED} SELECT model, split, count(*) AS "rows", CAST(0 AS BIGINT) AS differing FROM model_rows
        CROSS JOIN (VALUES ('linear'), ('ridge'), ('huber'), ('mlp')) AS t(model) GROUP BY ALL"""
    ),
}
