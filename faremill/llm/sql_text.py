"""Pieces of DuckDB SQL for texts: crc32, which DuckDB lacks, and lower-casing of A-Z alone."""

from __future__ import annotations

from faremill.llm.common import LOWER, UPPER


def ascii_lower_sql(text: str) -> str:
    return f"translate({text}, '{UPPER}', '{LOWER}')"


def crc_table() -> str:
    """A CTE ``crc`` with the 256 remainders as one list, by the reflected polynomial."""
    step = "range AS i, range AS x FROM range(256)"
    rows = f"SELECT {step}"
    for _ in range(8):
        rows = f"SELECT i, CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END AS x FROM ({rows})"
    return f"crc AS (SELECT list(x ORDER BY i) AS t FROM ({rows}))"


def utf8_sql(text: str) -> str:
    """The UTF-8 bytes of a text of code points below U+0800."""
    c = "unicode(ch)"
    pair = f"[192 | ({c} >> 6), 128 | ({c} & 63)]"
    return f"flatten(list_transform(string_split({text}, ''), lambda ch: CASE WHEN {c} < 128 THEN [CAST({c} AS BIGINT)] ELSE {pair} END))"


def crc32_sql(text: str) -> str:
    """Unsigned crc32 of a text; needs the CTE of ``crc_table``, cross-joined, as lambdas take no subqueries."""
    look = "crc.t[(xor(a, b) & 255) + 1]"
    state = f"list_reduce(list_prepend(4294967295, {utf8_sql(text)}), lambda a, b: xor(a >> 8, {look}))"
    return f"xor({state}, 4294967295)"
