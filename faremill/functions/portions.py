"""Deterministic pseudo-random numbers for sampling and splitting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def unit_hash(*columns: str | Column, seed: int = 42) -> Column:
    """A number in [0, 1) that depends only on the row's values and the seed.

    Unlike ``rand`` it does not depend on how rows are partitioned, so a retried task, a
    second scan or another engine picks the same rows. Uses the leading 32 bits of MD5.
    """
    values = [F.col(c) if isinstance(c, str) else c for c in columns]
    parts = [F.coalesce(v.cast("string"), F.lit("~")) for v in values]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(2**32))
