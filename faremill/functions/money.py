"""Amount arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_cents(amount: str | Column) -> Column:
    amount = F.col(amount) if isinstance(amount, str) else amount
    return F.round(amount * 100).cast("bigint")


def average_money(amount: str | Column, mode: str = "round") -> Column:
    """Mean amount to two decimals.

    ``round`` rounds the floating mean. ``exact_cents`` sums whole cents and rounds half
    up in integers: order-independent, so every partitioning gives the same cent.
    """
    if mode == "round":
        return F.round(F.avg(amount), 2)
    if mode != "exact_cents":
        raise ValueError(f"unknown rounding mode {mode!r}")
    amount = F.col(amount) if isinstance(amount, str) else amount
    return half_up_ratio(F.sum(to_cents(amount)), F.count(amount)) / F.lit(100.0)


def half_up_ratio(total: Column, count: Column) -> Column:
    """``round(total / count)`` in integers, halves towards plus infinity, NULL if empty."""
    numerator = total * 2 + count
    # floor division: pmod keeps the remainder non-negative for negative totals
    whole = (numerator - F.pmod(numerator, count * 2)) / (count * 2)
    return F.when(count > 0, F.round(whole).cast("bigint"))


def clean_target(amount: str | Column, floor: float = 1e-3) -> Column:
    """Coerce to double, NULL/NaN/unparsable to 0, then clip below at ``floor``."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    numeric = F.coalesce(amount.try_cast("double"), F.lit(0.0))
    return F.greatest(F.nanvl(numeric, F.lit(0.0)), F.lit(float(floor)))
