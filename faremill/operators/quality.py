"""Trip quality rules: cleaning, attribution of dropped rows, attrition and offenders.

Every row gets the id of the first rule it fails, in rule order. That one expression gives
the cleaned set, the violations of each rule and the attrition of all rules in one scan.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faremill.functions.calendar import instant
from faremill.operators.ranking import top_per_group


@dataclass(frozen=True)
class Limits:
    """Thresholds of the rules. Defaults are the fixed values of the trip rules."""

    date_min: str = "2014-01-01"
    date_max: str = "2024-12-31"
    inclusive_end_day: bool = False
    max_speed_kmh: float = 150.0
    min_duration_sec: int = 60
    max_duration_sec: int = 6 * 3600
    min_distance_km: float = 0.2
    max_distance_km: float = 200.0
    min_amount: float = 3.3
    exempt_payment_types: tuple[int, ...] = (3, 4, 6)


@dataclass(frozen=True)
class Rule:
    """A row survives when ``keep`` is true; false and NULL both drop it."""

    rule_id: str
    label: str
    keep: Callable[[Limits], Column]


def _in_date_range(limits: Limits) -> Column:
    # The upper bound is midnight at the start of the last day unless asked otherwise.
    pickup, last = F.col("pickup_ts"), instant(limits.date_max)
    if limits.inclusive_end_day:
        below = pickup < F.date_add(last, 1).cast("timestamp")
    else:
        below = pickup <= last
    return (
        pickup.isNotNull()
        & F.col("dropoff_ts").isNotNull()
        & (pickup >= instant(limits.date_min))
        & below
    )


# The speed rules read the speed once: filters are inlined into the scan, so every mention
# of a derived column repeats its arithmetic. An unknown speed passes both; NaN sorts above
# all numbers and so passes the first and fails the second.
def _not_negative(_: Limits) -> Column:
    return F.coalesce(F.col("speed_kmh") >= 0, F.lit(True))


def _not_speeding(limits: Limits) -> Column:
    return F.coalesce(F.col("speed_kmh") <= limits.max_speed_kmh, F.lit(True))


def _paid_or_exempt(limits: Limits) -> Column:
    exempt = F.col("payment_type").isin(*limits.exempt_payment_types)
    return (F.col("total_amount") >= limits.min_amount) | exempt


# Application order; the ids keep the published numbering of the rules.
RULES: tuple[Rule, ...] = (
    Rule("rule_1", "drop-off not before pick-up", lambda _: F.col("dropoff_ts") >= F.col("pickup_ts")),
    Rule("rule_3", "no negative speed", _not_negative),
    Rule("rule_2", "pick-up inside date range", _in_date_range),
    Rule("rule_4", "speed at most the limit", _not_speeding),
    Rule(
        "rule_5",
        "duration inside bounds",
        lambda m: F.col("duration_sec").between(m.min_duration_sec, m.max_duration_sec),
    ),
    Rule(
        "rule_6",
        "distance inside bounds",
        lambda m: F.col("distance_km").between(m.min_distance_km, m.max_distance_km),
    ),
    Rule("rule_7", "minimum amount unless payment type is exempt", _paid_or_exempt),
)


def first_failed_rule(limits: Limits = Limits(), rules: Sequence[Rule] = RULES) -> Column:
    """Id of the first rule a row fails, NULL for a clean row."""
    verdict = F.lit(None).cast("string")
    for rule in reversed(rules):
        verdict = F.when(rule.keep(limits), verdict).otherwise(rule.rule_id)
    return verdict


def clean(trips: DataFrame, limits: Limits = Limits(), rules: Sequence[Rule] = RULES) -> DataFrame:
    """Keep rows that pass every rule.

    A plain conjunction, not the attribution ladder: Catalyst splits it, and the amount,
    payment and date tests sink below joins and into the parquet scan.
    """
    return trips.filter(reduce(and_, [rule.keep(limits) for rule in rules]))


def violations(
    trips: DataFrame,
    rule_id: str | None = None,
    limits: Limits = Limits(),
    rules: Sequence[Rule] = RULES,
) -> DataFrame:
    """Dropped rows with the rule that dropped them; ``rule_id`` narrows to one rule."""
    flagged = trips.withColumn("failed_rule", first_failed_rule(limits, rules))
    if rule_id is None:
        return flagged.filter(F.col("failed_rule").isNotNull())
    return flagged.filter(F.col("failed_rule") == rule_id)


def attrition(
    trips: DataFrame,
    by: str = "color",
    limits: Limits = Limits(),
    rules: Sequence[Rule] = RULES,
) -> DataFrame:
    """Rows before and after each rule per feed, plus the overall line, in one pass.

    The only shuffle carries one partial row of counters per feed and task.
    """
    counters = [
        F.count_if(F.col("failed_rule") == rule.rule_id).alias(rule.rule_id) for rule in rules
    ]
    totals = (
        trips.select(by, first_failed_rule(limits, rules).alias("failed_rule"))
        .groupBy(by)
        .agg(F.count(F.lit(1)).alias("raw"), *counters)
    )

    lines, before = [], F.col("raw")
    for position, rule in enumerate(rules, start=1):
        after = before - F.col(rule.rule_id)
        lines.append(_attrition_line(position, rule.rule_id, before, after))
        before = after
    lines.append(_attrition_line(len(rules) + 1, "overall", F.col("raw"), before))
    return totals.select(by, F.inline(F.array(*lines)))


def _attrition_line(position: int, rule_id: str, before: Column, after: Column) -> Column:
    dropped = before - after
    return F.struct(
        F.lit(position).alias("step"),
        F.lit(rule_id).alias("rule"),
        before.alias("rows_before"),
        after.alias("rows_after"),
        dropped.alias("dropped"),
        F.round(F.try_divide(dropped * 100, before), 2).alias("dropped_pct"),
    )


def speed_offenders(trips: DataFrame, limits: Limits = Limits(), n: int = 10) -> DataFrame:
    """The ``n`` fastest trips of each feed above the limit among rows that reached the speed rule.

    Each task prunes to its own ``n`` per feed before the shuffle; the extra sort keys make the
    order total for everything the report shows.
    """
    position = [r.rule_id for r in RULES].index("rule_4")
    shown = ["speed_kmh", "distance_km", "duration_sec"]
    fastest_first = [F.col(name).desc() for name in shown]
    above = (
        clean(trips, limits, RULES[:position])
        .filter(F.col("speed_kmh") > limits.max_speed_kmh)
        .select("color", *shown)
    )
    return top_per_group(above, ["color"], fastest_first, n).orderBy("color", *fastest_first)


def negative_speed_check(trips: DataFrame) -> DataFrame:
    """Residual check on a finished table: negative speeds, rows and their percentage."""
    negative = F.count_if(F.col("speed_kmh") < 0)
    total = F.count(F.lit(1))
    return trips.agg(
        negative.alias("negative_speeds"),
        total.alias("total_rows"),
        F.round(F.try_divide(negative * 100, total), 4).alias("negative_pct"),
    )
