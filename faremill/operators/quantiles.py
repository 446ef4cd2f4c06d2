"""Exact quantiles by bracketing, without sorting the data.

A quantile sketch narrows every requested quantile to a thin bracket of values that is
certain to contain it. A second scan counts the rows between brackets and the distinct
values inside them; the wanted order statistic follows from running counts. What is ever
gathered in one window is a bounded number of buckets, then the few values of one bucket.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


_BUCKETS = 4096  # equal-width slices of one bracket


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    by: Sequence[str] = (),
    interpolation: str = "lower",
    accuracy: int = 10_000,
    facts: Mapping[str, Callable[[Column], Column]] | None = None,
) -> DataFrame:
    """One row per group, column and probability: ``(*by, column, *facts, probability, quantile)``.

    ``lower`` returns an element of the data (the lower middle for a median); ``linear``
    interpolates between neighbours. NULLs are ignored. ``facts`` are further aggregates of
    each column, taken in the sketch's scan. ``by`` is meant for a few groups, such as
    feeds: the brackets are one row per group and column.
    """
    by, keys = list(by), [*by, "column"]
    facts = dict(facts or {})
    values = [
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns
    ]
    long = df.select(*by, F.inline(F.array(*values))).filter(F.col("value").isNotNull())

    brackets = _brackets(df, columns, probabilities, by, accuracy, facts)
    runs = _runs(long, brackets, keys, len(probabilities))
    targets = _targets(brackets, probabilities, keys, interpolation)
    found = _select_ranks(runs, targets, keys)

    wanted = F.explode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("probability")
    lines = brackets.select(*keys, *facts, wanted)
    return _match(lines, found, [*keys, "probability"], "left")


def _brackets(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    by: list[str],
    accuracy: int,
    facts: Mapping[str, Callable[[Column], Column]],
) -> DataFrame:
    """Per group and column: row count, bracket edges of each probability and the facts."""
    slack = 2.0 / accuracy  # twice the sketch's rank error
    lows = [max(0.0, p - slack) for p in probabilities]
    highs = [min(1.0, p + slack) for p in probabilities]

    def line(name: str) -> Column:
        value = F.col(name).cast("double")
        return F.struct(
            F.lit(name).alias("column"),
            F.count(name).alias("n"),
            F.percentile_approx(value, [*lows, *highs], accuracy).alias("edge"),
            *[aggregate(value).alias(fact) for fact, aggregate in facts.items()],
        )

    count = len(probabilities)
    return (
        df.groupBy(*by)
        .agg(F.array(*[line(c) for c in columns]).alias("brackets"))
        .select(*by, F.inline("brackets"))
        .select(
            *by,
            "column",
            "n",
            F.slice("edge", 1, count).alias("lows"),
            F.slice("edge", count + 1, count).alias("highs"),
            *facts,
        )
    )


def _runs(long: DataFrame, brackets: DataFrame, keys: list[str], count: int) -> DataFrame:
    """Counts of consecutive value runs: single values inside brackets, gaps outside.

    ``slot`` numbers brackets and gaps alternately; a bracket is sliced further so that
    running counts never need more than a bounded number of rows per window.
    """
    value, low, high = F.col("value"), F.col("low"), F.col("high")
    width = F.nullif((high - low) / F.lit(float(_BUCKETS)), F.lit(0.0))
    slice_number = F.coalesce(
        F.least(F.floor((value - low) / width).cast("int"), F.lit(_BUCKETS - 1)), F.lit(0)
    )
    # Brackets ascend, so the first one whose upper edge reaches the value decides.
    edges_below = [F.when(F.get("highs", F.lit(i)) < value, 1).otherwise(0) for i in range(count)]
    edges = brackets.select(*keys, "lows", "highs")
    placed = (
        _match(long, edges, keys)
        .withColumn("above", reduce(add, edges_below))
        .withColumn("low", F.get("lows", F.col("above")))
        .withColumn("high", F.get("highs", F.col("above")))
        .withColumn("inside", F.coalesce(low <= value, F.lit(False)))
        .select(
            *keys,
            (F.col("above") * 2 + F.col("inside").cast("int")).alias("slot"),
            F.when(F.col("inside"), slice_number).otherwise(0).alias("bucket"),
            F.when(F.col("inside"), value).alias("single"),
            "value",
        )
    )
    return placed.groupBy(*keys, "slot", "bucket", "single").agg(
        F.count(F.lit(1)).alias("n_run"),
        F.min("value").alias("run_min"),
        F.max("value").alias("run_max"),
    )


def _targets(
    brackets: DataFrame, probabilities: Sequence[float], keys: list[str], interpolation: str
) -> DataFrame:
    """Ranks (from 1) of the order statistics each probability needs, and their weights."""
    n = F.col("n")

    def wanted(p: float) -> Column:
        if interpolation == "lower":
            first = F.greatest(F.ceil(n * F.lit(float(p))), F.lit(1))
            second, weight = first, F.lit(0.0)
        elif interpolation == "linear":
            position = (n - 1) * F.lit(float(p))
            first, second = F.floor(position) + 1, F.ceil(position) + 1
            weight = position - F.floor(position)
        else:
            raise ValueError(f"unknown interpolation {interpolation!r}")
        return F.struct(
            F.lit(float(p)).alias("probability"),
            F.array(first.cast("bigint"), second.cast("bigint")).alias("ranks"),
            F.array(1.0 - weight, weight).alias("weights"),
        )

    return brackets.select(
        *keys, F.inline(F.array(*[wanted(p) for p in probabilities]))
    ).select(
        *keys,
        "probability",
        F.inline(F.arrays_zip(F.col("ranks").alias("rank"), F.col("weights").alias("weight"))),
    ).filter(F.col("weight") > 0)


def _select_ranks(runs: DataFrame, targets: DataFrame, keys: list[str]) -> DataFrame:
    bucket_keys = [*keys, "slot", "bucket"]
    # Carrying the run bounds keeps both uses of `runs` alike, so its shuffle is read twice
    # instead of being computed twice.
    buckets = runs.groupBy(*bucket_keys).agg(
        F.sum("n_run").alias("n_bucket"),
        F.min("run_min").alias("bucket_min"),
        F.max("run_max").alias("bucket_max"),
    )
    in_order = Window.partitionBy(*keys).orderBy("slot", "bucket")
    buckets = buckets.withColumn("_end", F.sum("n_bucket").over(in_order))
    hit_buckets = (
        _match(buckets, targets, keys)
        .filter(
            (F.col("rank") <= F.col("_end")) & (F.col("rank") > F.col("_end") - F.col("n_bucket"))
        )
        .select(
            *bucket_keys,
            "bucket_min",
            "bucket_max",
            "probability",
            "weight",
            (F.col("rank") - (F.col("_end") - F.col("n_bucket"))).alias("rank"),
        )
    )
    within = Window.partitionBy(*bucket_keys, "probability", "weight", "rank").orderBy("run_min")
    located = (
        _match(runs, hit_buckets, bucket_keys)
        .filter(
            F.col("single").isNull()
            | F.col("single").between(F.col("bucket_min"), F.col("bucket_max"))
        )
        .withColumn("_end", F.sum("n_run").over(within))
        .filter(
            (F.col("rank") <= F.col("_end")) & (F.col("rank") > F.col("_end") - F.col("n_run"))
        )
    )
    # A target that falls into a gap touches its edge: the sketch is off by one rank at most.
    value = F.when(F.col("rank") == F.col("_end"), F.col("run_max")).otherwise(F.col("run_min"))
    return (
        located.select(*keys, "probability", (value * F.col("weight")).alias("part"))
        .groupBy(*keys, "probability")
        .agg(F.sum("part").alias("quantile"))
    )


def _match(left: DataFrame, small: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on keys that may be NULL (a group of its own).

    ``small`` has a few rows per group and column, so it goes to the rows: dealt by their few keys, these
    would all land in as many tasks.
    """
    renamed = F.broadcast(small.withColumnsRenamed({k: f"_{k}" for k in keys}))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return left.join(renamed, same, how).drop(*[f"_{k}" for k in keys])
