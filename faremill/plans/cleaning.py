"""Raw feeds to the stored, enriched trip table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from faremill.functions.trip import derive_measures
from faremill.operators.enrich import enrich, union_feeds
from faremill.operators.quality import Limits, attrition, clean
from faremill.schema import FeedSpec, conform
from faremill.sources.writers import save_trips


@dataclass(frozen=True)
class TripTables:
    """Lazy stages of one run; nothing is computed until a stage is written or read."""

    measured: DataFrame
    cleaned: DataFrame
    enriched: DataFrame
    limits: Limits

    def attrition(self) -> DataFrame:
        return attrition(self.measured, limits=self.limits)

    def save(self, name: str, fmt: str = "parquet") -> DataFrame:
        return save_trips(self.enriched, name, fmt)


def build_trips(
    feeds: Sequence[tuple[FeedSpec, DataFrame]],
    zones: DataFrame,
    limits: Limits = Limits(),
) -> TripTables:
    """Conform, measure, clean, union and enrich any number of feeds."""
    measured = union_feeds(*[derive_measures(conform(feed, spec)) for spec, feed in feeds])
    cleaned = clean(measured, limits)
    return TripTables(measured, cleaned, enrich(cleaned, zones), limits)
