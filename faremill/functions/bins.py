"""Ordered, left-closed value bins."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Bins:
    """``labels[i]`` covers values below ``bounds[i]``; the last label takes the rest.

    As in a CASE ladder a NULL falls into the last bin, so callers filter NULLs first.
    """

    bounds: tuple[float, ...]
    labels: tuple[str, ...]

    def __post_init__(self) -> None:
        if len(self.labels) != len(self.bounds) + 1 or list(self.bounds) != sorted(self.bounds):
            raise ValueError("bins need ascending bounds and one more label than bounds")

    def order(self, value: Column) -> Column:
        """Bin number starting at 1: cheap to group by, and the sort order of the labels."""
        ladder = None
        for position, bound in enumerate(self.bounds, start=1):
            test = value < F.lit(float(bound))
            ladder = F.when(test, position) if ladder is None else ladder.when(test, position)
        return ladder.otherwise(len(self.labels))

    def label(self, order: str | Column) -> Column:
        order = F.col(order) if isinstance(order, str) else order
        return F.element_at(F.array(*[F.lit(text) for text in self.labels]), order)


# Trip-duration bins in minutes (the labels use an en dash).
DURATION_BINS = Bins(
    bounds=(5, 10, 20, 30, 60),
    labels=(
        "Under 5 Mins",
        "5–10 Mins",
        "10–20 Mins",
        "20–30 Mins",
        "30–60 Mins",
        "At least 60 Mins",
    ),
)
