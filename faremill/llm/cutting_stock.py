"""Cutting stock by column generation over a histogram of item sizes.

The linear program "fewest bins that hold all items" has a column for each pattern, i.e. a way to
fill one bin. Columns are priced by an unbounded knapsack, solved by dynamic programming over the
capacity; a revised simplex step brings the best one in. Work depends on the capacity alone.
"""

from __future__ import annotations

import numpy as np


def best_pattern(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Knapsack: the most valuable counts of the sizes, used any number of times within capacity."""
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(int(sizes[0]), capacity + 1):
        fits = int(np.searchsorted(sizes, room, side="right"))
        gains = values[:fits] + best[room - sizes[:fits]]
        k = int(gains.argmax())
        best[room], choice[room] = best[room - 1], -1
        if gains[k] > best[room]:
            best[room], choice[room] = gains[k], k
    counts, room = np.zeros(len(sizes), np.int64), capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            counts[choice[room]] += 1
            room -= int(sizes[choice[room]])
    return float(best[capacity]), counts


def relaxed(demand: np.ndarray, sizes: np.ndarray, capacity: int, gap: float = 1e-3, steps: int = 4000):
    """Patterns (as columns) and how often the linear program uses each.

    Stops when the value of the best missing pattern proves the program within ``gap`` of its
    optimum, or after ``steps`` pivots; every state on the way is a feasible solution.
    """
    columns = np.diag((capacity // sizes).astype(float))
    inverse = np.diag(1.0 / np.diag(columns))
    used = inverse @ demand
    for _ in range(steps):
        value, counts = best_pattern(inverse.sum(axis=0), sizes, capacity)
        if value <= 1 + gap:
            break
        way = inverse @ counts
        limits = np.full(len(way), np.inf)
        limits[way > 1e-9] = used[way > 1e-9] / way[way > 1e-9]
        out = int(limits.argmin())
        row = inverse[out] / way[out]
        inverse -= np.outer(way, row)
        inverse[out] = row
        columns[:, out] = counts
        used = np.maximum(inverse @ demand, 0.0)
    return columns.astype(np.int64), used


def first_fit(rest: np.ndarray, sizes: np.ndarray, capacity: int) -> list[np.ndarray]:
    """Fill bins with the largest items that still fit until nothing is left."""
    rest, patterns = rest.copy(), []
    while rest.any():
        counts, room = np.zeros(len(sizes), np.int64), capacity
        for k in range(len(sizes) - 1, -1, -1):
            take = min(int(rest[k]), room // int(sizes[k]))
            counts[k] = take
            room -= take * int(sizes[k])
        rest -= counts
        patterns.append(counts)
    return patterns


def cut(histogram: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """Patterns as (copies, {size: count}); all copies together hold exactly the histogram's items."""
    sizes = np.asarray(sorted(s for s, n in histogram.items() if n > 0), np.int64)
    if not len(sizes):
        return []
    demand = np.asarray([histogram[int(s)] for s in sizes], np.int64)
    columns, used = relaxed(demand.astype(float), sizes, capacity)
    copies = np.floor(used + 1e-7).astype(np.int64)
    while (over := columns @ copies - demand).max() > 0:  # rounding noise only
        short = int(over.argmax())
        copies[int(np.where(columns[short] > 0, copies, -1).argmax())] -= 1
    plan = [(int(n), columns[:, k]) for k, n in enumerate(copies) if n > 0]
    plan += [(1, counts) for counts in first_fit(demand - columns @ copies, sizes, capacity)]
    return [(n, {int(s): int(c) for s, c in zip(sizes, counts) if c}) for n, counts in plan]
