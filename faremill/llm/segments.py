"""Shingle sets and their segment signatures.

Universe partition with the pigeonhole principle. Sizes fall into bands; a band's partition hashes
every possible shingle to one of ``m`` segments. Two sets of the band that are similar enough differ
in at most ``H`` shingles, so at most ``H`` segments differ; with ``m = H + 1 + spare`` at least
``spare + 1`` segments are equal. A segment of the second kind also counts as found if the two differ
by one shingle there: both sides then show the segment and all its one-deletion neighbours, and ``H``
differences spoil one such segment for every two of them. ``allocate`` weighs both kinds by cost.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import cache

import numpy as np
import xxhash

from faremill.llm.common import text_words

# fixed values: odd multipliers and shifts of a 64-bit finaliser
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_GOLD, _S33 = np.uint64(0x9E3779B97F4A7C15), np.uint64(33)
RATIO = 1.5
MASK = np.uint64(0xFFFFFFFFFFFFFF00)


def mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _S33)) * _M1
        x = (x ^ (x >> _S33)) * _M2
        return x ^ (x >> _S33)


class WordHashes(dict):
    """64-bit hashes of words, remembered for up to ``most`` words."""

    def __init__(self, most: int = 100_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: str | None, k: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; one for all words where there are fewer than k."""
    words = text_words(text)
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter([hashes[w] for w in words], np.uint64, len(words))
    width = min(k, len(h))
    with np.errstate(over="ignore"):
        rolled = mix(h[: len(h) - width + 1] + np.uint64(width))
        for at in range(1, width):
            rolled = mix(rolled * _GOLD + h[at : len(h) - width + 1 + at])
    return np.unique(rolled)


def set_id(items: np.ndarray) -> int:
    """Signed 64-bit identity of a shingle set."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(items.tobytes())).astype(np.int64))


def most_different(total: int, percent: int) -> int:
    """Largest symmetric difference of two sets with ``total`` elements together that still link."""
    need = -(-percent * total // (100 + percent))
    return total - 2 * need


@dataclass(frozen=True)
class Partition:
    """Segments of one band: ``deletions`` come with their neighbours, the rest are exact."""

    band: int
    segments: int
    deletions: int
    spare: int


def band_edges(band: int, percent: int) -> tuple[int, int]:
    ratio = max(RATIO, 101 / percent)
    return math.ceil(ratio**band), math.ceil(ratio ** (band + 1))


def band_of(size: int, percent: int) -> int:
    band = max(int(math.log(size) / math.log(max(RATIO, 101 / percent))) - 1, 0)
    while band_edges(band, percent)[1] <= size:
        band += 1
    return band


def _row_cost(low: int, exact: int, deletions: int) -> float:
    """Signatures that a set at the low end of the band shows, and a charge for segments of one shingle."""
    mean = low / (exact + deletions)
    one = mean * math.exp(-mean)
    return exact + deletions * (1 + mean) + 2 * (exact * one + deletions * one * mean / 2)


def _bare(low: int, exact: int, deletions: int) -> float:
    """How many signatures of no shingle a set shows at most, nearly always; the spare ones cover them."""
    mean = low / (exact + deletions)
    bare = math.exp(-mean) * (exact + deletions * (1 + mean))
    return bare + 2 * math.sqrt(bare) if bare > 0.2 else 0.0


@cache
def allocate(band: int, percent: int) -> Partition | None:
    """The cheapest mix of exact and one-deletion segments that keeps the pigeonhole guarantee.

    None where only equal sets of the band link.
    """
    low, high = band_edges(band, percent)
    if high <= low:
        return None
    top = (high - 1) + (high - 1) * 100 // percent
    worst = max(most_different(total, percent) for total in range(max(2, top - 3), top + 1))
    if worst <= 0:
        return None
    best = None
    for deletions in range(0, min(worst // 2 + 2, 6) + 1):
        for spare in sorted({0, 1, 2, 3, 4, *(math.ceil(share * (worst + 1)) for share in (0.08, 0.12, 0.16, 0.2, 0.25, 0.3))}):
            # differences spoil exact segments first, then one-deletion segments two at a time
            extra = deletions - spare
            exact = max(0, worst - 2 * extra + 1) if extra > 0 else worst - extra + 1
            if exact + deletions == 0 or _bare(low, exact, deletions) > spare:
                continue
            cost = _row_cost(low, exact, deletions)
            if best is None or cost < best[0]:
                best = (cost, Partition(band, exact + deletions, deletions, spare))
    if best is None:  # tiny bands: whole-set deletion neighbourhoods
        best = (0.0, Partition(band, worst // 2 + 1, worst // 2 + 1, 0))
    return best[1]


def partitions_of(size: int, percent: int) -> list[Partition]:
    """Partitions in which a set of that size meets those that may be similar: its own band, and the
    band below where it may be the larger of the two."""
    own = band_of(size, percent)
    bands = [own]
    if own and -(-percent * size // 100) < band_edges(own, percent)[0]:
        bands.append(own - 1)
    return [p for p in (allocate(b, percent) for b in bands) if p]


def signatures(items: np.ndarray, percent: int) -> np.ndarray:
    """Signed 64-bit signatures; the low eight bits are the band."""
    found = []
    for part in partitions_of(len(items), percent):
        with np.errstate(over="ignore"):
            seed = np.uint64(part.band + 1) * _M2
            where = (mix(items ^ seed) % np.uint64(part.segments)).astype(np.int64)
            worth = mix(items + seed)
            sums = np.zeros(part.segments, np.uint64)
            np.add.at(sums, where, worth)
            tags = (np.arange(part.segments, dtype=np.uint64) + np.uint64(1)) * _GOLD + seed
            values = [mix(sums + tags)]
            if part.deletions:
                chosen = where < part.deletions
                at = where[chosen]
                values.append(mix(sums[at] - worth[chosen] + tags[at]))
        found.append((np.unique(np.concatenate(values) & MASK)) | np.uint64(part.band))
    return np.concatenate(found).astype(np.int64) if found else np.empty(0, np.int64)
