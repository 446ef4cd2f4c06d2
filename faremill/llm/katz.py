"""Katz backoff: Good-Turing discounted n-grams over words, exactly normalised, scored per token.

    P(w | u v) = d3(r) r / c(u v)    if the three words were seen r times   (r counts up to K are discounted)
               = a(u v) P(w | v)     else, and P(w | v) after two words never seen
    P(w | v)   = d2(r) r / c(v),     else a(v) P(w), or P(w) after a word never seen
    P(w)       = d1(r) r / N, and what the discounts leave for all words never seen

``a(h)`` is what the discounted n-grams of ``h`` leave, over one minus the shorter model's probability of
the words seen after h, so that the probabilities after each h add up to one. A context whose n-grams are
all too frequent to be discounted gets one more count in its denominator, which leaves its unseen words
something. A text begins with a start mark, after which its first word is scored; ``order=2`` takes one word of context.

How it runs. Word counts are a stored table. At most ``HOT`` words, the most frequent ones, go to all
tasks as two arrays; nothing else of the vocabulary does. N-grams are dealt to parts by the word before
the last, v, so that (u, v, w), (v, w) and both contexts meet in one part; where v is frequent beyond
``SPLIT_TOKENS`` (or the start mark), by v and one of as many portions of u as it needs, and the counts of
its pairs (v, w) are added up in a table of their own. A part's counts are one row of the stored model.
Scoring deals the tokens of all documents out in the same way and meets each part's counts in a co-group.
What a part can't know, the counts of words outside of the ``HOT`` ones and of pairs with a split v, is
looked up by joins with the stored tables: for the model's weights before scoring, for tokens that back off after it.
Tokens travel compressed, one row per chunk and part; sums per document come back the same way.

Nothing is sampled or cut off: every training token counts, every token of every text is scored. A pair
(u, v) of contexts lies in one part, whatever its share; a text's repeated n-grams travel once, with their number.

Defined results: a null or empty text is its end token alone; texts are read whole; equal rows each train
and each get a row; a null id is kept (it trains, as crc32 of the empty text is 0); with nothing to learn
from every token is unseen, P(w) = 1; an empty table gives an empty result; other columns are ignored.
Words and n-grams are identified by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from faremill.llm.common import remainder, stored, text_of
from faremill.llm.segments import WordHashes, mix

K = 5
HOT = 1 << 19
SPLIT_TOKENS = 500_000
PART_TOKENS = 1_000_000
CHUNK_CHARS = 3_000_000
RUN_BYTES = 1_000_000
#: The end token: never part of UTF-8, it stands between texts while a chunk is split into words.
END = b"\xff"
START = np.uint64(1)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def discounts(seen_times: np.ndarray, k: int = K) -> np.ndarray:
    """d(0..k) of Katz from the numbers of kinds seen 1, 2, ... k + 1 times; d(0) is unused.

    Where these numbers are too few or rise, so that some d(r) isn't strictly between 0 and 1, counts up
    to k lose an absolute n1 / (n1 + 2 n2) instead (one half without any).
    """
    n = np.zeros(k + 2)
    n[1 : 1 + min(k + 1, len(seen_times))] = seen_times[: k + 1]
    r = np.arange(1, k + 1)
    d = np.ones(k + 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        common = (k + 1) * n[k + 1] / n[1]
        d[1:] = ((r + 1) * n[r + 1] / (n[r] * r) - common) / (1 - common)
    if not np.all(np.isfinite(d)) or not np.all((d[1:] > 0) & (d[1:] < 1)):
        lost = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
        d[1:] = (r - lost) / r
    return d


def discounted(counts: np.ndarray, d: np.ndarray) -> np.ndarray:
    return counts * d[np.where(counts < len(d), counts, 0).astype(np.int64)]


def _discounted(count: Column, d: np.ndarray) -> Column:
    factor = F.lit(1.0)
    for r in range(1, len(d)):
        factor = F.when(count == r, float(d[r])).otherwise(factor)
    return count * factor


def _seen_times(counts: np.ndarray) -> np.ndarray:
    return np.bincount(counts[counts <= K + 1], minlength=K + 2)[1:]


def _times_of(count: str) -> list[Column]:
    return [F.count_if(F.col(count) == r).alias(f"n{r}") for r in range(1, K + 2)]


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(mix(a + _GOLD) * _GOLD + b)


def _spots(table: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the wanted values stand in the ordered table, and whether they do."""
    if not len(table):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.searchsorted(table, wanted).clip(max=len(table) - 1)
    return at, table[at] == wanted


@dataclass
class Words:
    """The single-word model: its sums, and the ``HOT`` most frequent words by falling count."""

    keys: np.ndarray
    counts: np.ndarray
    total: int
    size: int
    texts: int
    times: np.ndarray
    split_tokens: int = SPLIT_TOKENS

    def __post_init__(self):
        order = np.argsort(self.keys)
        self.ordered, self.ranks = self.keys[order], order
        self.d = discounts(self.times)
        r = np.arange(1, K + 1)
        left = float((self.times[:K] * r * (1 - self.d[1:])).sum())
        self.below, self.rest = max(self.total, 1), left / max(self.total, 1)
        if self.size and self.rest < 1e-12:  # no word is rare enough to be discounted
            self.below, self.rest = self.total + 1, 1 / (self.total + 1)
        if not self.size:
            self.rest = 1.0

    def p(self, counts: np.ndarray) -> np.ndarray:
        return discounted(counts, self.d) / self.below

    def codes(self, keys: np.ndarray) -> np.ndarray:
        """The ranks of hot words; of others ``HOT`` plus their place."""
        at, known = _spots(self.ordered, keys)
        ranks = self.ranks[at] if len(self.ranks) else at
        return np.where(known, ranks, HOT + np.arange(len(keys)))

    def counts_of(self, keys: np.ndarray) -> np.ndarray:
        """Counts of hot words, 0 of others."""
        codes = self.codes(keys)
        return np.append(self.counts, 0)[np.where(codes < HOT, codes, len(self.counts))]

    def counts_at(self, keys: np.ndarray) -> np.ndarray:
        """The same for keys that begin with the hot words and go on with others."""
        return np.append(self.counts, np.zeros(len(keys) - len(self.counts), np.int64))

    def portions(self, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Into how many portions the n-grams with this word before the last are dealt."""
        n = np.maximum(-(-counts // self.split_tokens), 1)
        return np.where(keys == START, max(2, -(-self.texts // self.split_tokens)), n)


@dataclass
class Levels:
    """Discounts of pairs and of three words; denominators and backoff weights of the split contexts."""

    two: np.ndarray
    three: np.ndarray
    split: np.ndarray
    below: np.ndarray
    weight: np.ndarray


def _hashes(texts, memory: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and ends, and the number of tokens of each text."""
    marked = (" \udcff ".join(texts) + " \udcff").encode("utf-8", "surrogateescape")
    flat = np.fromiter(map(memory.__getitem__, marked.lower().split()), np.uint64)
    return flat, np.diff(np.flatnonzero(flat == np.uint64(memory[END])), prepend=-1)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
    """Rows with about ``CHUNK_CHARS`` characters, taken from Arrow one chunk at a time; one longer text is a chunk of its own."""
    for batch in batches:
        ends = pc.utf8_length(batch["text"]).to_numpy(zero_copy_only=False).astype(np.int64).cumsum() // CHUNK_CHARS
        cuts = (np.flatnonzero(np.diff(ends)) + 1).tolist()
        for low, high in zip([0, *cuts], [*cuts, len(batch)]):
            if high > low:
                yield batch.slice(low, high - low).to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get)


def _planes(column: np.ndarray) -> bytes:
    """Differences of neighbours, or the numbers if these have more bits, byte by byte of all: high bytes compress away."""
    steps = np.diff(column, prepend=0)
    ordered = bool((steps >= 0).all())
    raw = (steps if ordered else column).astype("<u4").view(np.uint8).reshape(-1, 4).T
    return bytes([ordered]) + raw.tobytes()


def _encoded(keys: np.ndarray, codes: np.ndarray, words: list[np.ndarray], rest: list[np.ndarray]) -> bytes:
    """Columns of words (places in ``keys``) and of numbers below 2**32, compressed; hot words travel as ranks."""
    columns = [codes[w] for w in words]
    rare = np.unique(np.concatenate([np.unique(w[c >= HOT]) for w, c in zip(words, columns)]))
    columns = [np.where(c >= HOT, HOT + np.searchsorted(rare, w), c) for w, c in zip(words, columns)]
    head = np.asarray([len(rare), len(columns[0])], "<i8").tobytes()
    body = b"".join(_planes(c) for c in [*columns, *rest])
    return zstandard.compress(head + keys[rare].astype("<u8").tobytes() + body, 3)


def _decoded(blobs, own: Words, extra: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(keys, columns) of several ``_encoded``: u, v and w as places in keys, which begin with the hot words.

    With two or more extra columns the last of all tells the blob.
    """
    found, sides = [], []
    for blob in blobs:
        raw = zstandard.decompress(blob)
        rare, rows = map(int, np.frombuffer(raw, "<i8", 2))
        sides.append(np.frombuffer(raw, "<u8", rare, 16))
        columns = []
        for at in range(3 + extra):
            start = 16 + 8 * rare + at * (4 * rows + 1)
            planes = np.frombuffer(raw, np.uint8, 4 * rows, start + 1).reshape(4, rows)
            column = np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)
            columns.append(np.cumsum(column) if raw[start] else column)
        if extra > 1:
            columns.append(np.full(rows, len(found)))
        found.append(columns)
    rare = np.unique(np.concatenate([np.empty(0, np.uint64), *sides]))
    for columns, side in zip(found, sides):
        places = np.searchsorted(rare, side) + len(own.keys)
        for at in range(3):
            c = columns[at]
            far = c >= HOT
            c[far] = places[c[far] - HOT]
    joined = [np.concatenate([np.empty(0, np.int64), *c]) for c in zip(*found)] if found else [np.empty(0, np.int64)] * (3 + extra + (extra > 1))
    return np.concatenate([own.keys, rare]), joined


def _ngrams(texts, memory: WordHashes, own: Words, order: int):
    """(keys, places of u, v and w in keys, index of the text, tokens of each text) of a chunk."""
    flat, sizes = _hashes(texts, memory)
    keys, places = np.unique(np.append(flat, START), return_inverse=True)
    w, start = places[:-1], places[-1]
    first = np.cumsum(sizes) - sizes
    v = np.roll(w, 1)
    v[first] = start
    u = np.roll(v, 1)
    u[first] = start
    if order == 2:
        u[:] = start
    return keys, u, v, w, np.repeat(np.arange(len(sizes)), sizes), sizes


def _dealt(keys, own: Words, u, v, w, parts: int, order: int) -> np.ndarray:
    """The part of each n-gram. Those without u are dealt by w where v is split."""
    portions = own.portions(keys, own.counts_of(keys))
    by = keys[np.where((keys[v] == START) | (order == 2), w, u)]
    sub = mix(by) % portions[v].astype(np.uint64)
    return (_pair(keys[v], sub) % np.uint64(parts)).astype(np.int64)


def _grouped(part: np.ndarray) -> list[np.ndarray]:
    order = np.argsort(part, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(part[order])) + 1) if len(order) else []


def _alike(keys: np.ndarray, u, v, w) -> np.ndarray:
    """A number for each n-gram, ordered by v, u and w where the chunk has few words."""
    n = len(keys)
    return (v * n + u) * n + w if n < 1 << 21 else _pair(_pair(keys[u], keys[v]), keys[w]).view(np.int64)


def count_words(train: DataFrame) -> DataFrame:
    """(w, c): every training token's hash and count; a batch adds up its own first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = WordHashes()
        for chunk in _chunks(batches):
            w, c = np.unique(_hashes(chunk["text"], memory)[0], return_counts=True)
            yield pa.record_batch({"w": w.view(np.int64), "c": c})

    return train.select("text").mapInArrow(count, "w long, c long").groupBy("w").agg(F.sum("c").alias("c"))


def word_model(listed: DataFrame, hot: int = HOT, split_tokens: int = SPLIT_TOKENS) -> Words:
    """Sums of the stored word counts, and the most frequent words, a fixed number."""
    end = WordHashes()[END]
    end = int(np.uint64(end).astype(np.int64))
    texts = F.max(F.when(F.col("w") == end, F.col("c"))).alias("texts")
    sums = listed.agg(F.sum("c").alias("total"), F.count("*").alias("size"), texts, *_times_of("c")).first()
    # counts fall into some hundred bins; the bins from the top that hold at most ``hot`` words together are taken whole
    bin_of = F.floor(16 * F.log2("c"))
    bins = sorted(listed.groupBy(bin_of.alias("bin")).count().collect(), reverse=True)
    held = np.cumsum([b["count"] for b in bins])
    lowest = [b["bin"] for b, n in zip(bins, held) if n <= min(hot, HOT)]
    top = listed.where(bin_of >= (lowest[-1] if lowest else 1 << 20)).toArrow().sort_by([("c", "descending"), ("w", "ascending")])
    times = np.asarray([sums[f"n{r}"] or 0 for r in range(1, K + 2)])
    keys, counts = top["w"].to_numpy().astype(np.int64).view(np.uint64), top["c"].to_numpy().astype(np.int64)
    return Words(keys, counts, sums["total"] or 0, sums["size"], sums["texts"] or 0, times, split_tokens)


def count_ngrams(train: DataFrame, words, parts: int, order: int) -> DataFrame:
    """The model: one row per part with its n-grams and counts, and how many pairs and threes came 1 .. K + 1 times."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory, own = WordHashes(), words.value
        for chunk in _chunks(batches):
            keys, u, v, w, _, _ = _ngrams(chunk["text"], memory, own, order)
            codes = own.codes(keys)
            _, first, n = np.unique(_alike(keys, u, v, w), return_index=True, return_counts=True)
            u, v, w = u[first], v[first], w[first]
            part = _dealt(keys, own, u, v, w, parts, order)
            groups = _grouped(part)
            blobs = [_encoded(keys, codes, [u[g], v[g], w[g]], [n[g]]) for g in groups]
            yield pa.record_batch({"part": pa.array([part[g[0]] for g in groups], pa.int64()), "ngrams": pa.array(blobs, pa.binary())})

    def add(batch: pd.DataFrame) -> pd.DataFrame:
        own = words.value
        keys, (u, v, w, n) = _decoded(batch["ngrams"], own, 1)
        _, first, where = np.unique(_alike(keys, u, v, w), return_index=True, return_inverse=True)
        n = np.bincount(where, weights=n).astype(np.int64)
        u, v, w = u[first], v[first], w[first]
        whole = (own.portions(keys, own.counts_at(keys)) == 1)[v]
        _, where = np.unique(v[whole] * len(keys) + w[whole], return_inverse=True)
        two = _seen_times(np.bincount(where, weights=n[whole]).astype(np.int64))
        three = _seen_times(n[(keys[v] != START) & (order == 3)])
        blob = _encoded(keys, own.codes(keys), [u, v, w], [n])
        part = batch["part"].iloc[0]
        return pd.DataFrame({"part": [part], "ngrams": [blob], "two": pd.Series([two], dtype=object), "three": pd.Series([three], dtype=object)})

    dealt = train.select("text").mapInArrow(deal, "part long, ngrams binary")
    return dealt.groupBy("part").applyInPandas(add, "part long, ngrams binary, two array<long>, three array<long>")


def _pairs_of(model: DataFrame, words) -> DataFrame:
    """(part, split, v, w, b, c): the parts' pairs with a split v, by hash b too; those of other v with a w that isn't hot."""

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = words.value
        for batch in batches:
            for part, blob in zip(batch["part"], batch["ngrams"]):
                keys, (_, v, w, n) = _decoded([blob], own, 1)
                counts = own.counts_at(keys)
                split = (own.portions(keys, counts) > 1)[v]
                wanted = split | (counts[w] == 0)
                split, v, w, n = split[wanted], v[wanted], w[wanted], n[wanted]
                _, first, where = np.unique(v * len(keys) + w, return_index=True, return_inverse=True)
                c = np.bincount(where, weights=n, minlength=len(first)).astype(np.int64)
                v, w = keys[v[first]], keys[w[first]]
                split = split[first]
                both = pd.arrays.IntegerArray(_pair(v, w).view(np.int64), ~split)
                yield pd.DataFrame({"part": part, "split": split, "v": v.view(np.int64), "w": w.view(np.int64), "b": both, "c": c})

    return model.select("part", "ngrams").mapInPandas(look, "part long, split boolean, v long, w long, b long, c long")


def _split_totals(pairs: DataFrame) -> DataFrame:
    """(part, v, w, b, c, first): a line for each part that has the pair, with the count in all parts; one of them is ``first``."""
    same = Window.partitionBy("v", "w")
    return pairs.select(
        "part", "v", "w", "b", F.sum("c").over(same).alias("c"), (F.col("part") == F.min("part").over(same)).alias("first")
    )


def _levels(model: DataFrame, split_pairs: DataFrame, listed: DataFrame, own: Words) -> Levels:
    """Discounts, and what belongs to the split contexts: a row for each, which are hot words or the start mark."""
    two, three = np.zeros(K + 1), np.zeros(K + 1)
    for name, held in (("two", two), ("three", three)):
        lines = model.select(F.posexplode(name).alias("r", "n")).groupBy("r").agg(F.sum("n").alias("n"))
        for row in lines.collect():
            held[row.r] += row.n
    counted = split_pairs.agg(*_times_of("c")).first()
    two += [counted[f"n{r}"] or 0 for r in range(1, K + 2)]
    two, three = discounts(two), discounts(three)
    known = split_pairs.join(listed.select("w", F.col("c").alias("cw")), "w")
    seen = (_discounted(F.col("cw"), own.d) / own.below).alias("seen")
    sums = known.select("v", "c", _discounted(F.col("c"), two).alias("mass"), seen).groupBy("v").agg(
        F.sum("mass").alias("mass"), F.sum("seen").alias("seen"), F.sum("c").alias("total"), F.min("c").alias("least")
    )
    found = sums.toArrow().to_pandas()
    order = np.argsort(found["v"].to_numpy(np.int64).view(np.uint64))
    found = found.iloc[order]
    below, weight = _backoff(found["mass"].to_numpy(float), found["total"].to_numpy(np.int64), found["least"].to_numpy(np.int64) <= K, found["seen"].to_numpy(float))
    return Levels(two, three, found["v"].to_numpy(np.int64).view(np.uint64), below, weight)


def _backoff(mass, total, small, seen):
    """Denominators and backoff weights of contexts from what their n-grams sum up to."""
    below = total + ~small
    return below, (1 - mass / below) / np.maximum(1 - seen, 1e-300)


class PartModel:
    """One part's n-grams with their probabilities, and its contexts with their backoff weights."""

    def __init__(self, counted: pd.DataFrame, own: Words, levels: Levels, order: int):
        keys, (u, v, w, n) = _decoded(counted.loc[counted["kind"] == 0, "ngrams"], own, 1)
        counts = own.counts_at(keys)
        # pairs: counts are whole where v isn't split, else they are looked up
        _, first, pair = np.unique(v * len(keys) + w, return_index=True, return_inverse=True)
        c = np.bincount(pair, weights=n, minlength=len(first)).astype(np.int64)
        pv, pw = v[first], w[first]
        hashed = _pair(keys[pv], keys[pw])
        by = np.argsort(hashed)
        self.pairs = hashed[by]
        whole = (own.portions(keys, counts) == 1)[pv]
        totals = counted[counted["kind"] == 1]
        at, known = _spots(self.pairs, totals["key"].to_numpy(np.int64).view(np.uint64))
        c[by[at[known]]] = totals["value"].to_numpy(float)[known].astype(np.int64)
        # contexts of one word
        seen = np.where(counts[pw] > 0, own.p(counts[pw]), 0.0)[whole]
        self.heads, head = np.unique(keys[pv[whole]], return_inverse=True)
        add = lambda x: np.bincount(head, weights=x, minlength=len(self.heads))
        shares = add(seen)
        rare = counted[counted["kind"] == 2]
        at, known = _spots(self.heads, rare["key"].to_numpy(np.int64).view(np.uint64))
        np.add.at(shares, at[known], rare["value"].to_numpy(float)[known])
        low = c[whole]
        below, self.head_weight = _backoff(add(discounted(low, levels.two)), add(low).astype(np.int64), add(low <= K) > 0, shares)
        under = np.ones(len(c))
        under[whole] = below[head]
        if not whole.all():
            under[~whole] = levels.below[_spots(levels.split, keys[pv[~whole]])[0]]
        p_pairs = discounted(c, levels.two) / under
        self.p_pairs = p_pairs[by]
        del first, c, pv, pw, hashed, by, whole, seen, head, add, low, under
        # three words
        long = (keys[v] != START) & (order == 3)
        u, v, w, n, p_pairs = u[long], v[long], w[long], n[long], p_pairs[pair[long]]
        del pair, long
        _, first, where = np.unique(v * len(keys) + u, return_index=True, return_inverse=True)
        add = lambda x: np.bincount(where, weights=x, minlength=len(first))
        mass = discounted(n, levels.three)
        below, weight = _backoff(add(mass), add(n).astype(np.int64), add(n <= K) > 0, add(p_pairs))
        contexts = _pair(keys[u[first]], keys[v[first]])
        del u, v, n, p_pairs, first
        threes, p_threes = _pair(contexts[where], keys[w]), mass / below[where]
        by = np.argsort(contexts)
        self.contexts, self.context_weight = contexts[by], weight[by]
        by = np.argsort(threes)
        self.threes, self.p_threes = threes[by], p_threes[by]


def _scored(model: PartModel, own: Words, order: int, keys, u, v, w):
    """log10 of what the part knows of each token; whether its pair must be looked up; its word; whether that isn't hot."""
    counts = own.counts_at(keys)
    split, rare = (own.portions(keys, counts) > 1)[v], counts[w] == 0
    logs, pair, word = np.zeros(len(w)), np.zeros(len(w), bool), np.zeros(len(w), bool)

    def found(rows, table, values, wanted):
        """Adds the logarithm of what the table holds; the rows that it doesn't hold."""
        at, known = _spots(table, wanted)
        logs[rows[known]] += np.log10(values[at[known]])
        return rows[~known]

    long = np.flatnonzero((keys[v] != START) & (order == 3))
    context = _pair(keys[u[long]], keys[v[long]])
    left = found(long, model.threes, model.p_threes, _pair(context, keys[w[long]]))
    found(left, model.contexts, model.context_weight, _pair(keys[u[left]], keys[v[left]]))
    left = np.union1d(left, np.flatnonzero((keys[v] == START) | (order == 2)))
    pair[left] = split[left]
    left = left[~split[left]]
    left = found(left, model.pairs, model.p_pairs, _pair(keys[v[left]], keys[w[left]]))
    found(left, model.heads, model.head_weight, keys[v[left]])
    word[left] = rare[left]
    left = left[~rare[left]]
    logs[left] += np.log10(own.p(counts[w[left]]))
    return logs, pair, word, rare


SUMS = "part long, base long, kind int, blob binary, at int, v long, w long, n long, back boolean, rare boolean"
_LINE = np.dtype(
    [("none", "?"), ("id", "<i8"), ("held", "?"), ("tokens", "<i8"), ("known", "<i8"), ("base", "<f8"), ("score", "<f8")]
)


def _runs(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Rows with about ``RUN_BYTES`` of blobs each."""
    ends = rows["blob"].str.len().to_numpy(np.int64).cumsum() // RUN_BYTES
    cuts = np.flatnonzero(np.diff(ends)) + 1
    for low, high in zip([0, *cuts], [*cuts, len(rows)]):
        if high > low:
            yield rows.iloc[low:high]


def _sent(part: int, base, kind: int, rows: int, blob=None, at=0, v=0, w=0, n=0, back=False, rare=False) -> pd.DataFrame:
    """Rows of ``SUMS``: a chunk's documents (0), its sums in one part (1), its tokens that need a look-up (2)."""
    columns = {"part": part, "base": base, "kind": kind, "blob": blob, "at": at, "v": v, "w": w, "n": n, "back": back, "rare": rare}
    made = pd.DataFrame(columns, index=range(rows))
    return made.astype({"blob": object, "v": "Int64", "back": bool, "rare": bool})


def _looked_up(rows: DataFrame, listed: DataFrame, split_pairs: DataFrame, own: Words, levels: Levels) -> DataFrame:
    """(chunk, at, base_sum, known, score): what tokens add that the parts couldn't score alone."""
    spark = rows.sparkSession
    counts = listed.select("w", F.col("c").alias("cw"))
    signed = levels.split.view(np.int64).tolist()
    heads = spark.createDataFrame(
        list(zip(signed, levels.below.astype(float).tolist(), np.log10(levels.weight).tolist())), "v long, below double, weight double"
    )
    single = F.log10(F.when(F.col("cw").isNull(), own.rest).otherwise(_discounted(F.col("cw"), own.d) / own.below))
    plain = rows.where(F.col("v").isNull()).join(counts, "w", "left").withColumn("log", single)
    paired = rows.where(F.col("v").isNotNull()).join(counts, "w", "left")
    paired = paired.join(split_pairs.select("v", "w", "c"), ["v", "w"], "left").join(F.broadcast(heads), "v", "left")
    pair = F.log10(_discounted(F.col("c"), levels.two) / F.col("below"))
    paired = paired.withColumn("log", F.when(F.col("c").isNotNull(), pair).otherwise(F.coalesce("weight", F.lit(0.0)) + single))
    columns = ["base", "at", "n", "back", "rare", "cw", "log"]
    both = plain.select(columns).union(paired.select(columns))
    unit = F.log10((F.coalesce("cw", F.lit(0)) + 1) / float(own.total + own.size + 1))
    return both.groupBy(F.col("base").alias("chunk"), "at").agg(
        F.sum(F.when(F.col("rare"), F.col("n") * unit).otherwise(0.0)).alias("base_sum"),
        F.sum(F.when(F.col("rare") & F.col("cw").isNotNull(), F.col("n")).otherwise(0)).alias("known"),
        F.sum(F.when(F.col("back"), F.col("n") * F.col("log")).otherwise(0.0)).alias("score"),
    )


def score(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    order: int = 3,
    hot: int = HOT,
    split_tokens: int = SPLIT_TOKENS,
    part_tokens: int = PART_TOKENS,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document.

    ``hot`` (at most ``HOT``), ``split_tokens`` and ``part_tokens`` change how the work is dealt, not the scores.
    """
    if order not in (2, 3):
        raise ValueError("order must be 2 or 3")
    spark = docs.sparkSession
    source = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    source = source.withColumn("held_out", remainder("doc_id", 7) == 2)
    train = source.where(~F.col("held_out"))
    listed = stored(count_words(train), "word-counts")
    held = word_model(listed, hot, split_tokens)
    parts = max(8, -(-held.total // part_tokens))
    words = spark.sparkContext.broadcast(held)
    model = stored(count_ngrams(train, words, parts, order), "ngram-counts")
    pairs = stored(_pairs_of(model, words), "pairs")
    by_part = stored(_split_totals(pairs.where("split")), "split-pairs")
    split_pairs = by_part.where("first").select("v", "w", "b", "c")
    levels = _levels(model, split_pairs, listed, held)
    shared = spark.sparkContext.broadcast(levels)

    rare = pairs.where(~F.col("split")).join(listed.select("w", F.col("c").alias("cw")), "w")
    single = _discounted(F.col("cw"), held.d) / held.below
    rare = rare.select("part", "v", single.alias("p")).groupBy("part", "v").agg(F.sum("p").alias("value"))
    none = F.lit(None).cast("binary").alias("ngrams")
    counted = model.select("part", F.lit(0).alias("kind"), "ngrams", F.lit(0).cast("long").alias("key"), F.lit(0.0).alias("value"))
    counted = counted.union(by_part.select("part", F.lit(1), none, "b", F.col("c").cast("double")))
    counted = counted.union(rare.select("part", F.lit(2), none, "v", "value"))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory, own = WordHashes(), words.value
        for chunk in _chunks(batches):
            keys, u, v, w, at, sizes = _ngrams(chunk["text"], memory, own, order)
            codes, c = own.codes(keys), own.counts_of(keys)
            unit = np.where(c > 0, np.log10((c + 1) / (own.total + own.size + 1)), 0.0)
            ids = chunk["doc_id"]
            lines = [ids.isna(), ids.fillna(0).astype(np.int64), chunk["held_out"], sizes]
            lines += [np.bincount(at, (c > 0)[w], len(sizes)), np.bincount(at, unit[w], len(sizes)), np.zeros(len(sizes))]
            body = np.rec.fromarrays(lines, dtype=_LINE).tobytes()
            alike = _alike(keys, u, v, w)
            by = np.lexsort((alike, at))
            new = np.append(True, (np.diff(alike[by]) != 0) | (np.diff(at[by]) != 0))
            n = np.diff(np.append(np.flatnonzero(new), len(by)))
            by = by[new]
            u, v, w, at = u[by], v[by], w[by], at[by]
            part = _dealt(keys, own, u, v, w, parts, order)
            groups = _grouped(part)
            base = int(chunk["rid"].iloc[0])
            blobs = [_encoded(keys, codes, [u[g], v[g], w[g]], [at[g], n[g]]) for g in groups]
            yield pa.record_batch(
                {
                    "part": pa.array([base % parts, *(part[g[0]] for g in groups)], pa.int64()),
                    "base": pa.array([base] * (len(groups) + 1), pa.int64()),
                    "kind": pa.array([0, *(1 for _ in groups)], pa.int32()),
                    "blob": pa.array([zstandard.compress(body, 1), *blobs], pa.binary()),
                }
            )

    def meet(tokens: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        own = words.value
        known = PartModel(counts, own, shared.value, order)
        lines = tokens[tokens["kind"] == 0]
        found = [_sent(lines["part"].to_numpy(), lines["base"].to_numpy(), 0, len(lines), blob=lines["blob"].tolist())]
        for run in _runs(tokens[tokens["kind"] == 1]):
            part, bases = run["part"].iloc[0], run["base"].to_numpy()
            keys, (u, v, w, at, n, which) = _decoded(run["blob"], own, 2)
            logs, pair, word, rare = _scored(known, own, order, keys, u, v, w)
            # texts of all chunks in the run, in order
            texts, where = np.unique((which << 32) | at, return_inverse=True)
            sums, of = np.bincount(where, logs * n), texts >> 32
            cuts = np.searchsorted(of, np.arange(len(bases) + 1))
            bodies = [
                (texts[low:high] & 0xFFFFFFFF).astype("<u4").tobytes() + sums[low:high].astype("<f8").tobytes()
                for low, high in zip(cuts, cuts[1:])
            ]
            found.append(_sent(part, bases, 1, len(bases), blob=[zstandard.compress(body, 1) for body in bodies]))
            left = pair | word | rare
            heads = pd.arrays.IntegerArray(keys[v[left]].view(np.int64), ~pair[left])
            last, back = keys[w[left]].view(np.int64), (pair | word)[left]
            found.append(
                _sent(part, bases[which[left]], 2, len(last), at=at[left], v=heads, w=last, n=n[left], back=back, rare=rare[left])
            )
        return pd.concat(found, ignore_index=True)

    train_tokens = held.total

    def gather(group: pd.DataFrame, more: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["kind", "part"])
        lines = np.frombuffer(zstandard.decompress(group["blob"].iloc[0]), _LINE)
        total, base, known = lines["score"].copy(), lines["base"].copy(), lines["known"].copy()
        for blob in group["blob"].iloc[1:]:
            raw = zstandard.decompress(blob)
            n = len(raw) // 12
            total[np.frombuffer(raw[: 4 * n], "<u4")] += np.frombuffer(raw[4 * n :], "<f8")
        at = more["at"].to_numpy(np.int64)
        total[at] += more["score"].to_numpy(float)
        base[at] += more["base_sum"].to_numpy(float)
        known[at] += more["known"].to_numpy(np.int64)
        ids = pd.array(lines["id"], dtype="Int64")
        ids[lines["none"]] = pd.NA
        return pd.DataFrame(
            {
                "doc_id": ids,
                "held_out": lines["held"],
                "n_tokens": lines["tokens"],
                "n_known": known,
                "train_tokens": np.int64(train_tokens),
                "base_score": base,
                "score": total,
            }
        )

    numbered = source.withColumn("rid", F.monotonically_increasing_id())
    dealt = numbered.mapInArrow(deal, "part long, base long, kind int, blob binary")
    met = stored(dealt.groupBy("part").cogroup(counted.groupBy("part")).applyInPandas(meet, SUMS), "token-sums")
    more = _looked_up(met.where(F.col("kind") == 2), listed, split_pairs, held, levels)
    shape = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    known = met.where(F.col("kind") < 2).select("part", "base", "kind", "blob")
    return known.groupBy("base").cogroup(more.groupBy("chunk")).applyInPandas(gather, shape)
