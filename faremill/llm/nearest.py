"""Nearest vectors by a block matrix join: int8 tiles, error bounds, exact scores, merged by heaps.

1. Queries and candidates are dealt to blocks of bounded size, by hash. The tile (query block, candidate
   block) is one group of a cogroup: each row is copied once for every block of the other side, so no
   task holds more than two blocks, whatever the table's size, and nothing is broadcast.
2. In a tile every vector becomes int8 codes and a scale. The product of the codes is exact (sums of
   products of small integers fit into a float's mantissa), and differs from the inner product by no more
   than the lengths of what rounding took away allow: ``q.c - q'.c' = q.(c - c') + (q - q').c'``.
3. A candidate survives if its upper bound reaches the score that the query's k-th best has at least;
   survivors are scored again in double precision on the original numbers, in the order of dimensions.
   Candidates come in strips of like length, longest first, so the bounds stay tight for vectors of
   any lengths.
4. Every tile returns at most k rows a query; heaps of size k merge them.

The result is exact: a pair is only left out where the bound proves that k others are nearer.

Defined results: rows whose vector is null, empty, zero, or holds a null or non-finite component take no
part; vectors of another number of dimensions aren't candidates of a query; a null id is never a query,
but a candidate, last among ties; repeated ids and rows are each rows of their own: every one of them is
a query with its own result, and a candidate of the others; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.llm.common import stored

K, ONE_IN = 20, 20
#: Candidates and queries of a block, and candidates that are scored at once.
BLOCK, QUERIES, STRIP = 16384, 2048, 2048
#: Sums of ``dims`` products of codes up to 127 are exact in single precision below this.
EXACT_DIMS = 2**24 // 127**2
NEAR = "query_row long, query_id long, known boolean, vec_id long, score double"


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """row, vec_id, known (whether it has an id) and the components of the vectors that take part."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    taken = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector"))
    fit = F.exists("vector", lambda x: x != 0) & ~F.exists("vector", bad)
    rows = taken.where(F.coalesce(fit, F.lit(False))).withColumn("row", F.monotonically_increasing_id())
    # pandas would make floats of integers beside a null
    return rows.withColumns({"known": F.col("vec_id").isNotNull(), "vec_id": F.coalesce("vec_id", F.lit(0).cast("long"))})


# --- one tile ---------------------------------------------------------------------------


class Codes:
    """int8 codes of vectors with scales, and bounds on what rounding took away.

    Codes are kept as floats of whole value, since only these multiply by BLAS.
    """

    def __init__(self, vectors: np.ndarray):
        top = np.abs(vectors).max(1)
        self.scale = np.maximum(top / 127.0, np.finfo(float).tiny)
        whole = np.rint(vectors / self.scale[:, None]).clip(-127, 127)
        kept = whole * self.scale[:, None]
        self.codes = whole.astype(np.int8).astype(np.float32 if vectors.shape[1] <= EXACT_DIMS else np.float64)
        self.length = np.sqrt((vectors**2).sum(1))
        self.kept = np.sqrt((kept**2).sum(1))
        self.lost = np.sqrt(((vectors - kept) ** 2).sum(1))


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of paired rows in double precision, added in the order of dimensions."""
    total = np.zeros(len(a))
    for d in range(a.shape[1]):
        total += a[:, d] * b[:, d]
    return total


class Best:
    """The k best candidates of every query so far, nearest first."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.query, self.candidate, self.score = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        self.floor = np.full(queries, -np.inf)

    def add(self, query: np.ndarray, candidate: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        query, candidate = np.r_[self.query, query], np.r_[self.candidate, candidate]
        score = np.r_[self.score, score]
        order = np.lexsort((ids[candidate], -score, query))
        query, candidate, score = query[order], candidate[order], score[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        kept = place < self.k
        self.query, self.candidate, self.score = query[kept], candidate[kept], score[kept]
        last = place == self.k - 1
        self.floor[query[last]] = score[last]


def search_tile(q: np.ndarray, q_rows: np.ndarray, c: np.ndarray, c_rows: np.ndarray, ids: np.ndarray, k: int) -> Best:
    """The k nearest candidates of every query in a tile; ``ids`` order ties."""
    best = Best(len(q), k)
    mine = Codes(q)
    longest_first = np.argsort(-np.sqrt((c**2).sum(1)), kind="stable")
    for start in range(0, len(c), STRIP):
        strip = longest_first[start : start + STRIP]
        theirs = Codes(c[strip])
        guess = (mine.codes @ theirs.codes.T) * theirs.scale.astype(mine.codes.dtype)[None, :]
        guess *= mine.scale.astype(guess.dtype)[:, None]
        # the last term covers the rounding of the two scalings
        reach = mine.length * theirs.lost.max() + mine.lost * theirs.kept.max()
        reach = reach * (1 + 1e-9) + 1e-6 * mine.length * theirs.length.max() + 1e-30
        floor = best.floor.copy()
        open_ = np.flatnonzero(np.isneginf(floor))
        if len(open_) and len(strip) > k:
            # one more than k, as one of them may be the query's own row
            at = len(strip) - k - 1
            floor[open_] = np.partition(guess[open_], at, axis=1)[:, at] - reach[open_]
        rows, columns = np.nonzero(guess >= (floor - reach)[:, None])
        others = q_rows[rows] != c_rows[strip[columns]]
        rows, columns = rows[others], strip[columns[others]]
        best.add(rows, columns, exact(q[rows], c[columns]), ids)
    return best


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in vectors])


def _tile(k: int):
    def search(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(candidates):
            return pd.DataFrame({c.split()[0]: [] for c in NEAR.split(", ")})
        known, names = candidates["known"].to_numpy(bool), candidates["vec_id"].to_numpy()
        ids = np.empty(len(names), np.int64)  # places by id, those without one last
        ids[np.lexsort((names, ~known))] = np.arange(len(names))
        q_rows, c_rows = queries["row"].to_numpy(), candidates["row"].to_numpy()
        best = search_tile(_matrix(queries["vector"]), q_rows, _matrix(candidates["vector"]), c_rows, ids, k)
        return pd.DataFrame(
            {
                "query_row": q_rows[best.query],
                "query_id": queries["vec_id"].to_numpy()[best.query],
                "known": known[best.candidate],
                "vec_id": names[best.candidate],
                "score": best.score,
            }
        )

    return search


# --- tiles of the whole matrix ----------------------------------------------------------


def _merge(k: int):
    """One heap of size k a query over all its lines of the partition."""

    def merge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        heaps: dict[tuple[int, int], list] = {}
        for frame in frames:
            lines = zip(*(frame[c].tolist() for c in ("query_row", "query_id", "score", "known", "vec_id")))
            for row, query, score, has, vec_id in lines:
                heap = heaps.setdefault((row, query), [])
                entry = (score, has, -vec_id)  # the worst is the root: lowest score, null, largest id
                if len(heap) < k:
                    heapq.heappush(heap, entry)
                elif entry > heap[0]:
                    heapq.heapreplace(heap, entry)
        for (_, query), heap in heaps.items():
            ranked = sorted(heap, reverse=True)
            yield pd.DataFrame(
                {
                    "query_id": query,
                    "rank": np.arange(1, len(ranked) + 1, dtype=np.int32),
                    "known": [has for _, has, _ in ranked],
                    "vec_id": [-v for _, _, v in ranked],
                    "score": [score for score, _, _ in ranked],
                }
            )

    return merge


def nearest(
    vectors: DataFrame,
    k: int = K,
    one_in: int = ONE_IN,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    block: int = BLOCK,
    queries: int = QUERIES,
) -> DataFrame:
    """query_id, rank, vec_id and score: the ``k`` rows of largest inner product of each query.

    Queries are the rows whose id is divisible by ``one_in``; ``block`` and ``queries`` are the rows that
    a tile holds of either side.
    """
    rows = stored(usable(vectors, vec_id, vector), "vectors")
    asked = F.col("known") & (F.col("vec_id") % one_in == 0)
    counts = rows.agg(F.count("*").alias("n"), F.count_if(asked).alias("q")).first()
    across, down = max(1, math.ceil(counts["n"] / block)), max(1, math.ceil(counts["q"] / queries))

    def dealt(side: DataFrame, own: str, count: int, other: str, others: int) -> DataFrame:
        home = F.pmod(F.xxhash64("row"), F.lit(count)).cast("int")
        spread = side.withColumn(own, home).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))
        return spread.withColumn("dims", F.size("vector")).groupBy("dims", "down", "across")

    asking = dealt(rows.where(asked), "down", down, "across", across)
    offered = dealt(rows, "across", across, "down", down)
    lines = asking.cogroup(offered).applyInPandas(_tile(k), NEAR)
    shape = "query_id long, rank int, known boolean, vec_id long, score double"
    merged = lines.repartition("query_row").mapInPandas(_merge(k), shape)
    return merged.select("query_id", "rank", F.when(F.col("known"), F.col("vec_id")).alias("vec_id"), "score")


def nearest_sql() -> str:
    """The result over ``embeddings``, every pair compared."""
    fit = "len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0"
    pairs = "list_zip(q.v, c.v)"
    return f"""
WITH vectors AS (
  SELECT row_number() OVER () AS r, vec_id, v FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)
  WHERE {fit}
),
scored AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id,
    list_reduce(list_prepend(0e0, list_transform({pairs}, lambda p: p[1] * p[2])), lambda a, b: a + b) AS score
  FROM vectors q JOIN vectors c ON q.r <> c.r AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM scored
) WHERE rank <= 20"""
