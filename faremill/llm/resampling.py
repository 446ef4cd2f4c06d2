"""Importance resampling: keep texts that a model of good text explains better than a model of all text.

Both models are bags of hashed word n-grams (one and two words) over a fixed number of buckets, with
add-one smoothing. A text's log weight is the sum over its n-grams of the log ratio of the two. Gumbel
noise, drawn from a hash of id, text and seed, is added and the top k are taken, which samples without
replacement in proportion to the weights and gives the same rows wherever a task is run again.

The model of all text counts every document. The target model counts the documents labelled good, drawn
by hash to about ``TARGET_ROWS`` rows at most (a documented bound). Counts per bucket are summed in each
task first. The k-th largest key is found by counting keys per bucket of their sortable bits, four times
16 bits, so no task sorts or collects the ranking.

Defined results: a null or empty text has no n-grams and weight 0; texts are read whole; repeated rows get
equal keys; where ties or equal rows meet at the threshold all of them are taken; without labelled
texts the target is uniform; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faremill.llm.common import stored, text_of

BUCKETS = 10_000
TARGET_ROWS = 40_000
_TOKEN = re.compile(r"\w+|[^\w\s]+")


class _Codes(dict):
    """Hashes of tokens, remembered for up to 100,000 tokens."""

    def __missing__(self, token: str) -> int:
        if len(self) >= 100_000:
            self.clear()
        self[token] = value = crc32(token.encode("utf-8", "surrogatepass"))
        return value


def buckets_of(text: str, codes: _Codes, buckets: int) -> np.ndarray:
    """The bucket of each word and of each pair of neighbours."""
    h = np.fromiter([codes[t] for t in _TOKEN.findall(text.lower())], np.uint64)
    if not len(h):
        return np.empty(0, np.int64)
    pairs = (h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]) >> np.uint64(20)
    return np.concatenate([h % np.uint64(buckets), pairs % np.uint64(buckets)]).astype(np.int64)


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """n-grams per bucket over all texts; a task adds up its own before anything is shuffled."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes, total = _Codes(), np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch["text"]:
                total += np.bincount(buckets_of(text, codes, buckets), minlength=buckets)
        where = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": where, "n": total[where]})

    counted = texts.mapInPandas(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    result = np.zeros(buckets, np.int64)
    for row in counted.collect():  # at most ``buckets`` lines
        result[row.bucket] = row.n
    return result


def kth_largest(keys: DataFrame, column: str, k: int) -> float | None:
    """The k-th largest value of a double column, exactly; null where there are fewer values."""
    bits = F.expr(f"cast(`{column}` as double)")
    # doubles scaled to whole numbers keep their order; 2**20 steps to one
    whole = F.floor(bits * float(1 << 20)).cast("long")
    ranked = keys.select((whole + F.lit(1 << 62)).alias("v"))
    prefix, need = 0, k
    for shift in (48, 32, 16, 0):
        inside = ranked if shift == 48 else ranked.where(F.shiftright("v", shift + 16) == prefix)
        part = inside.select(F.shiftright("v", shift).alias("p"))
        counts = sorted(((r.p, r["count"]) for r in part.groupBy("p").count().collect()), reverse=True)
        for value, n in counts:
            if n >= need:
                prefix = value
                break
            need -= n
        else:
            return None
    return (prefix - (1 << 62)) / float(1 << 20)


def resample(
    docs: DataFrame,
    labels: DataFrame,
    share: float | None = None,
    buckets: int = BUCKETS,
    target_rows: int = TARGET_ROWS,
    seed: int = 17,
) -> DataFrame:
    """doc_id, n_grams, log_weight, gumbel_key and whether the document is among the top k (``kept``).

    k is ``share`` of all documents or, without it, the number of texts that the target model explains at
    least as well as the model of all texts.
    """
    texts = docs.select("doc_id", text_of("text").alias("text"))
    good = labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    part = min(1.0, target_rows / max(good.count(), 1))
    drawn = good.where(F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1_000_000)) < int(part * 1_000_000))
    # about ``target_rows`` ids at most, whatever the corpus
    target = bucket_counts(texts.join(F.broadcast(drawn), "doc_id", "left_semi"), buckets) + 1.0
    raw = bucket_counts(texts, buckets) + 1.0
    ratio = np.log(target / target.sum()) - np.log(raw / raw.sum())

    def weigh(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codes = _Codes()
        for batch in batches:
            held = [buckets_of(text, codes, buckets) for text in batch]
            yield pd.DataFrame({"n": [len(h) for h in held], "w": [float(ratio[h].sum()) for h in held]})

    shape = T.StructType([T.StructField("n", T.LongType()), T.StructField("w", T.DoubleType())])
    weigher = F.pandas_udf(weigh, shape)
    unit = (F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    keyed = texts.select("doc_id", unit.alias("u"), weigher("text").alias("s")).select(
        "doc_id",
        F.col("s.n").alias("n_grams"),
        F.col("s.w").alias("log_weight"),
        (F.col("s.w") - F.log(-F.log("u"))).alias("gumbel_key"),
    )
    keyed = stored(keyed, "gumbel-keys")
    counts = keyed.agg(F.count("*").alias("n"), F.count_if(F.col("log_weight") >= 0).alias("fit")).first()
    k = counts.fit if share is None else int(np.ceil(share * counts.n))
    bar = kth_largest(keyed, "gumbel_key", k) if k else None
    chosen = F.lit(False) if bar is None else F.floor(F.col("gumbel_key") * float(1 << 20)) >= int(bar * (1 << 20))
    return keyed.withColumn("kept", chosen)
