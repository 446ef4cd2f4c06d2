"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

Features of a text: how dense its words are in a lexicon and in a list of word beginnings, how
close a second person stands to such a word, and the rates of capitals, punctuation and
obfuscated spelling. Lexicon and beginnings are learned from labelled texts by smoothed log-odds
of document counts, beside a small list of given words. Parts of the labelled rows, by checksum of
their id, serve different ends: lexicon from two of them, trees from these and a third, calibration from
a fourth that neither has seen.

Learning takes at most about ``max_rows`` labelled rows, drawn by hash of the id (a documented
bound; Spark ML fits the trees on them); scoring covers every row. Features are made by an Arrow
UDF from the text alone; trees and calibration run in the JVM. Nothing is shuffled for scoring.

Defined results: a null or empty text has zeros for features and gets the score that these get;
texts are read whole; equal texts score alike; rows without a label don't train; an id with
several labels trains with the highest; without any usable label of both kinds the given lexicon alone
decides, as the share ``1 - 2**-hits``; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faremill.llm.common import each_text, fresh, remainder, stored, text_of

MAX_ROWS = 40_000
MAX_LEXICON = 2_000
BEGINNINGS = (4, 5, 6, 7)

# fixed values: words that insult, and pronouns of the second person, in the corpus languages
GIVEN = [
    "idiot", "moron", "stupid", "loser", "scum", "trash", "worthless", "pathetic", "disgusting",
    "clown", "dumb", "fool", "filth", "vermin", "garbage", "imbecile", "retard", "bastard",
    "dummkopf", "abschaum", "dreck", "trottel", "connard", "ordure", "imbécile", "basura", "imbécil",
]
SECOND_PERSON = [
    "you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "ihr", "euch",
    "tu", "toi", "vous", "ton", "votre", "tú", "ti", "usted", "ustedes", "vosotros",
]
# fixed values: characters that stand for letters in obfuscated spelling
STANDS_FOR = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})

FEATURES = (
    "hits_share", "hits_log", "hit_top", "hit_sum", "start_share", "start_log", "start_top",
    "second_near", "second_share", "capital_share", "shout_share", "exclaim", "question",
    "punctuation", "obfuscated", "elongated", "hidden_hits",
)

_WORD = re.compile(r"\w+")
_MIXED = re.compile(r"[0-9@$!*]+(?=[^\W\d_])")
_CAPITAL = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_SHOUT = re.compile(r"[A-ZÀ-ÖØ-Þ]{2,}")
_BLANK = re.compile(r"\s")
_SPACED = re.compile(r"(?<!\w)(?:[^\W\d_][ .\-_*]){2,}[^\W\d_](?!\w)")


@dataclass(frozen=True)
class Lexicon:
    """Weights of words and of word beginnings (log-odds); bounded by ``MAX_LEXICON`` entries each."""

    words: dict[str, float]
    starts: dict[str, float]


class _Weights(dict):
    """(weight of the word, weight of its beginning) by word, remembered for up to ``most`` words."""

    def __init__(self, lexicon: Lexicon, most: int = 200_000):
        super().__init__()
        self.lexicon, self.most = lexicon, most

    def __missing__(self, word: str) -> tuple[float, float]:
        if len(self) >= self.most:
            self.clear()
        start = self.lexicon.starts.get
        found = self.lexicon.words.get(word, 0.0), max(start(word[:k], 0.0) for k in BEGINNINGS)
        self[word] = found = found if any(found) else _NOTHING
        return found


_NOTHING = (0.0, 0.0)
_SECOND = frozenset(SECOND_PERSON)


def _mixed_words(lower: str) -> list[str]:
    """Words with a digit or sign between two letters."""
    words, end = [], 0
    for found in _MIXED.finditer(lower):
        if found.start() >= max(end, 1) and lower[found.start() - 1].isalpha():
            after = _BLANK.search(lower, found.end())
            end = after.start() if after else len(lower)
            begin = max(lower.rfind(blank, 0, found.start()) for blank in " \n\t") + 1
            words.append(lower[begin:end])
    return words


def _elongated(lower: str) -> int:
    """Places where a letter comes three times running."""
    codes = np.frombuffer(lower.encode("utf-32-le", "surrogatepass"), np.uint32)
    same = codes[1:] == codes[:-1]
    return sum(lower[i].isalpha() for i in np.flatnonzero(same[1:] & same[:-1]))


def features(text: str, weights: _Weights) -> list[float]:
    """The dense features of one text, in the order of ``FEATURES``."""
    lower = text.lower()
    tokens = _WORD.findall(lower)
    if not tokens:
        return [0.0] * len(FEATURES)
    n = len(tokens)
    heavy = [(i, w) for i, w in enumerate([weights[t] for t in tokens]) if w is not _NOTHING]
    hits = [(i, w) for i, (w, _) in heavy if w]
    starts = [s for _, (_, s) in heavy if s]
    second = [i for i, t in enumerate(tokens) if t in _SECOND]
    near = 0.0
    if second and hits:
        places = np.asarray(second)
        spots = np.asarray([i for i, _ in hits])
        after = np.searchsorted(places, spots).clip(0, len(places) - 1)
        gap = np.minimum(np.abs(places[after] - spots), np.abs(places[(after - 1).clip(0)] - spots)).min()
        near = 1.0 / (1.0 + float(gap))
    mixed = _mixed_words(lower)
    spaced = ["".join(_WORD.findall(x)) for x in _SPACED.findall(lower)] if list(map(len, tokens)).count(1) > 2 else []
    plain = [x.translate(STANDS_FOR).replace("*", "") for x in mixed] + spaced
    hidden = sum(1 for x in plain for w in _WORD.findall(x)[:1] if weights[w][0])
    return [
        len(hits) / n,
        float(np.log1p(len(hits))),
        max((w for _, w in hits), default=0.0),
        sum(w for _, w in hits),
        len(starts) / n,
        float(np.log1p(len(starts))),
        max(starts, default=0.0),
        near,
        len(second) / n,
        len(_CAPITAL.findall(text)) / sum(map(len, tokens)),
        len(_SHOUT.findall(text)) / n,
        text.count("!") / n,
        text.count("?") / n,
        sum(map(text.count, ".,;:!?")) / n,
        len(plain) / n,
        _elongated(lower) / n,
        float(np.log1p(hidden)),
    ]


def feature_column(text: Column, lexicon: Lexicon) -> Column:
    """The features as an ML vector."""

    @F.arrow_udf("array<double>")
    def make(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weights = _Weights(lexicon)
        for batch in batches:
            made = np.empty((len(batch), len(FEATURES)))
            for row, t in enumerate(each_text(batch)):
                made[row] = features(t, weights)
            ends = np.arange(len(batch) + 1, dtype=np.int32) * len(FEATURES)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(made.ravel()))

    return array_to_vector(make(text))


def learn_lexicon(labelled: DataFrame, least: int = 4, odds: float = 2.0, deviations: float = 5.0) -> Lexicon:
    """Words and beginnings by smoothed log-odds of the number of toxic and other texts with them.

    A term must lie ``deviations`` binomial deviations above the share of toxic texts. One line per
    word is counted on the cluster; the heaviest ``MAX_LEXICON`` of each kind come back.
    """
    sides = {row.toxic: row.n for row in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    tokens = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}]+"), 0))
    words = labelled.select("toxic", F.explode(tokens).alias("term"), F.lit(0).alias("kind"))
    cut = F.array_distinct(
        F.flatten(
            F.array(
                *[
                    F.transform(F.filter(tokens, lambda t, k=k: F.length(t) >= k), lambda t, k=k: F.substring(t, 1, k))
                    for k in BEGINNINGS
                ]
            )
        )
    )
    starts = labelled.select("toxic", F.explode(cut).alias("term"), F.lit(1).alias("kind"))
    toxic, other = sides.get(1, 0), sides.get(0, 0)
    base = toxic / max(toxic + other, 1)
    texts = F.col("bad") + F.col("good")
    counted = (
        words.union(starts)
        .groupBy("kind", "term")
        .agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
        .where(F.col("bad") >= least)
        .withColumn(
            "weight",
            F.log((F.col("bad") + 0.5) / F.lit(toxic + 1.0)) - F.log((F.col("good") + 0.5) / F.lit(other + 1.0)),
        )
        .where(F.col("weight") > odds)
        .where(F.col("bad") - texts * base >= deviations * F.sqrt(texts * base * (1 - base)))
    )
    learned: tuple[dict, dict] = ({}, {})
    for kind in (0, 1):
        top = counted.where(F.col("kind") == kind).orderBy(F.desc("weight"), "term").limit(MAX_LEXICON)
        learned[kind].update({row.term: row.weight for row in top.collect()})
    return Lexicon({**dict.fromkeys(GIVEN, odds + 1), **learned[0]}, learned[1])


@dataclass(frozen=True)
class ToxicityModel:
    lexicon: Lexicon
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None

    def score(self, df: DataFrame, text: str = "text", output: str = "score") -> DataFrame:
        """The frame with a calibrated probability in ``output``."""
        vector, raw, flat = (fresh(df, f"__{name}") for name in ("features", "margin", "probability"))
        own = [c for c in df.columns if c.lower() != output.lower()]
        made = df.withColumn(vector, feature_column(text_of(text), self.lexicon))
        if self.trees is None or self.calibration is None:
            hits = vector_to_array(vector)[FEATURES.index("hits_log")]
            return made.select(*own, (1 - F.pow(F.lit(2.0), 1 - F.exp(hits))).alias(output))
        trees = self.trees.copy().setFeaturesCol(vector).setPredictionCol("").setRawPredictionCol("")
        found = trees.setProbabilityCol(raw).transform(made).withColumn(flat, vector_to_array(raw)[1])
        out = fresh(df, "__calibrated")
        fitted = self.calibration.copy().setFeaturesCol(flat).setPredictionCol(out).transform(found)
        return fitted.select(*own, F.least(F.greatest(F.col(out), F.lit(0.0)), F.lit(1.0)).alias(output))


def labelled_texts(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """Labelled rows that may be learned from: remainder modulo 5 isn't 0; about ``max_rows`` at most."""
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (remainder("doc_id", 5) != 0))
    one = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    share = min(1.0, max_rows / max(one.count(), 1))
    drawn = one.where(F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    texts = docs.select("doc_id", text_of("text").alias("text"))
    # about ``max_rows`` short rows at most, whatever the corpus; texts stay where they are
    return texts.join(F.broadcast(drawn), "doc_id").withColumn("part", remainder("doc_id", 5))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, seed: int = 5) -> ToxicityModel:
    """Lexicon from remainders 1 and 2, trees from 1 to 3, calibration from 4 (crc32 of the id modulo 5)."""
    known = stored(labelled_texts(docs, labels, max_rows), "labelled-texts")
    lexicon = learn_lexicon(known.where(F.col("part").isin(1, 2)))
    rows = known.select(
        (F.col("part") == 4).alias("held"), F.col("toxic").cast("double").alias("label"), feature_column(F.col("text"), lexicon).alias("features")
    )
    rows = stored(rows, "toxicity-features")
    sides = {(r.held, r.label) for r in rows.select("held", "label").distinct().collect()}
    if len(sides) < 4:
        return ToxicityModel(lexicon, None, None)
    booster = GBTClassifier(maxIter=16, maxDepth=3, maxBins=32, stepSize=0.3, seed=seed, minInstancesPerNode=4)
    # a handful of small tasks: the rows are bounded
    trees = booster.fit(rows.where(~F.col("held")).coalesce(4))
    margins = trees.transform(rows.where("held")).select(
        "label", vector_to_array("probability")[1].alias("p"), F.lit(1.0).alias("weight")
    )
    ends = docs.sparkSession.createDataFrame([(0.0, 0.0, 1.0), (1.0, 1.0, 1.0)], "label double, p double, weight double")
    isotonic = IsotonicRegression(featuresCol="p", labelCol="label", weightCol="weight")
    return ToxicityModel(lexicon, trees, isotonic.fit(margins.union(ends).coalesce(1)))


def score_documents(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """Every document's calibrated toxicity, and the class at one half."""
    model = fit(docs, labels, max_rows)
    scored = model.score(docs.select("doc_id", "text"))
    return scored.select(
        "doc_id",
        (remainder("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """The documents that score below one half, with their own columns."""
    score = fresh(docs, "__toxicity")
    scored = fit(docs, labels, max_rows).score(docs, output=score)
    return scored.where(F.col(score) < 0.5).drop(score)
