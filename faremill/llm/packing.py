"""Packing documents into token sequences by cutting-stock patterns.

A document's ids, with the end id, are cut at multiples of the sequence length. Pieces are counted
by length class (classes of ``step`` ids), a linear program over that histogram finds patterns of
classes that fill a sequence (``cutting_stock``), and the rounded patterns are dealt to the pieces
of each class by rank. Rounding a length up to its class costs up to ``step - 1`` ids a piece.

Only the histogram (length classes x rank blocks, a fixed number of lines) reaches the driver. Ranks
are counted inside blocks of a class, so a length that a third of all documents share is split over
``BLOCKS`` tasks. Texts never move: the one shuffle of pieces and the one of sequences carry numbers.

Defined results: a null or empty text is its end id alone; a text of any length is cut into as many
pieces as it needs; equal rows give equal pieces in places of their own; a null id is kept; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import cache
from itertools import accumulate
from unicodedata import is_normalized

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from faremill.llm.common import each_text, stored, text_of
from faremill.llm.cutting_stock import cut

LENGTH = 2048
STEP = 8
BLOCKS = 256
END_ID = 1
VOCABULARY = "word_bpe_49k.json"
END = END_ID.to_bytes(4, "little")
REMEMBERED = 350_000
CHUNK = 4_000_000


class _Remembered:
    """A dictionary of two generations of at most ``most`` entries each; what is used stays."""

    def __init__(self, most: int):
        self.most, self.young, self.old = most, {}, {}

    def missing(self, wanted: Sequence[str]) -> Sequence[str]:
        """What neither generation has; everything else wanted, each once, is in the young one afterwards."""
        new = [word for word in wanted if word not in self.young]
        if len(self.young) + len(new) > self.most:
            self.old, self.young, new = self.young, {}, wanted
        left = []
        for word in new:
            if (found := self.old.get(word)) is None:
                left.append(word)
            else:
                self.young[word] = found
        return left

    def clear(self) -> None:
        self.young, self.old = {}, {}


def _spaced(text: str) -> str:
    """The text with blanks where the vocabulary's pre-tokenizer never joins: ids of the parts between, in order, are its ids.

    It drops spaces and line feeds, and parts letters from the signs after them. Where a text is letters,
    digits, and single commas and full stops only, these signs are set apart and capitals lowered (as its
    normalizer does), so that fewer different parts come about; else a text is cut at blanks alone.
    """
    chars = set(text)
    plain = all(c.isalnum() or c in " \n.," for c in chars) and chars.isdisjoint("Σİ")
    if plain and not any(x in text for x in ("..", ",,", ".,", ",.")) and is_normalized("NFC", text):
        text = text.lower().replace(",", " , ").replace(".", " . ")
    return text.replace("\n", " ")


class WordIds:
    """Ids of texts as little-endian 32-bit numbers, remembering those of their parts.

    Parts of letters that weren't seen before are encoded in one text, whose ids are told apart by the ends
    of words; every other part is encoded by itself.
    """

    def __init__(self, vocabulary: str):
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        tokens = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(tokens.values()) + 1, bool)
        self.ends[[i for token, i in tokens.items() if token.endswith("</w>")]] = True
        self.known = _Remembered(REMEMBERED)

    def _encode(self, parts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)
        return [np.asarray(x.ids, "<u4").tobytes() for x in found]

    def _encode_letters(self, words: list[str]) -> list[bytes]:
        """Ids of words that are letters only: each ends at its one end-of-word id."""
        ids = np.asarray(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(words):
            return self._encode(words)
        raw, bounds = ids.tobytes(), [0, *(4 * stops).tolist()]
        return [raw[i:j] for i, j in zip(bounds, bounds[1:])]

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        parts = pc.split_pattern(pa.array([_spaced(text) for text in texts], pa.large_string()), " ")
        coded = parts.values.dictionary_encode()
        words = coded.dictionary.to_pylist()
        new = self.known.missing(words)
        ids = self.known.young
        letters = [x for x in new if x.isalpha()]
        others = [x for x in new if not x.isalpha()]
        if letters:
            ids.update(zip(letters, self._encode_letters(letters)))
        ids.update(zip(others, self._encode(others)))
        found = [ids[word] for word in words]
        # the ids of all parts in turn, gathered from those of the different ones; fewer than the texts' bytes, so below 2**31
        sizes = np.fromiter(map(len, found), np.int32, len(found)) // 4
        flat, first = np.frombuffer(b"".join(found), "<u4"), np.cumsum(sizes, dtype=np.int32) - sizes
        codes = coded.indices.to_numpy()
        counts = sizes[codes]
        ends = np.append(np.int32(0), np.cumsum(counts, dtype=np.int32))
        places = np.repeat(first[codes] - ends[:-1], counts)
        places += np.arange(ends[-1], dtype=np.int32)
        flat = flat[places]
        bounds = ends[parts.offsets.to_numpy()].tolist()
        for low, high in zip(bounds, bounds[1:]):
            yield flat[low:high].tobytes() + END


@cache
def word_ids(vocabulary: str) -> WordIds:
    """One per Python worker; what a task has remembered goes with it, as workers wait for other steps' tasks too."""
    return WordIds(vocabulary)


def _chunks(texts: Iterable[str]) -> Iterator[list[str]]:
    """Lists of texts of about ``CHUNK`` characters; a longer text is a list of its own."""
    chunk, size = [], 0
    for text in texts:
        if chunk and size + len(text) > CHUNK:
            yield chunk
            chunk, size = [], 0
        chunk.append(text)
        size += len(text)
    if chunk:
        yield chunk


def _cut_batches(vocabulary: str, length: int) -> Callable[[Iterator[pa.Array]], Iterator[pa.Array]]:
    def cut_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = word_ids(vocabulary)
        for batch in batches:
            ends, out = [0], []
            for chunk in _chunks(each_text(batch)):
                for raw in encode(chunk):
                    n = len(raw) // 4
                    out += [(at, min(length, n - at), zlib.crc32(raw[4 * at : 4 * (at + length)]), n) for at in range(0, n, length)]
                    ends.append(len(out))
            columns = np.asarray(out, np.int64).reshape(-1, len(PIECE)).T
            pieces = pa.StructArray.from_arrays([pa.array(c) for c in columns], PIECE.names)
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pieces)
        encode.known.clear()
        pa.default_memory_pool().release_unused()

    return cut_batches


PIECE = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "ids_crc32", "doc_tokens")])


def pieces_of(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, vocabulary: str = VOCABULARY
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens."""
    cutter = F.arrow_udf(_cut_batches(vocabulary, length), T.ArrayType(PIECE))
    source = df.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    return source.select("doc_id", F.explode(cutter("text")).alias("piece")).select("doc_id", "piece.*")


def _deal(plan: list[tuple[int, dict[int, int]]], classes: int) -> Callable:
    """The sequence of the r-th piece of a class: patterns hold runs of ranks, copy after copy."""
    first = list(accumulate((n for n, _ in plan), initial=0))
    runs: list[list[tuple[int, int, int]]] = [[] for _ in range(classes + 1)]
    taken = [0] * (classes + 1)
    for at, (copies, counts) in enumerate(plan):
        for size, count in counts.items():
            runs[size].append((taken[size], count, first[at]))
            taken[size] += copies * count
    tables = [np.asarray(x, np.int64).reshape(-1, 3) for x in runs]

    def deal(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for sizes, ranks in batches:
            size, rank = sizes.to_numpy(), ranks.to_numpy()
            out = np.zeros(len(size), np.int64)
            for one in np.unique(size):
                mine = size == one
                run = tables[one][np.searchsorted(tables[one][:, 0], rank[mine], side="right") - 1]
                out[mine] = run[:, 2] + (rank[mine] - run[:, 0]) // run[:, 1]
            yield pd.Series(out)

    return F.pandas_udf(deal, T.LongType())


def pack(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    step: int = STEP,
    vocabulary: str = VOCABULARY,
) -> DataFrame:
    """Every piece with its sequence and its gapless offset there."""
    classes = -(-length // step)
    pieces = pieces_of(df, doc_id, text, length, vocabulary)
    keyed = pieces.withColumns(
        {
            "size_class": F.ceil(F.col("length") / step).cast("int"),
            "block": F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "doc_tokens"), F.lit(BLOCKS)).cast("int"),
        }
    )
    keyed = stored(keyed, "pieces")
    # at most classes x BLOCKS lines
    counted = keyed.groupBy("size_class", "block").count().orderBy("size_class", "block").collect()
    histogram: dict[int, int] = {}
    before = np.zeros((classes + 1, BLOCKS), np.int64)
    for line in counted:
        before[line.size_class, line.block] = histogram.get(line.size_class, 0)
        histogram[line.size_class] = histogram.get(line.size_class, 0) + line["count"]
    start_of = F.pandas_udf(lambda c, b: pd.Series(before[c, b]), T.LongType())
    inside = Window.partitionBy("size_class", "block").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    deal = _deal(cut(histogram, classes), classes)
    ranked = keyed.withColumn("rank", F.row_number().over(inside) - 1 + start_of("size_class", "block"))
    placed = ranked.withColumn("sequence_id", deal("size_class", "rank"))
    row = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "start", "rank")
    filled = F.coalesce(F.sum("length").over(row.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", filled.alias("offset"))
