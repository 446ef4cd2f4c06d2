"""Groups of spelling variants: words that differ by one inserted, deleted or replaced code point.

1. Words and their counts come from one aggregate that combines before it shuffles.
2. Two words of which the longer has L code points are near exactly if their common prefix and common
   suffix together reach L - 1. So they share the first L // 2 code points or the last L - L // 2: words
   meet in groups by prefix and by suffix, a pair being counted in the suffix group only where its common
   prefix is too short for the other. A group of more than ``GROUP`` words is divided again in the same
   way: what its words haven't been asked to share is halved, into words that share the next code
   points and words that share the last ones. Where one code point is left, a group holds the words that
   differ in it alone, no more than there are letters. So no group is unbounded and no pair is lost.
3. A group's words are rows of a padded matrix of code points, cut into blocks of ``TILE``. Blocks are
   compared with each other densely, position by position: first the common prefix, then the common
   suffix. A tile returns one line per word (near words, the best of them), never the pairs.
4. Each word points to its most frequent near word if that is frequent enough. Counts at least double
   along the way, so pointers form trees of few levels; roots are found by pointer jumping.

Defined results: a null text has no words; a null id counts as the empty text where letters are deleted;
repeated ids and rows count each time; ties go to the smaller word in code-point order; an empty table,
or one without frequent words, gives an empty result; other columns are ignored. A word of any length is
compared whole. Groups are found by 64-bit hashes; words that collide are compared too, and found apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faremill.llm.common import ascii_lower, stored, text_of

# fixed values: what a word consists of, and which words are damaged
LETTERS = r"[A-Za-zÀ-ÿ]+"
ONE_IN = 97
SHORTEST, RAREST = 5, 3
#: Most words of a group before it is divided, and rows of a block.
GROUP, TILE = 2048, 256
FOUND = "word string, n_near long, form_n long, form string"


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """word, n: words of at least ``SHORTEST`` code points found at least ``RAREST`` times."""
    run = F.col("run")
    runs = docs.select(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"),
        # outer, as Spark filters by the array's size before other explodes, which searches the text once more
        F.explode_outer(F.regexp_extract_all(ascii_lower(text_of(text)), F.lit(LETTERS), F.lit(0))).alias("run"),
    )
    # a deletion leaves one code point less, so shorter runs can't matter
    runs = runs.where(F.length(run) >= SHORTEST)
    hashed = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run")).alias("h"))
    at = (F.col("h") % F.length(run)).cast("int")
    damaged = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    words = hashed.select(F.when(F.col("h") % ONE_IN == 0, damaged).otherwise(run).alias("word"))
    counted = words.where(F.length("word") >= SHORTEST).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= RAREST)


# --- groups -----------------------------------------------------------------------------


def _dealt(lines: DataFrame) -> DataFrame:
    """To be joined by shuffle only: Spark takes a table of words for as large as its compressed file, before they are
    exploded, and would send hundreds of MB through the driver."""
    return lines.hint("merge")


def _key(size: Column, head: Column, tail: Column) -> Column:
    """The group of words with the same first ``head`` and last ``tail`` code points."""
    word = F.col("word")
    last = F.substring(word, F.length(word) - tail + 1, tail)
    return F.xxhash64(size, head, tail, F.substring(word, F.lit(1), head), last)


def _children(members: DataFrame) -> DataFrame:
    """Each member of a group twice: by more of its beginning, and by more of its end.

    ``size`` is the length of the longer words; pairs belong to a group if the common prefix is at
    least ``head`` and less than ``below``.
    """
    half = F.floor((F.col("size") - F.col("head") - F.col("tail")) / 2).cast("int")
    rest = F.col("size") - F.col("head") - F.col("tail") - half
    lines = F.array(
        F.struct((F.col("head") + half).alias("head"), F.col("tail").alias("tail"), F.col("below").alias("below")),
        F.struct(
            F.col("head").alias("head"), (F.col("tail") + rest).alias("tail"), (F.col("head") + half).alias("below")
        ),
    )
    made = members.select("word", "n", "size", F.explode(lines).alias("c")).select("word", "n", "size", "c.*")
    return made.withColumn("key", _key(F.col("size"), F.col("head"), F.col("tail")))


def _grouped(members: DataFrame) -> DataFrame:
    """Members of groups of at least two, with the group's number of words."""
    counts = members.groupBy("key").agg(F.count("*").alias("words")).where(F.col("words") > 1)
    return _dealt(members).join(counts, "key")


def groups(words: DataFrame, most: int = GROUP) -> DataFrame:
    """word, n, key, size, head, tail, below: groups in which every pair of near words meets once."""
    whole = words.select(
        "word",
        "n",
        F.explode(F.array(F.length("word"), F.length("word") + 1)).alias("size"),
        F.lit(0).alias("head"),
        F.lit(0).alias("tail"),
        F.lit(1 << 30).alias("below"),
    )
    columns = ["word", "n", "key", "size", "head", "tail", "below"]
    found, level = None, stored(_grouped(_children(whole)), "spelling-groups")
    while True:
        # a group that has one code point left to differ in can't be divided
        large = (F.col("words") > most) & (F.col("size") - F.col("head") - F.col("tail") > 1)
        done = level.where(~large).select(*columns)
        found = done if found is None else found.union(done)
        rest = level.where(large)
        if rest.isEmpty():
            return found
        level = stored(_grouped(_children(rest)), "spelling-groups")


# --- tiles ------------------------------------------------------------------------------


def code_points(words: list[str], width: int) -> np.ndarray:
    """One row of code points per word, padded by zeros at the end."""
    padded = "".join(w.ljust(width, "\0") for w in words).encode("utf-32-le")
    return np.frombuffer(padded, np.uint32).reshape(len(words), width)


def _agreeing(a: np.ndarray, b: np.ndarray, columns: Iterator[tuple[int, int]]) -> np.ndarray:
    """How many of the paired columns agree from the start on, for every row of a with every row of b."""
    alive, length = np.ones((len(a), len(b)), bool), np.zeros((len(a), len(b)), np.int32)
    for x, y in columns:
        alive &= a[:, None, x] == b[None, :, y]
        if not alive.any():
            break
        length += alive
    return length


def near_tile(a: np.ndarray, b: np.ndarray, longer: int, gap: int, head: int, below: int) -> np.ndarray:
    """Which rows of ``a`` (words of ``longer`` code points) and ``b`` (``gap`` fewer) are single edits.

    Only pairs whose common prefix is at least ``head`` and less than ``below``.
    """
    shorter = longer - gap
    prefix = _agreeing(a, b, ((i, i) for i in range(shorter)))
    mine = (prefix >= head) & (prefix < below)
    if not mine.any():
        return mine
    suffix = _agreeing(a, b, ((longer - 1 - i, shorter - 1 - i) for i in range(shorter)))
    same = prefix == longer  # a word and itself
    return mine & ~same & (prefix + suffix >= longer - 1)


def group_lines(words: np.ndarray, n: np.ndarray, longer: int, head: int, below: int) -> dict[str, list]:
    """For each word with near words in the group: how many, and the best one. Blocks are compared pairwise."""
    order = np.lexsort((words, -n))  # the best word is the first of a row
    words, n = words[order], n[order]
    long = np.array([len(w) == longer for w in words])
    count, best = np.zeros(len(words), np.int64), np.full(len(words), len(words), np.int64)
    blocks = {}
    for gap, rows in ((0, np.flatnonzero(long)), (1, np.flatnonzero(~long))):
        cut = [rows[i : i + TILE] for i in range(0, len(rows), TILE)]
        blocks[gap] = [(part, code_points(words[part].tolist(), longer)) for part in cut]
    for i, (rows, a) in enumerate(blocks[0]):
        for gap in (0, 1):
            for others, b in blocks[gap][i if gap == 0 else 0 :]:
                near = near_tile(a, b, longer, gap, head, below)
                if not near.any():
                    continue
                count[rows] += near.sum(1)
                _lower(best, rows, others, near)
                if others is not rows:
                    count[others] += near.sum(0)
                    _lower(best, others, rows, near.T)
    hit = np.flatnonzero(count)
    return {"word": words[hit], "n_near": count[hit], "form_n": n[best[hit]], "form": words[best[hit]]}


def _lower(best: np.ndarray, rows: np.ndarray, others: np.ndarray, near: np.ndarray) -> None:
    first = np.where(near.any(1), others[near.argmax(1)], len(best))
    best[rows] = np.minimum(best[rows], first)


def _compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Groups one after the other from rows sorted by key; only the last, maybe cut, group is carried on."""
    held = None
    for frame in frames:
        frame = frame if held is None else pd.concat([held, frame], ignore_index=True)
        keys = frame["key"].to_numpy()
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, int)
        if not len(starts):
            continue
        yield from _lines_of(frame, starts, np.r_[starts[1:], starts[-1]][: len(starts) - 1])
        held = frame.iloc[starts[-1] :]
    if held is not None and len(held):
        yield from _lines_of(held, np.array([0]), np.array([len(held)]))


def _lines_of(frame: pd.DataFrame, starts: np.ndarray, ends: np.ndarray) -> Iterator[pd.DataFrame]:
    words, n = frame["word"].to_numpy(object), frame["n"].to_numpy()
    sizes, heads, tops = (frame[c].to_numpy() for c in ("size", "head", "below"))
    found: dict[str, list] = {"word": [], "n_near": [], "form_n": [], "form": []}
    for low, high in zip(starts, ends):
        lines = group_lines(words[low:high], n[low:high], int(sizes[low]), int(heads[low]), int(tops[low]))
        for name, values in lines.items():
            found[name].extend(values)
    # plain objects: strings that pandas keeps in chunks can't be handed back
    yield pd.DataFrame({c: pd.Series(v, dtype=object if c in ("word", "form") else "int64") for c, v in found.items()})


def near_words(words: DataFrame, most: int = GROUP) -> DataFrame:
    """word, n_near and the best near word (form, form_n) of the words that have any."""
    dealt = groups(words, most).repartition("key").sortWithinPartitions("key")
    lines = dealt.select("key", "word", "n", "size", "head", "below").mapInPandas(_compare, FOUND)
    best = F.min(F.struct((-F.col("form_n")).alias("order"), F.col("form")))
    found = lines.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return found.select("word", "n_near", (-F.col("best.order")).alias("form_n"), F.col("best.form").alias("form"))


# --- roots ------------------------------------------------------------------------------


def with_roots(found: DataFrame) -> DataFrame:
    """Adds root: where the pointers from a word's form end; the word itself if it has no form."""
    pointers = found.where(F.col("form").isNotNull()).select(F.col("word").alias("from"), F.col("form").alias("to"))
    pointers = stored(pointers, "spelling-pointers")
    while True:
        onward = pointers.select(F.col("from").alias("to"), F.col("to").alias("next"))
        jumped = pointers.join(_dealt(onward), "to", "left")
        jumped = jumped.select("from", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved"))
        jumped = stored(jumped, "spelling-pointers")
        if jumped.where("moved").isEmpty():
            ends = pointers.select(F.col("from").alias("word"), F.col("to").alias("end"))
            return found.join(_dealt(ends), "word", "left").withColumn("root", F.coalesce("end", "word")).drop("end")
        pointers = jumped.select("from", "to")


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", most: int = GROUP) -> DataFrame:
    """word, n, n_near, form, form_n and root of every frequent word."""
    words = stored(word_counts(docs, doc_id, text), "spelling-words")
    joined = words.join(_dealt(near_words(words, most)), "word", "left")
    fit = F.col("form_n") >= 2 * F.col("n")
    chosen = joined.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(fit, F.col("form")).alias("form"),
        F.when(fit, F.col("form_n")).alias("form_n"),
    )
    return with_roots(stored(chosen, "spelling-forms")).select("word", "form", "root", "n", "n_near", "form_n")


# --- the same in SQL --------------------------------------------------------------------


def variants_sql() -> str:
    """The result over ``documents``, by deletion neighbours."""
    from faremill.llm.sql_text import ascii_lower_sql, crc32_sql, crc_table

    return f"""
WITH RECURSIVE {crc_table()},
runs AS (
  SELECT id, unnest(regexp_extract_all(t, '[A-Za-zÀ-ÿ]+')) AS run
  FROM (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, {ascii_lower_sql("coalesce(text, '')")} AS t FROM documents)
),
once AS (SELECT id, run, count(*) AS n FROM runs WHERE length(run) >= 5 GROUP BY ALL),
hashed AS (SELECT run, n, {crc32_sql("id || ':' || run")} AS h FROM once CROSS JOIN crc),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT n, CASE WHEN h % 97 = 0 THEN substr(run, 1, CAST(h % length(run) AS INTEGER))
      || substr(run, CAST(h % length(run) AS INTEGER) + 2) ELSE run END AS word FROM hashed
  ) WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
),
cut AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS less
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
),
pairs AS (
  SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b ON a.less = b.less AND a.i = b.i AND a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM cut c JOIN words w ON c.less = w.word
  UNION SELECT w.word, c.word, c.n FROM cut c JOIN words w ON c.less = w.word
),
best AS (
  SELECT word, count(*) AS n_near, max(n) AS top, min(other) FILTER (n = m) AS form
  FROM (SELECT *, max(n) OVER (PARTITION BY word) AS m FROM pairs) GROUP BY word
),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN top >= 2 * w.n THEN form END AS form, CASE WHEN top >= 2 * w.n THEN top END AS form_n
  FROM words w LEFT JOIN best b USING (word)
),
walk AS (
  SELECT word, word AS at FROM formed
  UNION ALL SELECT k.word, f.form FROM walk k JOIN formed f ON k.at = f.word WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, k.at AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN walk k ON f.word = k.word JOIN formed e ON e.word = k.at WHERE e.form IS NULL"""
