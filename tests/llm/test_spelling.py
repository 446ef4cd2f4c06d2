"""Spelling variants against a plain comparison of all words."""

import random
import re
from collections import Counter
from zlib import crc32

import duckdb
import pytest
from pyspark.sql import functions as F

from faremill.llm import spelling
from tests.llm.rows import documents

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = (a, b) if len(a) > len(b) else (b, a)
    return any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def plain(rows):
    counts = Counter()
    for doc_id, *_, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    form, out = {}, []
    others = {w: [v for v in words if near(w, v)] for w in words}
    for w, n in words.items():
        best = min(others[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(others[w]), words.get(form[w])))
    return sorted(out)


def _rows():
    draw = random.Random(5)
    stems = ["".join(draw.choice("abcé") for _ in range(draw.randint(4, 9))) for _ in range(60)]
    stems += ["house", "House", "houses", "housé", "mouse", "À×÷bcd", "x" * 3000, "x" * 3001, "x" * 1500 + "y" + "x" * 1499]
    rows = [(i, None, None, None, " ".join(draw.choices(stems, k=60))) for i in range(60)]
    return rows + [(None, None, None, None, "house " * 40), (7, None, None, None, None), (7, None, None, None, ""), rows[3], rows[3]]


def _got(spark, rows, **how):
    return sorted(tuple(r) for r in spelling.variants(documents(spark, rows), **how).collect())


@pytest.mark.parametrize("most", [spelling.GROUP, 3])
def test_variants_equal_plain_comparison(spark, most):
    rows = _rows()
    assert _got(spark, rows, most=most) == plain(rows)


def test_large_groups_are_divided_and_lose_nothing(spark):
    """Thousands of words of one prefix and one suffix."""
    draw = random.Random(6)
    words = sorted({"prefix" + "".join(draw.choice("ab") for _ in range(9)) + "suffix" for _ in range(700)})
    frame = spark.createDataFrame([(w, 3 + i % 5) for i, w in enumerate(words)], "word string, n long")
    got = {r.word: r for r in spelling.near_words(frame, most=40).collect()}
    for i, w in enumerate(words):
        close = [(-(3 + j % 5), v) for j, v in enumerate(words) if near(w, v)]
        assert (got[w].n_near, (-got[w].form_n, got[w].form)) == (len(close), min(close)) if close else w not in got
    sizes = spelling.groups(frame, 40).groupBy("key").agg(F.count("*").alias("c"), F.first(F.expr("size - head - tail")).alias("m"))
    assert sizes.where("c > 40 and m > 1").isEmpty()


def test_tables_without_words(spark):
    assert _got(spark, []) == []
    assert _got(spark, [(1, None, None, None, "one two")]) == []


def test_sql_states_the_same(spark):
    rows = _rows()
    connection = duckdb.connect()
    connection.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    connection.executemany("INSERT INTO documents VALUES (?, ?)", [(r[0], r[-1]) for r in rows])
    got = connection.execute(spelling.variants_sql()).fetchall()
    assert sorted(got) == plain(rows)
