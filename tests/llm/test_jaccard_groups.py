"""Large groups of texts that share most of their words, against every pair."""

import random

import numpy as np

from faremill.llm import jaccard_join
from tests.llm.rows import documents


def plain(rows, k, percent):
    sets = {}
    for doc_id, *_, text in rows:
        words = (text or "").lower().split()
        sets[doc_id] = {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} or ({tuple(words)} if words else set())
    ids = sorted(sets)
    names = {s: i for i, s in enumerate(sorted({x for v in sets.values() for x in v}))}
    matrix = np.zeros((len(ids), len(names)), np.float32)
    for row, i in enumerate(ids):
        matrix[row, [names[x] for x in sets[i]]] = 1
    common = matrix @ matrix.T
    size = matrix.sum(1)
    linked = (100 * common >= percent * (size[:, None] + size[None, :] - common)) & (size[:, None] > 0)
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for x, y in zip(*np.nonzero(np.triu(linked, 1))):
        a, b = sorted((find(x), find(y)))
        root[b] = a
    return {i: (int(size[at]), ids[find(at)]) for at, i in enumerate(ids)}


def words(draw, n, pool=100_000):
    return [f"w{draw.randrange(pool)}" for _ in range(n)]


def templates(draw, count, common, own):
    """One page template, each page with its own text: close to each other, and not linked."""
    frame = words(draw, common)
    return [" ".join(frame + words(draw, own)) for _ in range(count)]


def copies(draw, count, length, changes):
    """Copies of one text with words replaced at places of their own."""
    base = words(draw, length)
    made = []
    for _ in range(count):
        text = list(base)
        for at in draw.sample(range(length), changes):
            text[at] = f"c{draw.randrange(10**6)}"
        made.append(" ".join(text))
    return made


def test_groups_that_the_pivot_does_not_link(spark, monkeypatch):
    percent, k, draw = 80, 5, random.Random(80)
    texts = templates(draw, 60, 160, 40) + templates(draw, 60, 190, 24) + copies(draw, 40, 120, 2)
    pool = [words(draw, 12) for _ in range(12)]  # passages that several pages share
    frame = words(draw, 180)
    texts += [" ".join(frame + sum(draw.sample(pool, 2), [])) for _ in range(50)]
    texts += [texts[0], texts[5] + " one", "", None, "a b"]
    draw.shuffle(texts)
    rows = [(i, None, None, None, t) for i, t in enumerate(texts)]
    monkeypatch.setattr(jaccard_join, "SMALL", 8)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.join_documents(documents(spark, rows), k, percent).collect()}
    assert got == plain(rows, k, percent)


def test_narrowed_groups_stay_in_proportion(spark):
    """Three hundred pages of 80 % common text: no group is left, however the pivot is chosen."""
    draw = random.Random(1)
    rows = [(i, None, None, None, t) for i, t in enumerate(templates(draw, 300, 160, 40))]
    frame = documents(spark, rows)
    sets = jaccard_join.document_sets(frame, 4)
    items = frame.select("doc_id", jaccard_join.F.col("text"))
    from faremill.llm.segments import WordHashes, shingles

    hashes = WordHashes()
    held = {r.doc_id: shingles(r.text, 4, hashes).astype(np.int64).tolist() for r in items.collect()}
    classes = {r.doc_id: r["class"] for r in sets.collect()}
    table = spark.createDataFrame([(classes[i], held[i]) for i in held], "class long, items array<long>")
    large = spark.createDataFrame([(classes[0], classes[i], classes[i]) for i in held], "p long, class long, label long")
    assert jaccard_join._narrowed(large, table, 85).count() == 0


def test_texts_are_shingled_once_for_sets_and_signatures(spark, monkeypatch):
    """One Python pass gives a document's set and signatures; the search for groups reads no texts."""
    draw = random.Random(2)
    texts = copies(draw, 40, 60, 1) + ["", None, "a b"]
    frame = documents(spark, [(i, None, None, None, t) for i, t in enumerate(texts)])
    kept, groups_of = [], jaccard_join._groups
    monkeypatch.setattr(jaccard_join, "_groups", lambda source, *a: kept.append(source) or groups_of(source, *a))
    assert jaccard_join.join_documents(frame).count() == len(texts)
    plan = kept[0]._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "text" not in kept[0].columns
    from faremill.llm.segments import WordHashes, shingles, signatures

    hashes = WordHashes()
    shown = {r["class"]: sorted(r.signatures) for r in kept[0].collect() if r.signatures}
    want = {jaccard_join.set_id(x): sorted(signatures(x, 85).tolist()) for x in (shingles(t, 4, hashes) for t in texts if t)}
    assert shown == {x: found for x, found in want.items() if found}  # tiny sets link with equal ones alone
