"""The manifest against a tree built plainly over all rows."""

from hashlib import sha256
from zlib import crc32

import duckdb
import pytest

from faremill.llm import merkle
from tests.llm.rows import documents

H = lambda *parts: sha256("".join(parts).encode()).hexdigest()
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _leaf(*values):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def _levels(leaves):
    levels = [list(leaves)]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def _climb(levels, at, value):
    proof = []
    for level in levels[:-1]:
        low = at // 16 * 16
        run = level[low : low + 16]
        proof += run[: at - low] + run[at - low + 1 :]
        value, at = H(*run[: at - low], value, *run[at - low + 1 :]), at // 16
    return proof, value


def plain(rows):
    by = {}
    for doc_id, source, lang, n_chars, text in rows:
        leaf = _leaf(doc_id, source, lang, n_chars, text)
        hit = doc_id is not None and crc32(str(doc_id).encode()) % 5 == 0
        changed = _leaf(doc_id, source, lang, n_chars, text and text.translate(LOWER)) if hit else leaf
        by.setdefault(source, []).append((doc_id is not None, doc_id or 0, leaf, changed, doc_id))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: _levels([r[2] for r in sorted(by[s])]) for s in order}
    top = _levels([trees[s][-1][0] for s in order])
    root, out = top[-1][0], []
    for at, s in enumerate(order):
        for place, (_, _, leaf, changed, doc_id) in enumerate(sorted(by[s])):
            low, value = _climb(trees[s], place, changed)
            high, value = _climb(top, at, value)
            out.append((doc_id, leaf, trees[s][-1][0], root, H(*low, *high), value, value == root))
    return sorted(out, key=str)


def _rows(n):
    made = [(i, None if i % 11 == 0 else f"s{i % 3}" if i % 4 else "é", "en", 3, f"Text {i} ÀB") for i in range(n)]
    return made + [(n, "big", None, None, f"T{i % 700}") for i in range(300)] + [(n + i, "big", "en", i, f"row {i}") for i in range(1, 5000)]


@pytest.mark.parametrize("rows", [_rows(90), [(5, None, None, None, None)], [(2**62 + 1, "a", "x", 1, "Q"), (None, "a", "x", 1, "")]])
def test_manifest_equals_plain_tree(spark, rows):
    frame = documents(spark, rows)
    got = sorted((tuple(r) for r in merkle.manifest(frame).collect()), key=str)
    assert got == plain(rows)


def test_empty_table(spark):
    assert merkle.manifest(documents(spark, [])).count() == 0


def test_versions_share_untouched_nodes():
    root, levels = merkle.grown([merkle.digest(str(i)) for i in range(200)])
    steps = merkle.trail(37, levels)
    other = merkle.replaced(root, steps, merkle.digest("x"))
    assert levels == 2 and other.digest != root.digest
    assert [a is b for a, b in zip(root.children, other.children)] == [i != 2 for i in range(13)]
    inner = zip(root.children[2].children, other.children[2].children)
    assert [a is b for a, b in inner] == [i != 5 for i in range(16)]


def test_sql_states_the_same(spark):
    rows = _rows(60)[:400]
    connection = duckdb.connect()
    connection.execute("CREATE TABLE documents (doc_id BIGINT, source VARCHAR, lang VARCHAR, n_chars BIGINT, text VARCHAR)")
    connection.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    got = connection.execute(f"SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, verified FROM ({merkle.manifest_sql()})")
    assert sorted(got.fetchall(), key=str) == plain(rows)
