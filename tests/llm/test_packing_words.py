"""Remembered words: looked up one by one, never gone through whole, and gone at the end of a task."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa

from faremill.llm import packing

from test_llm_operators import ids_of

TEXTS = ["", None, " ", "One two, two  three.\nÀ la carte", "A$$$ b.,c ... d'e", "x " * 5000, "naïve ﬁ Σ İ 漢字 12,5"]


class Unlisted(dict):
    """A dictionary that may be asked for single words only."""

    def _whole(self):
        raise AssertionError("all remembered words were gone through")

    keys = items = values = __iter__ = _whole


def test_a_chunk_costs_its_own_words_not_the_remembered_ones():
    held = packing._Remembered(4)
    held.young, held.old = Unlisted(a=b"1", b=b"2"), Unlisted(c=b"3")
    assert held.missing(["a", "c", "d"]) == ["d"]
    assert held.young["a"] == b"1" and held.young["c"] == b"3"
    held.young["d"] = b"4"
    assert held.missing(["e", "a"]) == ["e"]
    assert dict.keys(held.young) == {"a"} and dict.keys(held.old) == {"a", "b", "c", "d"}


def test_ids_of_texts_and_nothing_remembered_after_a_task(monkeypatch):
    monkeypatch.setattr(packing, "CHUNK", 40)
    cut = packing._cut_batches(packing.VOCABULARY, packing.LENGTH)
    batches = [pa.array([x or "" for x in TEXTS]), pa.array([], pa.string()), pa.array(["two three", "two"])]
    got = [pieces for made in cut(iter(batches)) for pieces in made.to_pylist()]
    for text, pieces in zip([*TEXTS, "two three", "two"], got, strict=True):
        ids = np.asarray(ids_of(text), "<u4")
        at = range(0, len(ids), packing.LENGTH)
        assert [(p["start"], p["doc_tokens"]) for p in pieces] == [(i, len(ids)) for i in at]
        assert [p["ids_crc32"] for p in pieces] == [zlib.crc32(ids[i : i + packing.LENGTH].tobytes()) for i in at]
    known = packing.word_ids(packing.VOCABULARY).known
    assert not known.young and not known.old
