"""Texts reach the n-gram counters a chunk at a time, not as whole batches in pandas."""

from __future__ import annotations

import pyarrow as pa

from faremill.llm import katz


def test_chunks_are_cut_from_arrow_and_keep_ids(monkeypatch):
    monkeypatch.setattr(katz, "CHUNK_CHARS", 10)
    ids = [None, 2**53 + 1, 3, None, 5]
    batch = pa.record_batch({"doc_id": pa.array(ids, pa.int64()), "text": ["é" * 4, "b" * 5, "c" * 30, "", "d"]})
    chunks = list(katz._chunks(iter([batch, batch.slice(0, 0)])))
    assert [list(chunk["text"]) for chunk in chunks] == [["é" * 4, "b" * 5], ["c" * 30, ""], ["d"]]
    assert [None if missing else int(i) for c in chunks for i, missing in zip(c["doc_id"], c["doc_id"].isna())] == ids


def test_words_are_counted_without_pandas_batches(spark):
    docs = spark.createDataFrame([("a b a",), ("",)], "text string")
    counted = katz.count_words(docs)
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "MapInPandas" not in plan
    assert sorted(row.c for row in counted.collect()) == [1, 2, 2]
