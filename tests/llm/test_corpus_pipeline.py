"""The pipeline on a small planted corpus: every stage's decision takes effect, clean documents stay."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.util import PythonEvalType

import corpus_pipeline
from faremill.llm import jaccard_join, packing, toxicity
from faremill.llm.common import each_text, text_of

from test_llm_operators import DOCS, edited, ids_of, prose


def test_planted_documents(spark, tmp_path):
    rng = np.random.default_rng(21)
    toxic = lambda text: f"you idiot {text} worthless scum"
    clean = [prose(rng, 60, 5000) for _ in range(120)]
    bad = [toxic(prose(rng, 60, 5000)) for _ in range(60)]
    junk = [" ".join(f"{w}$$$" for w in prose(rng, 40).split()) for _ in range(5)]
    copies = [clean[0], edited(rng, clean[1], 1), clean[0]]
    item = prose(rng, 30, 5000)
    leaks = [f"{prose(rng, 40, 5000)} {item} {prose(rng, 10, 5000)}"]
    texts = [*clean, *bad, *junk, *copies, *leaks]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, 1, int(120 <= i < 180)) for i in range(180)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    left = set(range(120))
    assert [name for name, _ in corpus_pipeline.STAGES][-1] == "packing"
    got = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    assert set(got["doc_id"]) == left
    assert all(got[got["doc_id"] == i]["length"].sum() == len(ids_of(texts[i])) for i in (0, 50, 119))


def test_texts_of_a_batch_are_made_some_at_a_time():
    """Workers that hold all texts of a batch beside its Arrow form are what filled the executors."""
    texts = ["a" * 10, None, ""] * 400
    held = []

    class Watched:
        def __init__(self, batch):
            self.batch = batch

        def __len__(self):
            return len(self.batch)

        def slice(self, low, rows):
            held.append(min(rows, len(self) - low))
            return self.batch.slice(low, rows)

    assert list(each_text(Watched(pa.array(texts)))) == texts and max(held) <= 256
    assert sum(held) == len(texts)


def test_no_stage_takes_whole_batches_of_texts_to_pandas(spark):
    docs = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string")
    scored = docs.select(toxicity.feature_column(text_of("text"), toxicity.Lexicon({}, {})).alias("f"))
    for made in (scored, packing.pieces_of(docs), docs.select(jaccard_join._set_udf(5, 80)(text_of("text")).alias("s"))):
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        assert set(re.findall(r"ArrowEvalPython .*\], (\d+)", plan)) == {str(PythonEvalType.SQL_SCALAR_ARROW_ITER_UDF)}, plan
        assert len(made.collect()) == 2
