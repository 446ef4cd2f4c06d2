"""What a step leaves on the disks: no shuffle files of steps that are over, no table that nobody reads again."""

import random
import time
from pathlib import Path

from pyspark.sql import functions as F

from faremill.llm import jaccard_join
from faremill.llm.common import CLEANUP, stored
from tests.llm.rows import documents
from tests.llm.test_jaccard_groups import copies, templates, words


def _blocks(spark):
    """Names of the shuffle blocks on disk."""
    held = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    names = set()
    while held.hasNext():
        names.add(held.next().getName())
    return {name for name in names if name.startswith("shuffle_")}


def test_a_stored_table_leaves_no_shuffle_files(spark):
    before = _blocks(spark)
    table = stored(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "sevenths")
    again = stored(table.hint("merge").join(table.groupBy("count").agg(F.max("k").alias("top")), "count"), "sevenths")
    assert len(again.collect()) == 7
    for _ in range(50):  # files go in the background
        left = _blocks(spark) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left
    assert spark.conf.get(CLEANUP) == "false"  # other queries of the session are left as they are


def _watched(monkeypatch):
    """(name, table, rows) of what the join stores."""
    tables = []

    def watched(df, name):
        table = stored(df, name)
        tables.append((name, table, table.count()))
        return table

    monkeypatch.setattr(jaccard_join, "stored", watched)
    return tables


def _path(table):
    return Path(table._stored_at.removeprefix("file:"))


def test_tables_that_nobody_reads_again_are_deleted(spark, monkeypatch):
    draw = random.Random(3)
    texts = copies(draw, 30, 60, 1) + templates(draw, 20, 40, 10) + ["", None, "a b"]
    frame = documents(spark, [(i, None, None, None, t) for i, t in enumerate(texts)])
    tables = _watched(monkeypatch)
    kept = jaccard_join.keep_one(frame)
    portions = [table for name, table, _ in tables if name == "shared-signatures"]
    assert len(portions) == jaccard_join.PORTIONS
    spent = ("document-sets", "shared-signatures", "differences", "placed", "narrowed")
    left = {name for name, table, _ in tables if _path(table).exists()}
    assert left and not left & set(spent)
    assert kept.count() == 1 + 20 + 3


def test_differences_are_marked_only_where_a_first_one_waits(spark, monkeypatch):
    """Members a little too far from their pivot: each difference was marked in dozens of bands, nearly all of them empty."""
    draw = random.Random(4)
    base = words(draw, 120)
    texts = [" ".join(base)]
    for _ in range(90):  # three of ten places have their other word
        places = {10 * at + 5 for at in draw.sample(range(10), 3)}
        texts.append(" ".join(f"other{at}" if at in places else word for at, word in enumerate(base)))
    texts = list(dict.fromkeys(texts))
    from faremill.llm.segments import WordHashes, set_id, shingles

    hashes = WordHashes()
    held = [(set_id(x), x.astype("int64").tolist()) for x in (shingles(t, 5, hashes) for t in texts)]
    sets = spark.createDataFrame(held, "class long, items array<long>")
    large = spark.createDataFrame([(held[0][0], c, c) for c, _ in held], "p long, class long, label long")
    tables = _watched(monkeypatch)
    jaccard_join._narrowed(large, sets, 80)
    rows = {name: n for name, _, n in tables}
    assert 0 < rows["differences"] and rows["narrowed"] <= rows["differences"], rows
