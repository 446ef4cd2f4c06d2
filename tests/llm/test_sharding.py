"""The law of the shards on repeated rows, and every digest computed again."""

import zlib

import numpy as np

from faremill.llm import sharding
from tests.llm.rows import documents


def test_bytes_law_holds_where_rows_repeat(spark):
    draw = np.random.default_rng(4)
    rows = [(i, None, None, None, "x" * int(draw.integers(20, 400))) for i in range(3000)]
    rows += [(7, None, None, None, "y" * 300)] * 1200 + [(None, None, None, None, "z" * 200)] * 800 + [(5, None, None, None, None)]
    got = sharding.shard_documents(documents(spark, rows)).toPandas()
    sums = got.groupby("shard")["size"].sum()
    assert len(sums) == 16 and sums.max() <= 1.01 * sums.mean() and sums.min() >= 0.99 * sums.mean()
    want = sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for *_, t in rows)
    assert sorted(zip(got["size"], got["text_crc32"])) == want
    for _, shard in got.groupby("shard"):
        assert sorted(shard["slot"]) == list(range(len(shard)))
    assert set(got["law"]) == {"bytes"} and got["grown_shard"].isna().all()
