"""A network's passes go through blocks some rows at a time, and blocks are kept small."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from faremill.operators import gradient
from faremill.operators.gradient import Block, Layout, Training


@pytest.mark.parametrize("sizes", [(2, 5, 7), (), (3, 200)])
def test_rows_go_through_all_layers_some_at_a_time(monkeypatch, sizes):
    draw, n = np.random.default_rng(9), 2 * gradient.CHUNK + 100
    layout, training, seen, loss_of = Layout(3, sizes, (6, 4)), Training(), [], gradient.loss_of
    unknown = [draw.integers(-1, size + 3, n) for size in sizes]
    block = Block(draw.normal(size=(4, n)), np.array(unknown, np.int16).reshape(len(sizes), n))
    parameters = draw.normal(size=layout.size)
    design = block.design(layout)
    want = gradient.loss_and_gradient(parameters, design, block.label, layout, training)
    monkeypatch.setattr(gradient, "loss_of", lambda residual, *a: seen.append(len(residual)) or loss_of(residual, *a))
    loss, slope = gradient.block_gradient(parameters, block, layout, training)
    assert loss == pytest.approx(want[0], rel=1e-12) and slope == pytest.approx(want[1], rel=1e-9, abs=1e-9)
    assert sum(seen) == n and (sum(sizes) > gradient.NARROW or max(seen) <= gradient.CHUNK)
    residual = gradient.forward(parameters, design, layout)[-1] - block.label
    assert gradient.block_residual(parameters, block, layout) == pytest.approx(residual)
    empty = Block(np.empty((4, 0)), np.empty((len(sizes), 0), np.int16))
    assert len(gradient.block_residual(parameters, empty, layout)) == 0


def test_category_indices_take_as_few_bytes_as_they_need(spark):
    pdf = pd.DataFrame({"x0": [0.5] * 6, "c0": [0, 1, 126, 127, 100_000, None], "c1": [0, 1, 2, 1, -1, 0], "label": 1.0})
    rows = spark.createDataFrame(pdf).coalesce(1)
    for size, kind in ((127, np.int8), (128, np.int16), (40_000, np.int32)):
        layout = Layout(1, (size, 2))
        blocks = gradient.blocks_of(rows, layout)
        found = [Block(*held) for held in blocks.collect()]
        blocks.unpersist()
        assert {block.categories.dtype for block in found} == {np.dtype(kind)}
        codes = [x for block in found for x in zip(*(c.tolist() for c in block.codes(layout)))]
        assert sorted(codes) == sorted([(0, 0), (1, 1), (126, 2), (min(127, size), 1), (size, 2), (size, 0)])
