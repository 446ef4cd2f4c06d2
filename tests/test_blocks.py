"""Blocks of rows: passes over them equal passes over one-hot matrices, and all cores take part."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import DataFrame

from faremill.operators import gradient, least_squares
from faremill.operators.gradient import Block, Layout, Training
from harness import registry


def arrays(n=500):
    draw = np.random.default_rng(3)
    categories = np.vstack([draw.integers(0, size + 1, n) for size in (3, 40, 60, 2)])
    return Block(draw.normal(size=(4, n)), categories.astype(np.int32))


@pytest.mark.parametrize("hidden, loss", [((), "huber"), ((6, 4), "squared")])
def test_looked_up_inputs_act_like_multiplied_ones(hidden, loss):
    block, layout = arrays(), Layout(3, (3, 40, 60, 2), hidden)
    assert len(gradient._category_groups(layout)) > 1
    parameters = np.random.default_rng(4).normal(size=layout.size)
    want = gradient.loss_and_gradient(parameters, block.design(layout), block.label, layout, Training(loss=loss))
    loss, slope = gradient.block_gradient(parameters, block, layout, Training(loss=loss))
    assert loss == pytest.approx(want[0], rel=1e-12) and slope == pytest.approx(want[1], rel=1e-9, abs=1e-9)


def test_products_by_category_equal_those_of_the_matrix():
    block, layout = arrays(), Layout(3, (3, 40, 60, 2))
    dense = np.hstack([block.design(layout), np.ones((500, 1))])
    weights = np.random.default_rng(5).uniform(size=(2, 500))
    design = least_squares.Design(block, layout)
    for found, weight in zip(design.products(*weights), weights):
        assert found == pytest.approx((dense * weight[:, None]).T @ dense, abs=1e-9)
    parameters = np.random.default_rng(6).normal(size=layout.size)
    assert design.times(parameters) == pytest.approx(dense @ parameters)
    assert design.sums(weights[0]) == pytest.approx(dense.T @ weights[0])


def test_rows_of_one_file_are_dealt_over_all_cores(spark):
    draw = np.random.default_rng(7)
    pdf = pd.DataFrame({"x0": draw.normal(size=90_000), "c0": draw.integers(0, 3, 90_000), "label": 1.0})
    rows = spark.createDataFrame(pdf).coalesce(1)
    blocks = gradient.blocks_of(rows, Layout(1, (2,)))
    sizes = blocks.mapPartitions(lambda held: [sum(numbers.shape[1] for numbers, _ in held)]).collect()
    assert sum(sizes) == 90_000 and sum(size > 0 for size in sizes) >= 3
    blocks.unpersist()


def test_all_models_of_a_query_read_the_same_blocks(spark, monkeypatch):
    packed, made = [], gradient.blocks_of

    def counted(rows, layout):
        packed.extend([rows] if isinstance(rows, DataFrame) else [])
        return made(rows, layout)

    for module in (gradient, least_squares):
        monkeypatch.setattr(module, "blocks_of", counted)
    kept = spark.sparkContext._jsc.getPersistentRDDs().size()
    lines = registry.QUERIES["model_optimality"](spark, "/root/testdata/sf0.001").collect()
    assert len(packed) == 1 and all(line.optimal for line in lines)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= kept
