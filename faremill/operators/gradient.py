"""Synchronous gradient training for losses and networks that ``pyspark.ml`` lacks.

Rows stay where Spark put them. A step is one job: every task adds up the gradient of its rows at the
shared parameters and returns one array, the arrays are added in a two-level tree, and the driver takes
the step. No task updates parameters of its own, so neither cores, files nor partitions are part of the
model. Mini-batches are chosen by row hash (``part``), which layouts don't change either; each is kept
as blocks of arrays, dealt over all cores, and a step reads its own blocks only.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Tasks carry this module's functions with them, so workers need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows that are never trained on, only scored.
HELD_OUT = -1
#: Arrays that the driver adds by itself; more are added in groups on the cluster first.
FAN = 32
#: Combinations of category columns that are looked up at once.
GROUPED = 1024
#: Inputs of a network that are multiplied by the first layer, wider ones are looked up; and rows that go through all
#: layers together, so that their activations stay in the processor's cache.
NARROW, CHUNK = 128, 2048


@dataclass(frozen=True)
class Layout:
    """Shape of the model: inputs ``x0..``, one-hot blocks for ``c0..`` and hidden layers."""

    numeric: int
    category_sizes: tuple[int, ...] = ()
    hidden: tuple[int, ...] = ()

    @property
    def columns(self) -> list[str]:
        return [f"x{i}" for i in range(self.numeric)] + [
            f"c{j}" for j in range(len(self.category_sizes))
        ]

    @property
    def widths(self) -> list[int]:
        return [self.numeric + sum(self.category_sizes), *self.hidden, 1]

    @property
    def size(self) -> int:
        return sum(a * b + b for a, b in zip(self.widths, self.widths[1:]))


@dataclass(frozen=True)
class Training:
    """Optimiser settings: ``batches`` steps an epoch, each on the rows of one part of the hash."""

    loss: str = "squared"
    huber_epsilon: float = 0.1
    optimiser: str = "sgd"
    rate: float = 0.01
    power_t: float = 0.25
    l1: float = 0.0
    l2: float = 0.0
    batches: int = 1
    max_epochs: int = 50
    tolerance: float = 1e-4
    patience: int = 5
    seed: int = 42


@dataclass(frozen=True)
class TrainedModel:
    layout: Layout
    parameters: np.ndarray
    history: list[dict] = field(default_factory=list)

    def prediction(self, inputs: list[Column] | None = None) -> Column:
        """Vectorised score of the compact columns ``x0.. c0..``, or of expressions in their place."""
        layout, parameters = self.layout, self.parameters

        @F.pandas_udf("double")
        def score(*columns: pd.Series) -> pd.Series:
            matrix = design_matrix(np.column_stack([c.to_numpy(float) for c in columns]), layout)
            return pd.Series(forward(parameters, matrix, layout)[-1])

        return score(*(inputs or [F.col(c) for c in layout.columns]))

    def save(self, spark: SparkSession, path: str) -> None:
        row = (
            self.layout.numeric,
            list(self.layout.category_sizes),
            list(self.layout.hidden),
            self.parameters.tolist(),
        )
        schema = "numeric int, category_sizes array<int>, hidden array<int>, parameters array<double>"
        spark.createDataFrame([row], schema).coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> TrainedModel:
        row = spark.read.parquet(path).first()
        layout = Layout(row["numeric"], tuple(row["category_sizes"]), tuple(row["hidden"]))
        return TrainedModel(layout, np.array(row["parameters"], dtype=float))


# --- numerics of one batch --------------------------------------------------------------


def design_matrix(values: np.ndarray, layout: Layout) -> np.ndarray:
    rows = np.arange(len(values))
    out = np.zeros((len(values), layout.widths[0]))
    out[:, : layout.numeric] = values[:, : layout.numeric]
    offset = layout.numeric
    for j, size in enumerate(layout.category_sizes):
        index = values[:, layout.numeric + j].astype(int)
        known = (index >= 0) & (index < size)
        out[rows[known], offset + index[known]] = 1.0
        offset += size
    return out


def layers(parameters: np.ndarray, layout: Layout) -> list[tuple[np.ndarray, np.ndarray]]:
    """Views of the flat vector as (weights, biases) per layer."""
    views, start = [], 0
    for a, b in zip(layout.widths, layout.widths[1:]):
        weights = parameters[start : start + a * b].reshape(a, b)
        start += a * b
        views.append((weights, parameters[start : start + b]))
        start += b
    return views


def weight_mask(layout: Layout) -> np.ndarray:
    """1 for weights, 0 for biases: penalties leave biases alone."""
    mask = np.zeros(layout.size)
    for weights, _ in layers(mask, layout):
        weights[...] = 1.0
    return mask


def initial_parameters(layout: Layout, seed: int) -> np.ndarray:
    """Zeros for a linear model, uniform Glorot weights for a network."""
    parameters = np.zeros(layout.size)
    if layout.hidden:
        random = np.random.default_rng(seed)
        for weights, biases in layers(parameters, layout):
            bound = np.sqrt(6.0 / sum(weights.shape))
            weights[...] = random.uniform(-bound, bound, weights.shape)
            biases[...] = random.uniform(-bound, bound, biases.shape)
    return parameters


def forward(parameters: np.ndarray, inputs: np.ndarray, layout: Layout) -> list[np.ndarray]:
    """Activations of every layer; the last is the prediction vector."""
    activations = [inputs]
    stack = layers(parameters, layout)
    for depth, (weights, biases) in enumerate(stack):
        value = activations[-1] @ weights + biases
        activations.append(np.maximum(value, 0.0) if depth < len(stack) - 1 else value[:, 0])
    return activations


def loss_of(residual: np.ndarray, training: Training) -> tuple[np.ndarray, np.ndarray]:
    """Loss per row and its derivative by the prediction."""
    if training.loss == "squared":
        return 0.5 * residual**2, residual
    if training.loss != "huber":
        raise ValueError(f"unknown loss {training.loss!r}")
    eps = training.huber_epsilon
    size = np.abs(residual)
    value = np.where(size <= eps, 0.5 * residual**2, eps * size - 0.5 * eps**2)
    return value, np.clip(residual, -eps, eps)


def loss_and_gradient(parameters, inputs, target, layout: Layout, training: Training):
    """Sums over the batch: loss and flat gradient."""
    activations = forward(parameters, inputs, layout)
    value, slope = loss_of(activations[-1] - target, training)
    gradient = np.zeros_like(parameters)
    stack, out = layers(parameters, layout), layers(gradient, layout)
    delta = slope[:, None]
    for depth in range(len(stack) - 1, -1, -1):
        below = activations[depth]
        out[depth][0][...] = below.T @ delta
        out[depth][1][...] = delta.sum(axis=0)
        if depth:
            delta = (delta @ stack[depth][0].T) * (below > 0)
    return float(value.sum()), gradient


def _category_groups(layout: Layout) -> list[list[int]]:
    """Neighbouring category columns put together while their combinations stay few."""
    groups: list[list[int]] = []
    width = GROUPED + 1
    for j, size in enumerate(layout.category_sizes):
        width *= size + 1
        if width > GROUPED:
            groups.append([])
            width = size + 1
        groups[-1].append(j)
    return groups


def _grouped(codes: list[np.ndarray], layout: Layout, group: list[int]) -> tuple[np.ndarray, list[np.ndarray]]:
    """The combination that each row has, and the input (or none, -1) of each combination per column."""
    sizes, starts = layout.category_sizes, np.cumsum([layout.numeric, *layout.category_sizes])
    shape = [sizes[j] + 1 for j in group]
    combined = np.ravel_multi_index([codes[j] for j in group], shape)
    places = np.unravel_index(np.arange(int(np.prod(shape))), shape)
    return combined, [np.where(place < sizes[j], starts[j] + place, -1) for j, place in zip(group, places)]


def block_forward(parameters: np.ndarray, block: Block, layout: Layout):
    """Activations from the first layer on, and each group's combinations: one-hot inputs are looked up, not multiplied."""
    stack = layers(parameters, layout)
    weights, biases = stack[0]
    known = np.vstack([weights, np.zeros((1, weights.shape[1]))])  # -1: no input
    codes = block.codes(layout)
    grouped = [_grouped(codes, layout, group) for group in _category_groups(layout)]
    value = block.inputs.T @ weights[: layout.numeric] + biases
    for combined, inputs in grouped:
        value += sum(known[x] for x in inputs)[combined]
    activations = []
    for depth, (weights, biases) in enumerate(stack):
        value = activations[-1] @ weights + biases if depth else value
        activations.append(np.maximum(value, 0.0) if depth < len(stack) - 1 else value[:, 0])
    return activations, grouped


def _multiplied(layout: Layout) -> bool:
    return bool(layout.hidden) and layout.widths[0] <= NARROW


def _chunks(block: Block, layout: Layout) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """One-hot inputs, with a column more that what is unknown goes to, and labels of some rows at a time; one array is used again."""
    width, rows = layout.widths[0], len(block.label)
    starts = np.cumsum([layout.numeric, *layout.category_sizes[:-1]])[:, None]
    sizes = np.array(layout.category_sizes, np.int64)[:, None]
    held = np.zeros((min(CHUNK, rows), width + 1))
    lines = np.arange(len(held)) * (width + 1)
    for low in range(0, rows, CHUNK):
        label = block.label[low : low + CHUNK]
        inputs = held[: len(label)]
        inputs[...] = 0.0
        inputs[:, : layout.numeric] = block.inputs[:, low : low + CHUNK].T
        if len(sizes):
            index = block.categories[:, low : low + CHUNK]
            places = np.where((index >= 0) & (index < sizes), index + starts, width)
            inputs.reshape(-1)[places + lines[: len(label)]] = 1.0
        yield inputs, label


def _multiplied_layers(parameters: np.ndarray, layout: Layout) -> list[tuple[np.ndarray, np.ndarray]]:
    """The layers, the first with a line for the column of what is unknown."""
    (weights, biases), *rest = layers(parameters, layout)
    return [(np.vstack([weights, np.zeros((1, weights.shape[1]))]), biases), *rest]


def _activations(stack: list[tuple[np.ndarray, np.ndarray]], inputs: np.ndarray) -> list[np.ndarray]:
    activations = [inputs]
    for depth, (weights, biases) in enumerate(stack):
        value = activations[-1] @ weights
        value += biases
        activations.append(np.maximum(value, 0.0, out=value) if depth < len(stack) - 1 else value[:, 0])
    return activations


def _multiplied_gradient(parameters: np.ndarray, block: Block, layout: Layout, training: Training):
    loss, gradient = 0.0, np.zeros_like(parameters)
    stack, out = _multiplied_layers(parameters, layout), layers(gradient, layout)
    for inputs, label in _chunks(block, layout):
        activations = _activations(stack, inputs)
        value, slope = loss_of(activations[-1] - label, training)
        loss += float(value.sum())
        delta = slope[:, None]
        for depth in range(len(stack) - 1, -1, -1):
            below = activations[depth]
            slopes = below.T @ delta
            out[depth][0][...] += slopes[: len(out[depth][0])]
            out[depth][1][...] += delta.sum(axis=0)
            if depth:
                delta = delta @ stack[depth][0].T
                delta *= below > 0
    return loss, gradient


def block_residual(parameters: np.ndarray, block: Block, layout: Layout) -> np.ndarray:
    """Prediction less label of every row."""
    if not _multiplied(layout):
        return block_forward(parameters, block, layout)[0][-1] - block.label
    stack = _multiplied_layers(parameters, layout)
    return np.concatenate([np.empty(0), *(_activations(stack, inputs)[-1] - label for inputs, label in _chunks(block, layout))])


def block_gradient(parameters: np.ndarray, block: Block, layout: Layout, training: Training):
    """``loss_and_gradient`` of a block, without the design matrix of all its rows."""
    if _multiplied(layout):
        return _multiplied_gradient(parameters, block, layout, training)
    activations, grouped = block_forward(parameters, block, layout)
    value, slope = loss_of(activations[-1] - block.label, training)
    gradient = np.zeros_like(parameters)
    stack, out = layers(parameters, layout), layers(gradient, layout)
    delta = slope[:, None]
    for depth in range(len(stack) - 1, 0, -1):
        below = activations[depth - 1]
        out[depth][0][...] = below.T @ delta
        out[depth][1][...] = delta.sum(axis=0)
        delta = (delta @ stack[depth][0].T) * (below > 0)
    out[0][0][: layout.numeric] = block.inputs @ delta
    out[0][1][...] = delta.sum(axis=0)
    for combined, inputs in grouped:
        order = np.argsort(combined, kind="stable")
        found, first = np.unique(combined[order], return_index=True)
        sums = np.add.reduceat(delta[order], first, axis=0)
        for places in inputs:
            known = places[found] >= 0
            np.add.at(out[0][0], places[found][known], sums[known])
    return float(value.sum()), gradient


@dataclass
class Optimiser:
    """Parameters with their running moments and step counter."""

    parameters: np.ndarray
    first: np.ndarray
    second: np.ndarray
    steps: int

    @staticmethod
    def start(parameters: np.ndarray) -> Optimiser:
        return Optimiser(parameters, np.zeros_like(parameters), np.zeros_like(parameters), 0)

    def step(self, gradient: np.ndarray, mask: np.ndarray, training: Training) -> None:
        """One update with a mean gradient: SGD or Adam, then proximal L1."""
        self.steps += 1
        gradient = gradient + training.l2 * mask * self.parameters
        if training.optimiser == "adam":
            self.first = 0.9 * self.first + 0.1 * gradient
            self.second = 0.999 * self.second + 0.001 * gradient**2
            first = self.first / (1.0 - 0.9**self.steps)
            second = self.second / (1.0 - 0.999**self.steps)
            rate = training.rate
            self.parameters = self.parameters - rate * first / (np.sqrt(second) + 1e-8)
        else:
            rate = training.rate / self.steps**training.power_t
            self.parameters = self.parameters - rate * gradient
        if training.l1:
            shrunk = np.maximum(np.abs(self.parameters) - rate * training.l1 * mask, 0.0)
            self.parameters = np.sign(self.parameters) * shrunk


# --- one distributed pass ---------------------------------------------------------------


@dataclass(frozen=True)
class Block:
    """Some rows as arrays, a line per column: numbers with the label last, and category indices."""

    numbers: np.ndarray
    categories: np.ndarray

    @property
    def inputs(self) -> np.ndarray:
        return self.numbers[:-1]

    @property
    def label(self) -> np.ndarray:
        return self.numbers[-1]

    def codes(self, layout: Layout) -> list[np.ndarray]:
        """An index per category column; one beyond the known ones for all that is unknown."""
        return [
            np.where((index >= 0) & (index < size), index, size)
            for index, size in zip(self.categories.astype(np.int64), layout.category_sizes)
        ]

    def design(self, layout: Layout) -> np.ndarray:
        return design_matrix(np.vstack([self.inputs, self.categories]).T, layout)


def blocks_of(rows: DataFrame | RDD, layout: Layout) -> RDD:
    """Compact rows with ``label`` as blocks, dealt evenly over the cores and kept by the executors.

    Iterated passes read these in place of rows, so decoding, the transfer to Python and the number of
    files are paid for once. What memory can't hold goes to disk; lost blocks are made again from the rows.
    """
    if isinstance(rows, RDD):
        return rows

    most = max(layout.category_sizes, default=0)
    kind = next(x for x in (np.int8, np.int16, np.int32) if most <= np.iinfo(x).max)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                numbers = batch[[*layout.columns[: layout.numeric], "label"]].to_numpy(float).T
                indices = batch[layout.columns[layout.numeric :]].fillna(-1).to_numpy(np.int32).T
                categories = np.clip(indices, -1, most).astype(kind)  # beyond its column's size all are unknown
                yield pd.DataFrame({"n": [len(batch)], "numbers": [numbers.tobytes()], "categories": [categories.tobytes()]})

    def unpack(line) -> tuple[np.ndarray, np.ndarray]:
        numbers = np.frombuffer(line["numbers"]).reshape(-1, line["n"])
        return numbers, np.frombuffer(line["categories"], kind).reshape(-1, line["n"])

    needed = rows.select(*layout.columns, "label")
    cores = rows.sparkSession.sparkContext.defaultParallelism
    dealt = needed.mapInPandas(pack, "n int, numbers binary, categories binary").repartition(max(cores, rows.rdd.getNumPartitions()))
    return dealt.rdd.map(unpack).persist(StorageLevel.MEMORY_AND_DISK)


def summed(blocks: RDD, kernel: Callable[[Block], np.ndarray], size: int, fan: int = FAN) -> np.ndarray:
    """The sum of ``kernel`` (an array of ``size`` numbers) over all blocks of all tasks.

    Every task returns one array. Up to ``fan`` of these go to the driver; more are first added in about as
    many groups as each group has members. Arrays are added in the order of their tasks.
    """

    def partial(task: int, held: Iterator[tuple]) -> Iterator[tuple[int, np.ndarray]]:
        total = np.zeros(size)
        for arrays in held:
            total += kernel(Block(*arrays))
        yield task, total

    def added(lines) -> tuple[int, np.ndarray]:
        lines = sorted(lines, key=lambda line: line[0])
        return lines[0][0], np.sum(np.stack([line[1] for line in lines]), axis=0)

    parts = blocks.mapPartitionsWithIndex(partial)
    tasks = blocks.getNumPartitions()
    if tasks > fan:
        groups = int(np.ceil(np.sqrt(tasks)))
        parts = parts.map(lambda line: (line[0] % groups, line)).groupByKey(groups).mapValues(added).values()
    total = np.zeros(size)
    for _, array in sorted(parts.collect(), key=lambda line: line[0]):
        total += array
    return total


def fit(rows: DataFrame, layout: Layout, training: Training) -> TrainedModel:
    """Train on ``rows``: compact columns, ``label`` and ``part`` (from 0, or ``HELD_OUT``).

    Each part is kept as blocks of its own, and a step reads one part. Held-out rows are scored at
    the start of each epoch. Stops when their loss has not improved by ``tolerance`` for ``patience``
    epochs; returns the best epoch.
    """
    parts = {p: blocks_of(rows.filter(F.col("part") == p), layout) for p in (HELD_OUT, *range(training.batches))}
    try:
        return _fit(parts, layout, training)
    finally:
        for blocks in parts.values():
            blocks.unpersist()


def _fit(parts: dict[int, RDD], layout: Layout, training: Training) -> TrainedModel:
    state = Optimiser.start(initial_parameters(layout, training.seed))
    mask = weight_mask(layout)
    best, best_loss, waited = state.parameters, np.inf, 0
    history: list[dict] = []
    for epoch in range(training.max_epochs + 1):  # the last pass only scores
        start, seen = state.parameters, np.zeros(4)
        seen[2:] = _held_out_loss(parts[HELD_OUT], state.parameters, layout, training)
        order = np.random.default_rng([training.seed, epoch]).permutation(training.batches)
        for part in order:
            counters, gradient = _pass(parts[int(part)], state.parameters, layout, training)
            seen[:2] += counters
            if epoch < training.max_epochs and counters[0]:
                state.step(gradient / counters[0], mask, training)
        measured = {
            "train_rows": int(seen[0]),
            "train_loss": seen[1] / seen[0] if seen[0] else 0.0,
            "val_rows": int(seen[2]),
            "val_loss": seen[3] / seen[2] if seen[2] else 0.0,
        }
        history.append({"epoch": epoch, **measured})
        watched = measured["val_loss"] if measured["val_rows"] else measured["train_loss"]
        waited = 0 if watched < best_loss - training.tolerance else waited + 1
        if watched < best_loss:
            best, best_loss = start, watched
        if waited >= training.patience or not seen[0]:
            break
    return TrainedModel(layout, best, history)


def distributed_gradient(
    rows: DataFrame, parameters: np.ndarray, layout: Layout, training: Training
) -> tuple[float, np.ndarray, int]:
    """Loss and gradient sums over the rows that aren't held out, and their number."""
    blocks = blocks_of(rows.filter(F.col("part") != HELD_OUT), layout)
    counters, gradient = _pass(blocks, parameters, layout, training)
    blocks.unpersist()
    return counters[1], gradient, int(counters[0])


def _pass(blocks: RDD, parameters: np.ndarray, layout: Layout, training: Training):
    """(rows, their loss) and the gradient's sum at ``parameters``."""

    def kernel(block: Block) -> np.ndarray:
        loss, slope = block_gradient(parameters, block, layout, training)
        return np.concatenate([[len(block.label), loss], slope])

    sums = summed(blocks, kernel, 2 + layout.size)
    return sums[:2], sums[2:]


def _held_out_loss(blocks: RDD, parameters: np.ndarray, layout: Layout, training: Training) -> np.ndarray:
    """(rows, their loss) at ``parameters``."""

    def kernel(block: Block) -> np.ndarray:
        residual = block_residual(parameters, block, layout)
        return np.array([len(residual), loss_of(residual, training)[0].sum()])

    return summed(blocks, kernel, 2)
