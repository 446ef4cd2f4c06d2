"""Linear models by one pass over the rows: normal equations, and a robust loss by weighted ones.

All that a pass returns are sums of products of the inputs (the Gram matrix, as one array per task), so a
model of p inputs costs p * p numbers a task, however many rows there are. One pass serves any list of
ridge penalties.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import RDD, cloudpickle
from pyspark.sql import DataFrame

from faremill.operators.gradient import Block, Layout, TrainedModel, Training, blocks_of, loss_of, summed

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Inputs of a model: beyond it, products of all pairs no longer fit a task's memory several times over.
MAX_INPUTS = 2000


@dataclass(frozen=True)
class Gram:
    """Sums over all rows: ``xx`` and ``xy`` with a last input of ones for the intercept, ``yy`` and rows."""

    xx: np.ndarray
    xy: np.ndarray
    yy: float
    rows: int

    def squared_error(self, parameters: np.ndarray) -> float:
        """Sum of squared residuals of a linear model, from the sums alone."""
        return float(self.yy - 2 * parameters @ self.xy + parameters @ self.xx @ parameters)


class Design:
    """Products with the inputs of a block and a last input of ones.

    A one-hot input is never written out: its products are sums by category, so a row costs a few additions
    for each pair of columns, not a multiplication for each pair of inputs.
    """

    def __init__(self, block: Block, layout: Layout):
        self.dense = np.vstack([block.inputs, np.ones(len(block.label))])
        self.codes = block.codes(layout)
        self.sizes = layout.category_sizes
        self.starts = np.cumsum([layout.numeric, *layout.category_sizes])
        self.places = np.append(np.arange(layout.numeric), layout.size - 1)
        self.size = layout.size

    def times(self, parameters: np.ndarray) -> np.ndarray:
        """The inputs times the parameters, row by row."""
        out = parameters[self.places] @ self.dense
        for start, size, code in zip(self.starts, self.sizes, self.codes):
            out += np.append(parameters[start : start + size], 0.0)[code]
        return out

    def sums(self, weight: np.ndarray) -> np.ndarray:
        """The sum of every input, weighted by row."""
        out = np.empty(self.size)
        out[self.places] = self.dense @ weight
        for start, size, code in zip(self.starts, self.sizes, self.codes):
            out[start : start + size] = np.bincount(code, weight, size + 1)[:size]
        return out

    def products(self, *weights: np.ndarray) -> list[np.ndarray]:
        """The weighted sums of the products of all pairs of inputs."""
        found = [np.zeros((self.size, self.size)) for _ in weights]
        for out, weight in zip(found, weights):
            weighted = self.dense * weight
            out[np.ix_(self.places, self.places)] = weighted @ self.dense.T
            for start, size, code in zip(self.starts, self.sizes, self.codes):
                own = np.arange(start, start + size)
                for place, line in zip(self.places, weighted):
                    out[place, own] = out[own, place] = np.bincount(code, line, size + 1)[:size]
                out[own, own] = out[-1, own]
        for j, (start, size, code) in enumerate(zip(self.starts, self.sizes, self.codes)):
            for k in range(j):
                shape = (self.sizes[k] + 1, size + 1)
                both, across = self.codes[k] * shape[1] + code, slice(self.starts[k], self.starts[k] + shape[0] - 1)
                for out, weight in zip(found, weights):
                    pairs = np.bincount(both, weight, shape[0] * shape[1]).reshape(shape)[:-1, :-1]
                    out[across, start : start + size], out[start : start + size, across] = pairs, pairs.T
        return found


def _checked(layout: Layout) -> int:
    if layout.hidden:
        raise ValueError("a linear layout has no hidden layers")
    if layout.size > MAX_INPUTS:
        raise ValueError(f"{layout.size} inputs; up to {MAX_INPUTS} are summed pairwise")
    return layout.size


def _summed(rows: DataFrame | RDD, kernel, size: int, layout: Layout) -> np.ndarray:
    """The sum over rows, or over blocks that more passes read."""
    blocks = blocks_of(rows, layout)
    try:
        return summed(blocks, kernel, size)
    finally:
        if blocks is not rows:
            blocks.unpersist()


def gram(rows: DataFrame | RDD, layout: Layout) -> Gram:
    """One pass over compact rows with ``label``, or blocks of them."""
    p = _checked(layout)

    def kernel(block: Block) -> np.ndarray:
        label, x = block.label, Design(block, layout)
        xx = x.products(np.ones(len(label)))[0]
        return np.concatenate([xx.ravel(), x.sums(label), [label @ label, len(label)]])

    sums = _summed(rows, kernel, p * p + p + 2, layout)
    return Gram(sums[: p * p].reshape(p, p), sums[p * p : p * p + p], sums[-2], int(sums[-1]))


def solved(sums: Gram, alpha: float = 0.0) -> np.ndarray:
    """Slopes and, last, the intercept: ``alpha`` penalises the squared slopes, never the intercept.

    Without penalty, inputs that add up to each other (one-hot blocks) get the least slopes of all
    that fit equally well.
    """
    n = max(sums.rows, 1)
    mean_x, mean_y = sums.xx[-1, :-1] / n, sums.xy[-1] / n
    centred = sums.xx[:-1, :-1] - n * np.outer(mean_x, mean_x)
    towards = sums.xy[:-1] - n * mean_x * mean_y
    values, vectors = np.linalg.eigh(centred)
    kept = values > max(values.max(initial=0.0), 0.0) * 1e-11
    scale = np.where(kept, 1.0 / np.where(kept, values + alpha, 1.0), 0.0)
    slopes = vectors @ (scale * (vectors.T @ towards))
    return np.append(slopes, mean_y - mean_x @ slopes)


def ridge_path(rows: DataFrame, layout: Layout, alphas: Sequence[float]) -> list[TrainedModel]:
    """A model per penalty (0: ordinary least squares), all from one pass."""
    sums = gram(rows, layout)
    return [TrainedModel(layout, solved(sums, alpha), [{"alpha": alpha}]) for alpha in alphas]


# --- robust loss ------------------------------------------------------------------------


def fit_huber(rows: DataFrame | RDD, layout: Layout, training: Training) -> TrainedModel:
    """The minimum of the mean Huber loss with L1 and L2 penalties on the slopes.

    Proximal Newton: a pass gives the gradient, the products of the rows inside the loss's quadratic
    part, and those of all rows weighted so that they bound the loss from above. A second pass compares
    steps towards the minimum of either model; the bound's always lowers the objective, Newton's soon
    lands on the minimum. Some tens of passes, not thousands; each reads all rows, in any layout, as blocks
    that the executors keep meanwhile.
    """
    if isinstance(rows, DataFrame):
        blocks = blocks_of(rows, layout)
        try:
            return fit_huber(blocks, layout, training)
        finally:
            blocks.unpersist()
    penalised = np.append(np.ones(layout.size - 1), 0.0)
    parameters = solved(gram(rows, layout), 1.0)
    history: list[dict] = []
    for _ in range(training.max_epochs):
        state = huber_state(rows, parameters, layout, training)
        gap = float(np.abs(conditions(state, parameters, training)).max())
        history.append({"objective": state.objective, "gap": gap})
        if gap <= training.tolerance:
            break
        trials = []
        for curve, steps in ((state.inside, (1.0, 0.5, 0.25, 0.1)), (state.bound, (1.0,))):
            smooth = curve + np.diag(training.l2 * penalised) + 1e-12 * np.eye(layout.size)
            target = penalised_minimum(smooth, curve @ parameters - state.gradient, training.l1 * penalised, parameters)
            trials += [parameters + t * (target - parameters) for t in steps]
        best = int(np.argmin(objectives := huber_objectives(rows, trials, layout, training)))
        if objectives[best] >= state.objective:
            break  # no better in the precision of the sums
        parameters = trials[best]
    return TrainedModel(layout, parameters, history)


@dataclass(frozen=True)
class HuberState:
    """Means over all rows at given parameters, and the penalised objective."""

    objective: float
    gradient: np.ndarray
    inside: np.ndarray
    bound: np.ndarray


def _penalty(parameters: np.ndarray, training: Training) -> float:
    slopes = parameters[:-1]
    return float(training.l2 / 2 * slopes @ slopes + training.l1 * np.abs(slopes).sum())


def huber_state(rows: DataFrame | RDD, parameters: np.ndarray, layout: Layout, training: Training) -> HuberState:
    p = _checked(layout)

    def kernel(block: Block) -> np.ndarray:
        x = Design(block, layout)
        residual = x.times(parameters) - block.label
        value, slope = loss_of(residual, training)
        size = np.abs(residual)
        inside = (size <= training.huber_epsilon).astype(float)
        weight = training.huber_epsilon / np.maximum(size, training.huber_epsilon)
        products = [found.ravel() for found in x.products(inside, weight)]
        return np.concatenate([[len(residual), value.sum()], x.sums(slope), *products])

    sums = _summed(rows, kernel, 2 + p + 2 * p * p, layout)
    means = sums[1:] / max(sums[0], 1.0)
    inside, bound = means[1 + p :].reshape(2, p, p)
    return HuberState(means[0] + _penalty(parameters, training), means[1 : 1 + p], inside, bound)


def huber_objectives(
    rows: DataFrame | RDD, trials: Sequence[np.ndarray], layout: Layout, training: Training
) -> np.ndarray:
    """The objective of several parameters, in one pass."""

    def kernel(block: Block) -> np.ndarray:
        x = Design(block, layout)
        losses = [loss_of(x.times(trial) - block.label, training)[0].sum() for trial in trials]
        return np.append(losses, len(block.label))

    sums = _summed(rows, kernel, len(trials) + 1, layout)
    return sums[:-1] / max(sums[-1], 1.0) + np.array([_penalty(t, training) for t in trials])


def conditions(state: HuberState, parameters: np.ndarray, training: Training) -> np.ndarray:
    """What is left of the objective's gradient where no penalty can balance it; all zero at the minimum."""
    slopes = np.append(parameters[:-1], 0.0)
    l1 = np.append(np.full(len(slopes) - 1, training.l1), 0.0)
    smooth = state.gradient + training.l2 * slopes
    at_zero = np.sign(smooth) * np.maximum(np.abs(smooth) - l1, 0.0)
    return np.where(slopes != 0, smooth + l1 * np.sign(slopes), at_zero)


def penalised_minimum(a: np.ndarray, b: np.ndarray, l1: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The minimum of ``w.a.w / 2 - b.w + sum(l1 * |w|)`` for positive definite ``a``.

    Active set: signs are held while a minimum is solved for; a slope that would change its sign
    stops at zero and leaves the set, one that the gradient pushes off zero joins it.
    """
    w = start.copy()
    sign = np.sign(w)
    active = (l1 == 0) | (w != 0)
    for _ in range(50 * len(w)):
        chosen = np.flatnonzero(active)
        target = np.linalg.solve(a[np.ix_(chosen, chosen)], b[chosen] - l1[chosen] * sign[chosen])
        now = w[chosen]
        turned = (l1[chosen] > 0) & (sign[chosen] * target < 0)
        if turned.any():
            share = np.where(turned, now / np.where(turned, now - target, 1.0), np.inf)
            first = int(np.argmin(share))
            w[chosen] = now + share[first] * (target - now)
            w[chosen[first]] = 0.0
            active[chosen[first]] = False
            continue
        w[chosen] = target
        slope = a @ w - b
        excess = np.where(active, 0.0, np.abs(slope) - l1)
        worst = int(np.argmax(excess))
        if excess[worst] <= 1e-13:
            break
        active[worst], sign[worst] = True, -np.sign(slope[worst])
    return w
