"""Fare regression from the enriched table to metrics, with row data kept on the cluster."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faremill.functions.calendar import calendar_features
from faremill.operators import gradient, least_squares, regression, sampling
from faremill.operators.features import (
    CATEGORICAL,
    LABEL,
    NUMERIC,
    Preprocessor,
    fit_preprocessor,
    original_scale,
    with_log_target,
)
from faremill.session import stored

# Loss, penalties and rate of the two gradient-trained regressors. Both are trained
# synchronously, so passes and hash batches take the place of row-wise updates.
HUBER = gradient.Training(
    loss="huber",
    huber_epsilon=0.1,
    l1=1e-4 * 0.15,
    l2=1e-4 * 0.85,
    max_epochs=100,
    tolerance=1e-8,
)
MLP = gradient.Training(
    loss="squared",
    optimiser="adam",
    rate=5e-3,
    l2=1e-4 / 200,
    batches=8,
    max_epochs=60,
    tolerance=1e-4,
    patience=10,
)
MLP_HIDDEN = (64, 32)
VALIDATION_SHARE = 0.1


def model_frame(trips: DataFrame, *keep: str) -> DataFrame:
    """Features, label and calendar columns of trips with a known amount."""
    source = [c for c in dict.fromkeys((LABEL, *NUMERIC, *CATEGORICAL)) if c in trips.columns]
    known = trips.filter(F.col(LABEL).isNotNull())
    return calendar_features(known.select(*source, "pickup_ts", *keep)).drop("pickup_ts")


def sampled_frame(
    frame: DataFrame,
    test_months: Sequence[str],
    unit: Column,
    test_fraction: float = 0.03,
    overall_fraction: float = 0.04,
) -> DataFrame:
    """Stratified sample of a model frame; leave it out to train on every row."""
    return sampling.temporal_sample(frame, test_months, unit, test_fraction, overall_fraction)


@dataclass(frozen=True)
class Prepared:
    """Training data written once: encoded rows of all splits and the encoder."""

    encoder: Preprocessor
    rows: DataFrame
    compact: bool

    def split(self, name: str) -> DataFrame:
        return self.rows.filter(F.col("split") == name)


def prepare(
    frame: DataFrame,
    test_months: Sequence[str],
    unit: Column,
    compact: bool,
    batches: int = MLP.batches,
) -> Prepared:
    """Split by month and ``unit``, fit the encoder on ``train`` and store encoded rows.

    Encoder and models read their input several times; both the split frame and the encoded rows are
    therefore stored in the shared checkpoint folder, in folders by split and, where compact, by
    ``part``: the mini-batch (or held-out rows) that a row's own hash puts it into. Cores, source files,
    their order and the number of partitions change neither.
    """
    labelled = with_log_target(sampling.temporal_split(frame, test_months, unit))
    columns = ["split", "target", "label"]
    split = stored(labelled.select(*columns, *NUMERIC, *CATEGORICAL), "split-rows", "split")
    encoder = fit_preprocessor(split.filter(F.col("split") == "train"))
    if not compact:
        rows = encoder.transform(split).select(*columns, "features")
        return Prepared(encoder, stored(rows, "encoded-rows", "split"), compact)
    rows = encoder.compact(split, *columns)
    share = F.pmod(F.xxhash64(*rows.columns), F.lit(1000))
    batch = F.pmod(F.xxhash64(F.lit("part"), *rows.columns), F.lit(batches)).cast("int")
    part = F.when(share < int(1000 * VALIDATION_SHARE), gradient.HELD_OUT).otherwise(batch)
    return Prepared(encoder, stored(rows.withColumn("part", part), "compact-rows", "split", "part"), compact)


def linear_metrics(prepared: Prepared, clip: float | None = None) -> DataFrame:
    model = regression.fit_linear(prepared.split("train"))
    return _vector_metrics(prepared, {"linear": model}, clip)


def ridge_metrics(prepared: Prepared, alpha: float = 1.0, clip: float | None = None) -> DataFrame:
    model = regression.fit_ridge(prepared.split("train"), alpha)
    return _vector_metrics(prepared, {"ridge": model}, clip)


def huber_metrics(
    prepared: Prepared, training: gradient.Training = HUBER, clip: float | None = None
) -> DataFrame:
    return _compact_metrics(prepared, "huber", fit_huber(prepared, training), clip)


def mlp_metrics(
    prepared: Prepared,
    training: gradient.Training = MLP,
    hidden: tuple[int, ...] = MLP_HIDDEN,
    clip: float | None = None,
) -> DataFrame:
    return _compact_metrics(prepared, "mlp", fit_compact(prepared, hidden, training), clip)


def layout_of(prepared: Prepared, hidden: tuple[int, ...] = ()) -> gradient.Layout:
    return gradient.Layout(len(prepared.encoder.numeric), prepared.encoder.category_sizes, hidden)


def fit_compact(
    prepared: Prepared, hidden: tuple[int, ...], training: gradient.Training
) -> gradient.TrainedModel:
    return gradient.fit(prepared.split("train"), layout_of(prepared, hidden), training)


def fit_linear(prepared: Prepared, alphas: Sequence[float] = (0.0,)) -> list[gradient.TrainedModel]:
    """Ordinary least squares (0) and ridge models of compact rows, all from one pass."""
    return least_squares.ridge_path(prepared.split("train"), layout_of(prepared), alphas)


def fit_huber(prepared: Prepared, training: gradient.Training = HUBER) -> gradient.TrainedModel:
    return least_squares.fit_huber(prepared.split("train"), layout_of(prepared), training)


def input_names(prepared: Prepared) -> list[str]:
    """A name for every parameter of a linear model, in order; the intercept last."""
    labels = prepared.encoder.labels
    blocks = [f"{c}={value}" for c, values in zip(prepared.encoder.categorical, labels) for value in values]
    return [*prepared.encoder.numeric, *blocks, "intercept"]


def optimality(prepared: Prepared, alpha: float = 1.0, tolerance: float = 1e-6) -> DataFrame:
    """(model, input, optimal): whether each parameter of the linear models meets its condition of a minimum.

    Least squares: residuals and inputs are orthogonal; ridge: up to the penalty's slope; Huber with L1:
    the slope of the loss equals the penalty's, or is no greater where the parameter is zero.
    """
    layout = layout_of(prepared)
    rows = gradient.blocks_of(prepared.split("train"), layout)  # all passes of all models read these
    try:
        sums = least_squares.gram(rows, layout)
        found = {}
        for name, penalty in (("linear", 0.0), ("ridge", alpha)):
            parameters = least_squares.solved(sums, penalty)
            slope = sums.xx @ parameters - sums.xy
            slope[:-1] += penalty * parameters[:-1]
            found[name] = slope / max(sums.rows, 1)
        robust = least_squares.fit_huber(rows, layout, HUBER)
        state = least_squares.huber_state(rows, robust.parameters, layout, HUBER)
        found["huber"] = least_squares.conditions(state, robust.parameters, HUBER)
    finally:
        rows.unpersist()
    lines = [(m, n, bool(abs(x) <= tolerance)) for m, left in found.items() for n, x in zip(input_names(prepared), left)]
    return prepared.rows.sparkSession.createDataFrame(lines, "model string, input string, optimal boolean")


def shortened(training: gradient.Training, max_epochs: int) -> gradient.Training:
    return replace(training, max_epochs=max_epochs)


def _vector_metrics(prepared: Prepared, models: dict, clip: float | None) -> DataFrame:
    scored = prepared.rows.filter(F.col("split") != "train")
    for name, model in models.items():
        scored = (
            model.transform(scored)
            .withColumn(name, original_scale("prediction", clip))
            .drop("prediction")
        )
    return regression.evaluate(scored, {name: name for name in models})


def _compact_metrics(
    prepared: Prepared, name: str, model: gradient.TrainedModel, clip: float | None
) -> DataFrame:
    scored = prepared.rows.filter(F.col("split") != "train").withColumn("_log", model.prediction())
    return regression.evaluate(scored.withColumn(name, original_scale("_log", clip)), {name: name})
