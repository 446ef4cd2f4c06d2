"""Registered queries on the encoder and the models, each comparable with SQL or its own conditions."""

from __future__ import annotations

import uuid
from dataclasses import replace

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.functions.portions import unit_hash
from faremill.operators import features, gradient, least_squares, regression, sampling, saved
from faremill.operators.category_index import category_index, onehot_counts
from faremill.plans import modelling
from faremill.session import ensure_checkpoint_dir, stored
from harness import trip_view as tv

ROW_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
ALPHAS = (0.0, 1.0, 100.0, 10000.0)


def _unit():
    return unit_hash(*ROW_KEYS, seed=43)


def split_frame(trips: DataFrame) -> DataFrame:
    frame = modelling.model_frame(trips, *ROW_KEYS)
    return features.with_log_target(sampling.temporal_split(frame, tv.TEST_MONTHS, _unit()))


def prepared(trips: DataFrame, compact: bool = True) -> modelling.Prepared:
    return modelling.prepare(modelling.model_frame(trips, *ROW_KEYS), tv.TEST_MONTHS, _unit(), compact)


def encoded_rows(trips: DataFrame) -> DataFrame:
    """Imputed, scaled and indexed features of every row; the encoder reads stored rows, several times."""
    frame = stored(split_frame(trips).select(*ROW_KEYS, "split", *features.NUMERIC, *features.CATEGORICAL), "split-rows")
    encoder = features.fit_preprocessor(frame.filter(F.col("split") == "train"))
    compact = encoder.compact(frame, *ROW_KEYS, "split")
    return compact.withColumns({f"x{i}": F.round(f"x{i}", 6) for i in range(len(encoder.numeric))})


def onehot(trips: DataFrame) -> DataFrame:
    frame = stored(split_frame(trips).select("split", *features.CATEGORICAL), "split-categories")
    table = category_index(frame.filter(F.col("split") == "train"), features.CATEGORICAL)
    return onehot_counts(frame, table, features.CATEGORICAL, "split")


def huber_gradient(trips: DataFrame) -> DataFrame:
    """Loss and gradient of the robust loss at fixed parameters."""
    made = prepared(trips)
    layout = modelling.layout_of(made)
    weights = [0.1 * (i + 1) for i in range(layout.numeric)]
    for block, size in enumerate(layout.category_sizes):
        weights += [0.05 * ((index + block) % 3) for index in range(size)]
    rows = made.split("train").withColumn("part", F.lit(0))
    loss, slope, n = gradient.distributed_gradient(rows, np.array([*weights, 2.0]), layout, modelling.HUBER)
    lines = [(name, n, float(loss), float(x)) for name, x in zip(modelling.input_names(made), slope)]
    table = trips.sparkSession.createDataFrame(lines, "input string, rows long, loss double, gradient double")
    return table.withColumns({"loss": F.round("loss", 6), "gradient": F.round("gradient", 6)})


def ridge_path(trips: DataFrame) -> DataFrame:
    """Distance and duration as inputs, one pass for all penalties."""
    rows = prepared(trips).split("train").select(F.col("x1").alias("x0"), F.col("x2").alias("x1"), "label")
    models = least_squares.ridge_path(rows, gradient.Layout(2), ALPHAS)
    lines = [(alpha, *[float(x) for x in model.parameters]) for alpha, model in zip(ALPHAS, models)]
    names = ("distance", "duration", "intercept")
    table = trips.sparkSession.createDataFrame(lines, f"alpha double, {', '.join(f'{n} double' for n in names)}")
    return table.withColumns({n: F.round(n, 8) for n in names})


def ols_closed_form(trips: DataFrame) -> DataFrame:
    """A line through every numeric input, all from one matrix."""
    made = prepared(trips)
    count = len(made.encoder.numeric)
    whole = least_squares.gram(made.split("train"), gradient.Layout(count))
    lines = []
    for i, name in enumerate(made.encoder.numeric):
        pick = [i, count]
        part = replace(whole, xx=whole.xx[np.ix_(pick, pick)], xy=whole.xy[pick])
        line = least_squares.solved(part)
        error = part.squared_error(line) / part.rows
        lines.append((name, *[float(x) for x in line], float(error)))
    names = ("slope", "intercept", "mean_squared_error")
    table = trips.sparkSession.createDataFrame(lines, f"input string, {', '.join(f'{n} double' for n in names)}")
    return table.withColumns({n: F.round(n, 8) for n in names})


def optimality(trips: DataFrame) -> DataFrame:
    return modelling.optimality(prepared(trips))


def network_forward(trips: DataFrame) -> DataFrame:
    """RMSE and MAE by split of a network with fixed weights."""
    layout = gradient.Layout(5, (), (3,))
    parameters = np.zeros(layout.size)
    (first, bias), (second, last) = gradient.layers(parameters, layout)
    first[...] = [[((3 * i + k) % 5 - 2) / 10 for k in range(3)] for i in range(5)]
    bias[...], second[...], last[...] = [0.0, 0.1, 0.2], [[0.1], [0.2], [0.3]], 2.0
    rows = prepared(trips).rows.withColumn("_log", gradient.TrainedModel(layout, parameters).prediction())
    scored = rows.withColumn("network", features.original_scale("_log", 6.0))
    metrics = regression.evaluate(scored, {"network": "network"})
    return metrics.withColumns({"rmse": F.round("rmse", 6), "mae": F.round("mae", 6)})


def saved_models(trips: DataFrame) -> DataFrame:
    """All four models saved, loaded and run on trips as stored: rows, and rows that the unsaved model scores otherwise."""
    made = prepared(trips)
    spark = trips.sparkSession
    models = dict(zip(("linear", "ridge"), modelling.fit_linear(made, (0.0, 1.0))))
    models["huber"] = modelling.fit_huber(made)
    models["mlp"] = modelling.fit_compact(made, modelling.MLP_HIDDEN, modelling.shortened(modelling.MLP, 1))
    folder = f"{ensure_checkpoint_dir(spark)}/models-{uuid.uuid4().hex}"
    scored_columns = ["pickup_ts", *[c for c in (*features.NUMERIC, *features.CATEGORICAL) if c in trips.columns]]
    known = sampling.temporal_split(
        trips.filter(F.col("total_amount").isNotNull()).withColumn("month", F.date_format("pickup_ts", "yyyy-MM")),
        tv.TEST_MONTHS,
        _unit(),
    )
    known = stored(known.select("split", *scored_columns), "scored-trips")  # every model reads them
    parts = []
    for name, model in models.items():
        regression.save_model(saved.amount_pipeline(made.encoder, model, clip=8.0), f"{folder}/{name}")
        scored = regression.load_pipeline(f"{folder}/{name}").transform(known)
        numbers = saved.vector_to_array(F.col("numeric_scaled"))
        inputs = [F.get(numbers, F.lit(i)) for i in range(model.layout.numeric)]
        inputs += [F.col(f"{c}_index").cast("int") for c in made.encoder.categorical]
        direct = scored.withColumn("_direct", model.prediction(inputs))
        apart = F.abs(F.col("prediction_log") - F.col("_direct")) > 1e-9 * (1 + F.abs("_direct"))
        off_scale = F.abs(F.log1p("prediction") - F.least("prediction_log", F.lit(8.0))) > 1e-9
        counts = direct.groupBy("split").agg(
            F.count(F.lit(1)).alias("rows"), F.count_if(F.coalesce(apart | off_scale, F.lit(True))).alias("differing")
        )
        parts.append(counts.select(F.lit(name).alias("model"), "split", "rows", "differing"))
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


QUERIES = {
    "encoded_rows": encoded_rows,
    "onehot_counts": onehot,
    "huber_gradient": huber_gradient,
    "ridge_path": ridge_path,
    "ols_closed_form": ols_closed_form,
    "model_optimality": optimality,
    "network_forward": network_forward,
    "saved_models": saved_models,
}
