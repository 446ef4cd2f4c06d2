from __future__ import annotations

import os
import subprocess
import sys
from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from faremill.functions import unit_hash
from faremill.operators import gradient, least_squares, regression, saved
from faremill.operators.features import column_modes, fit_preprocessor, with_log_target
from faremill.operators.gradient import Layout, Training
from faremill.plans import modelling


@pytest.fixture(scope="module")
def frame(spark):
    """Amounts follow exp of a linear rule of distance and colour."""
    n = 3000
    random = np.random.default_rng(5)
    km = random.uniform(1, 20, n)
    color = random.choice(["green", "yellow"], n)
    months = np.array(["2024-07", "2024-08", "2024-09", "2024-10"])[np.arange(n) % 4]
    log = 0.5 + 0.1 * km + 0.4 * (color == "green") + random.normal(0, 0.01, n)
    pdf = pd.DataFrame(
        {
            "id": np.arange(n),
            "total_amount": np.expm1(log),
            "passenger_count": np.where(np.arange(n) % 10, 1.0 + np.arange(n) % 4, np.nan),
            "distance_km": km,
            "duration_sec": (km * 100).astype(int),
            "speed_kmh": km * 2 + random.normal(0, 1, n),
            "hour_of_day": np.arange(n) % 24,
            "color": color,
            "pu_borough": random.choice(["A", "B'", "C"], n),
            "do_borough": np.where(np.arange(n) % 9, "D", None),
            "payment_type": np.arange(n) % 3,
            "day_of_week": "Monday",
            "month": months,
        }
    )
    df = spark.createDataFrame(pdf)
    nan_free = F.when(~F.isnan("passenger_count"), F.col("passenger_count"))
    return df.withColumn("passenger_count", nan_free).cache()


@pytest.fixture(scope="module")
def vectors(frame):
    return modelling.prepare(frame, ["2024-10"], unit_hash("id"), compact=False)


@pytest.fixture(scope="module")
def compact(frame):
    return modelling.prepare(frame, ["2024-10"], unit_hash("id"), compact=True, batches=4)


def test_modes_prefer_the_smallest_on_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "c string")
    row = column_modes(df, ["c"]).first()
    assert (row["mode"], row["rows"], row["missing"]) == ("a", 2, 1)


def test_preprocessor_imputes_scales_and_zeroes_unseen(spark, frame, tmp_path):
    train = frame.filter("month <> '2024-10'")
    encoder = fit_preprocessor(train)
    assert encoder.category_sizes == (2, 3, 1, 3, 1, 3)
    width = 5 + sum(encoder.category_sizes)
    scaled = encoder.transform(train).select("features", "month").collect()
    matrix = np.array([r.features.toArray() for r in scaled])
    assert matrix.shape[1] == width
    assert matrix[:, 1:5].mean(axis=0) == pytest.approx(0, abs=1e-9)
    assert matrix[:, 1:5].std(axis=0, ddof=1) == pytest.approx(1)
    assert matrix[:, -3:].sum(axis=1) == pytest.approx(1)
    unseen = encoder.transform(frame.filter("month = '2024-10'")).select("features").collect()
    assert np.array([r.features.toArray()[-3:] for r in unseen]).sum() == 0
    path = str(tmp_path / "encoder")
    regression.save_model(encoder.model, path)
    again = regression.load_pipeline(path).transform(train).select("features").collect()
    assert again == [r for r in encoder.transform(train).select("features").collect()]


def test_compact_rows_encode_like_vectors(frame):
    encoder = fit_preprocessor(frame.filter("month <> '2024-10'"))
    both = encoder.transform(frame).select("id", "features").join(encoder.compact(frame, "id"), "id")
    layout = Layout(5, encoder.category_sizes)
    pdf = both.limit(200).toPandas()
    built = gradient.design_matrix(pdf[layout.columns].to_numpy(float), layout)
    assert built == pytest.approx(np.array([v.toArray() for v in pdf.features]))


def test_linear_and_ridge_recover_the_rule(vectors):
    for metrics in (modelling.linear_metrics(vectors), modelling.ridge_metrics(vectors)):
        rows = {r.split: r for r in metrics.collect()}
        assert set(rows) == {"val", "test"}
        assert rows["val"].rmse < 0.5 and rows["test"].rmse < 0.5 and rows["val"].mae <= rows["val"].rmse


def test_ridge_equals_closed_form(vectors):
    train = vectors.split("train")
    model = regression.fit_ridge(train, alpha=50.0)
    rows = train.select("features", "label").collect()
    x = np.array([r.features.toArray() for r in rows])
    y = np.array([r.label for r in rows])
    xc, yc = x - x.mean(axis=0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + 50.0 * np.eye(x.shape[1]), xc.T @ yc)
    assert model.coefficients.toArray() == pytest.approx(want, abs=1e-6)
    assert model.intercept == pytest.approx(y.mean() - x.mean(axis=0) @ want, abs=1e-6)


def test_linear_model_round_trip(vectors, tmp_path):
    model = regression.fit_linear(vectors.split("train"))
    regression.save_model(model, str(tmp_path / "m"))
    loaded = regression.load_linear(str(tmp_path / "m"))
    assert loaded.coefficients.toArray() == pytest.approx(model.coefficients.toArray())


@pytest.mark.parametrize("hidden, loss", [((), "huber"), ((6, 4), "squared")])
def test_distributed_gradient_equals_single_process(compact, hidden, loss):
    layout = Layout(5, compact.encoder.category_sizes, hidden)
    training = Training(loss=loss)
    parameters = np.random.default_rng(1).normal(0, 0.3, layout.size)
    rows = compact.split("train")
    total, slope, n = gradient.distributed_gradient(rows, parameters, layout, training)
    pdf = rows.filter("part >= 0").toPandas()
    inputs = gradient.design_matrix(pdf[layout.columns].to_numpy(float), layout)
    label = pdf["label"].to_numpy(float)
    want_loss, want = gradient.loss_and_gradient(parameters, inputs, label, layout, training)
    assert n == len(pdf) and total == pytest.approx(want_loss, rel=1e-9)
    assert slope == pytest.approx(want, rel=1e-9, abs=1e-9)
    step = 1e-6
    for i in range(0, layout.size, 7):
        moved = parameters.copy()
        moved[i] += step
        up, _ = gradient.loss_and_gradient(moved, inputs, label, layout, training)
        moved[i] -= 2 * step
        down, _ = gradient.loss_and_gradient(moved, inputs, label, layout, training)
        assert (up - down) / (2 * step) == pytest.approx(slope[i], rel=1e-3, abs=1e-2)


def test_full_batch_training_lowers_the_loss(compact):
    layout = Layout(5, compact.encoder.category_sizes)
    training = Training(rate=0.2, power_t=0.0, max_epochs=6)
    model = gradient.fit(compact.split("train").withColumn("part", F.lit(0)), layout, training)
    losses = [h["train_loss"] for h in model.history]
    assert len(losses) == 7 and losses == sorted(losses, reverse=True)


def test_huber_and_network_learn_and_round_trip(spark, compact, tmp_path):
    huber = modelling.fit_huber(compact)
    assert huber.history[-1]["objective"] < huber.history[0]["objective"] and huber.history[-1]["gap"] <= 1e-8
    few_batches = replace(modelling.MLP, batches=4, max_epochs=25)
    net = modelling.fit_compact(compact, (16, 8), few_batches)
    assert net.history[0]["val_rows"] > 0
    assert min(h["val_loss"] for h in net.history) < 0.2 * net.history[0]["val_loss"]
    net.save(spark, str(tmp_path / "net"))
    loaded = gradient.TrainedModel.load(spark, str(tmp_path / "net"))
    assert loaded.layout == net.layout and (loaded.parameters == net.parameters).all()
    rows = compact.split("val")
    pairs = rows.select(net.prediction().alias("a"), loaded.prediction().alias("b")).collect()
    assert [r.a for r in pairs] == [r.b for r in pairs]


def test_l1_drives_weights_to_zero(compact):
    layout = Layout(5, compact.encoder.category_sizes)
    heavy = Training(rate=0.1, power_t=0.0, l1=5.0, max_epochs=5)
    model = gradient.fit(compact.split("train").withColumn("part", F.lit(0)), layout, heavy)
    assert (model.parameters[:-1] == 0).all()


def test_evaluate_against_pandas(spark):
    rows = [("val", 1.0, 2.0), ("val", 3.0, 1.0), ("test", 2.0, 2.0)]
    df = spark.createDataFrame(rows, "split string, target double, p double")
    got = {r.split: r for r in regression.evaluate(df, {"m": "p"}).collect()}
    assert got["val"].rmse == pytest.approx(np.sqrt(2.5)) and got["val"].mae == pytest.approx(1.5)
    assert got["test"].rmse == 0 and got["test"].rows == 1


def test_clipped_prediction(spark):
    from faremill.operators.features import original_scale

    df = spark.createDataFrame([(1000.0,)], "p double")
    assert df.select(original_scale("p", clip=5.0)).first()[0] == pytest.approx(np.expm1(5.0))


def test_log_target(spark):
    df = with_log_target(spark.createDataFrame([(None,), (-1.0,), (9.0,)], "total_amount double").coalesce(1))
    assert [r.target for r in df.collect()] == [0.001, 0.001, 9.0]
    assert df.collect()[2].label == pytest.approx(np.log(10))


@pytest.mark.parametrize("partitions, fan", [(1, 32), (4, 32), (9, 2)])
def test_training_does_not_depend_on_the_layout(compact, partitions, fan, monkeypatch):
    """Equal parameters from any number of partitions, added by the driver or in groups first."""
    monkeypatch.setattr(gradient.summed, "__defaults__", (fan,))
    rows = compact.split("train").repartition(partitions).cache()
    layout = Layout(5, compact.encoder.category_sizes, (3,))
    model = gradient.fit(rows, layout, replace(modelling.MLP, batches=4, max_epochs=2))
    want = gradient.fit(compact.split("train"), layout, replace(modelling.MLP, batches=4, max_epochs=2))
    assert model.parameters == pytest.approx(want.parameters, abs=1e-9)
    robust = least_squares.fit_huber(rows, Layout(5, compact.encoder.category_sizes), modelling.HUBER)
    assert robust.parameters == pytest.approx(modelling.fit_huber(compact).parameters, abs=1e-7)


def test_gram_solves_every_penalty_and_singular_blocks(compact):
    layout = modelling.layout_of(compact)
    pdf = compact.split("train").toPandas()
    x = gradient.design_matrix(pdf[layout.columns].to_numpy(float), layout)
    y = pdf["label"].to_numpy(float)
    xc, yc = x - x.mean(axis=0), y - y.mean()
    models = modelling.fit_linear(compact, (0.0, 1.0, 50.0))
    least = np.linalg.lstsq(xc, yc, rcond=1e-10)[0]
    assert models[0].parameters[:-1] == pytest.approx(least, abs=1e-7)
    for model, alpha in zip(models[1:], (1.0, 50.0)):
        want = np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ yc)
        assert model.parameters[:-1] == pytest.approx(want, abs=1e-8)
        assert model.parameters[-1] == pytest.approx(y.mean() - x.mean(axis=0) @ want, abs=1e-8)
    sums = least_squares.gram(compact.split("train"), layout)
    residual = y - x @ models[1].parameters[:-1] - models[1].parameters[-1]
    assert sums.squared_error(models[1].parameters) == pytest.approx(residual @ residual, rel=1e-6)


def test_penalised_minimum_meets_its_conditions():
    draw = np.random.default_rng(8)
    for _ in range(20):
        half = draw.normal(size=(40, 12))
        a, b = half.T @ half / 40 + 1e-4 * np.eye(12), draw.normal(size=12)
        l1 = np.append(np.full(11, draw.uniform(0.05, 2.0)), 0.0)
        w = least_squares.penalised_minimum(a, b, l1, draw.normal(size=12) * draw.integers(0, 2, 12))
        slope = a @ w - b
        assert np.abs(np.where(w != 0, slope + l1 * np.sign(w), 0.0)).max() < 1e-9
        assert (np.abs(slope[w == 0]) <= l1[w == 0] + 1e-9).all()


def test_huber_minimum_beats_its_neighbours(compact):
    layout, training = modelling.layout_of(compact), replace(modelling.HUBER, l1=0.01)
    model = modelling.fit_huber(compact, training)
    assert (model.parameters[:-1] == 0).any() and (model.parameters[:-1] != 0).any()
    draw = np.random.default_rng(9)
    near = [model.parameters] + [model.parameters + draw.normal(size=layout.size) * 10.0**-k for k in (1, 2, 3, 4)]
    values = least_squares.huber_objectives(compact.split("train"), near, layout, training)
    assert values.argmin() == 0


def test_saved_pipelines_score_raw_trips_alike(spark, frame, compact, tmp_path):
    """A saved model needs nothing but its folder: a new session loads it and predicts the same."""
    raw = frame.drop("month", "day_of_week", "hour_of_day").withColumn("pickup_ts", F.expr("timestamp'2024-07-01' + make_dt_interval(0, id)"))
    models = dict(zip(("linear", "ridge"), modelling.fit_linear(compact, (0.0, 1.0))))
    models["huber"] = modelling.fit_huber(compact)
    models["mlp"] = modelling.fit_compact(compact, (4, 3), modelling.shortened(modelling.MLP, 2))
    for name, model in models.items():
        pipeline = saved.amount_pipeline(compact.encoder, model, clip=9.0)
        path = str(tmp_path / name)
        regression.save_model(pipeline, path)
        before = pipeline.transform(raw).select("id", "prediction").orderBy("id").collect()
        code = (
            "import sys; sys.path.insert(0, sys.argv[1])\n"
            "from faremill.session import get_session; from faremill.operators.regression import load_pipeline\n"
            "spark = get_session(master='local[1]')\n"
            "model = load_pipeline(sys.argv[2]); rows = spark.read.parquet(sys.argv[3])\n"
            "print(','.join(repr(r.prediction) for r in model.transform(rows).orderBy('id').collect()))"
        )
        if name == "mlp":
            raw.limit(50).write.mode("overwrite").parquet(str(tmp_path / "raw"))
            some = [r.id for r in spark.read.parquet(str(tmp_path / "raw")).orderBy("id").collect()]
            root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
            out = subprocess.run([sys.executable, "-c", code, root, path, str(tmp_path / "raw")], capture_output=True, text=True, check=True)
            known = {r.id: r.prediction for r in before}
            assert [float(x) for x in out.stdout.strip().splitlines()[-1].split(",")] == [known[i] for i in some]
        again = regression.load_pipeline(path).transform(raw).select("id", "prediction").orderBy("id").collect()
        assert again == before
        direct = compact.encoder.compact(saved.CalendarFeatures(inputCol="pickup_ts").transform(raw), "id")
        want = {r.id: r.p for r in direct.select("id", F.expm1(F.least(model.prediction(), F.lit(9.0))).alias("p")).collect()}
        assert all(r.prediction == pytest.approx(want[r.id], rel=1e-9) for r in before)
