"""Linear models on ``pyspark.ml`` and the evaluation of any set of predictions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fit_linear(train: DataFrame) -> LinearRegressionModel:
    """Ordinary least squares: one pass for the normal equations, solved on the driver."""
    return LinearRegression(
        featuresCol="features", labelCol="label", regParam=0.0, standardization=False
    ).fit(train)


def fit_ridge(train: DataFrame, alpha: float = 1.0) -> LinearRegressionModel:
    """Ridge with penalty ``alpha`` on the sum of squared errors and a free intercept.

    Spark averages the squared error and scales the label by its deviation, so the same
    penalty is ``alpha / rows * deviation`` in its terms.
    """
    facts = train.agg(
        F.count("label").alias("rows"), F.stddev_pop("label").alias("deviation")
    ).first()
    return LinearRegression(
        featuresCol="features",
        labelCol="label",
        regParam=alpha / facts["rows"] * facts["deviation"],
        elasticNetParam=0.0,
        standardization=False,
    ).fit(train)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_linear(path: str) -> LinearRegressionModel:
    return LinearRegressionModel.load(path)


def rmse(truth: Column, prediction: Column) -> Column:
    return F.sqrt(F.avg(F.pow(truth - prediction, F.lit(2))))


def mae(truth: Column, prediction: Column) -> Column:
    return F.avg(F.abs(truth - prediction))


def evaluate(
    scored: DataFrame, predictions: Mapping[str, str], truth: str = "target", split: str = "split"
) -> DataFrame:
    """Rows, RMSE and MAE per model and split; all models in one aggregate."""
    lines = [
        F.struct(F.lit(model).alias("model"), F.col(column).alias("prediction"))
        for model, column in predictions.items()
    ]
    return (
        scored.select(split, F.col(truth).alias("truth"), F.inline(F.array(*lines)))
        .groupBy("model", split)
        .agg(
            F.count(F.lit(1)).alias("rows"),
            rmse(F.col("truth"), F.col("prediction")).alias("rmse"),
            mae(F.col("truth"), F.col("prediction")).alias("mae"),
        )
    )
