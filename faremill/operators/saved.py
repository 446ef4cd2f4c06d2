"""A trained regressor as one saved pipeline: from raw trips to an amount, in any later session.

The stages are Spark's own for the encoder, and three of this module's, which keep all they need as
parameters and so are saved and loaded like any other stage.
"""

from __future__ import annotations

import numpy as np
from pyspark import keyword_only
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faremill.functions.calendar import calendar_features
from faremill.operators.features import Preprocessor, original_scale
from faremill.operators.gradient import Layout, TrainedModel


def _param(name: str, doc: str, kind) -> Param:
    return Param(Params._dummy(), name, doc, typeConverter=kind)


class _Stage(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    def _put(self, values: dict) -> None:
        self._set(**{name: value for name, value in values.items() if value is not None})

    def _get(self, name: str):
        return self.getOrDefault(getattr(self, name))


class CalendarFeatures(_Stage):
    """Adds month, weekday and hour of the pick-up time."""

    inputCol = _param("inputCol", "pick-up time", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol: str | None = None):
        super().__init__()
        self._put(self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return calendar_features(dataset, self._get("inputCol"))


class CompactScore(_Stage):
    """Log-scale prediction of a linear model or network from the encoder's columns.

    Linear models are a plain expression: products of the numbers, and one look-up per category.
    """

    numericCol = _param("numericCol", "vector of scaled numbers", TypeConverters.toString)
    numeric = _param("numeric", "how many numbers", TypeConverters.toInt)
    indexCols = _param("indexCols", "category indices", TypeConverters.toListString)
    categorySizes = _param("categorySizes", "categories known to the encoder", TypeConverters.toListInt)
    hidden = _param("hidden", "widths of hidden layers", TypeConverters.toListInt)
    parameters = _param("parameters", "weights and biases, layer by layer", TypeConverters.toListFloat)
    outputCol = _param("outputCol", "prediction", TypeConverters.toString)

    @keyword_only
    def __init__(
        self,
        *,
        numericCol: str | None = None,
        numeric: int | None = None,
        indexCols: list[str] | None = None,
        categorySizes: list[int] | None = None,
        hidden: list[int] | None = None,
        parameters: list[float] | None = None,
        outputCol: str | None = None,
    ):
        super().__init__()
        self._put(self._input_kwargs)

    def model(self) -> TrainedModel:
        layout = Layout(self._get("numeric"), tuple(self._get("categorySizes")), tuple(self._get("hidden")))
        return TrainedModel(layout, np.array(self._get("parameters"), float))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        model = self.model()
        numbers = vector_to_array(F.col(self._get("numericCol")))
        inputs = [F.get(numbers, F.lit(i)) for i in range(model.layout.numeric)]
        inputs += [F.col(c).cast("int") for c in self._get("indexCols")]
        guess = model.prediction(inputs) if model.layout.hidden else linear_expression(model, inputs)
        return dataset.withColumn(self._get("outputCol"), guess)


class OriginalScale(_Stage):
    """Raises a log-scale prediction, bounded by ``clip`` where one is set."""

    inputCol = _param("inputCol", "log-scale prediction", TypeConverters.toString)
    outputCol = _param("outputCol", "amount", TypeConverters.toString)
    clip = _param("clip", "upper bound on the log scale", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCol: str | None = None, outputCol: str | None = None, clip: float | None = None):
        super().__init__()
        self._put(self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        clip = self._get("clip") if self.isDefined(self.clip) else None
        return dataset.withColumn(self._get("outputCol"), original_scale(self._get("inputCol"), clip))


def linear_expression(model: TrainedModel, inputs: list[Column]) -> Column:
    """The prediction of a model without hidden layers, without leaving the JVM."""
    layout, weights = model.layout, model.parameters
    total = F.lit(float(weights[-1]))
    for weight, number in zip(weights, inputs[: layout.numeric]):
        total = total + F.lit(float(weight)) * number
    start = layout.numeric
    for size, index in zip(layout.category_sizes, inputs[layout.numeric :]):
        block = F.array(*[F.lit(float(w)) for w in weights[start : start + size]])
        total = total + F.coalesce(F.get(block, index), F.lit(0.0))
        start += size
    return total


def amount_pipeline(
    encoder: Preprocessor,
    model: TrainedModel,
    clip: float | None = None,
    ts: str = "pickup_ts",
    prediction: str = "prediction",
) -> PipelineModel:
    """Everything between a raw trip and its predicted amount, as one model that can be saved."""
    log = f"{prediction}_log"
    score = CompactScore(
        numericCol="numeric_scaled",
        numeric=model.layout.numeric,
        indexCols=[f"{c}_index" for c in encoder.categorical],
        categorySizes=[int(n) for n in model.layout.category_sizes],
        hidden=[int(n) for n in model.layout.hidden],
        parameters=[float(x) for x in model.parameters],
        outputCol=log,
    )
    raised = OriginalScale(inputCol=log, outputCol=prediction, clip=clip)
    return PipelineModel([CalendarFeatures(inputCol=ts), *encoder.model.stages, score, raised])
