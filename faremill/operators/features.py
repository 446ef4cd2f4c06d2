"""Feature preparation with ``pyspark.ml``: imputation, scaling, indexing and encoding."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    Imputer,
    OneHotEncoder,
    SQLTransformer,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.functions.money import clean_target

LABEL = "total_amount"
NUMERIC = ("passenger_count", "distance_km", "duration_sec", "speed_kmh", "hour_of_day")
CATEGORICAL = ("color", "pu_borough", "do_borough", "payment_type", "day_of_week", "month")


def column_modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent value per column (smallest on a tie), its rows and the NULL count.

    Values are counted with map-side combining for all columns in one scan; only distinct
    values are shuffled.
    """
    pairs = [
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns
    ]
    counts = (
        df.select(F.inline(F.array(*pairs)))
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    present = F.col("value").isNotNull()
    best = F.min(F.when(present, F.struct((-F.col("rows")).alias("order"), F.col("value"))))
    missing = F.sum(F.when(present, 0).otherwise(F.col("rows")))
    return (
        counts.groupBy("column")
        .agg(best.alias("best"), missing.alias("missing"))
        .select("column", F.col("best.value").alias("mode"), (-F.col("best.order")).alias("rows"), "missing")
    )


@dataclass(frozen=True)
class Preprocessor:
    """A fitted feature pipeline and the names of what it produces."""

    model: PipelineModel
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    category_sizes: tuple[int, ...]

    @property
    def labels(self) -> list[list[str]]:
        """The known values of each category, in the order of their indices."""
        return [list(values) for stage in self.model.stages for values in getattr(stage, "labelsArray", [])]

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``features`` (sparse vector), ``numeric_scaled`` and one index per category."""
        return self.model.transform(df)

    def compact(self, df: DataFrame, *keep: str) -> DataFrame:
        """``keep`` plus plain columns ``x0..`` (scaled numbers) and ``c0..`` (category index).

        A category unseen in training has an index beyond its vocabulary, which encodes as
        no category at all. Far smaller than one-hot vectors when rows travel to Python.
        """
        wide = self.transform(df).withColumn("_x", vector_to_array("numeric_scaled"))
        return wide.select(
            *keep,
            *[F.get("_x", F.lit(i)).alias(f"x{i}") for i in range(len(self.numeric))],
            *[F.col(f"{c}_index").cast("int").alias(f"c{j}") for j, c in enumerate(self.categorical)],
        )


def fit_preprocessor(
    train: DataFrame,
    numeric: Sequence[str] = NUMERIC,
    categorical: Sequence[str] = CATEGORICAL,
) -> Preprocessor:
    """Median and mode imputation, standardised numbers, one-hot categories.

    An unseen category becomes a zero vector: the indexer keeps it as an extra last label
    and the encoder drops the last one.
    """
    modes = {row["column"]: row["mode"] for row in column_modes(train, categorical).collect()}
    casts = [f"CAST(`{c}` AS DOUBLE) AS `{c}_number`" for c in numeric]
    casts += [
        f"COALESCE(CAST(`{c}` AS STRING), {_literal(modes.get(c))}) AS `{c}_text`"
        for c in categorical
    ]
    pipeline = Pipeline(
        stages=[
            SQLTransformer(statement=f"SELECT *, {', '.join(casts)} FROM __THIS__"),
            Imputer(
                strategy="median",
                inputCols=[f"{c}_number" for c in numeric],
                outputCols=[f"{c}_filled" for c in numeric],
            ),
            VectorAssembler(inputCols=[f"{c}_filled" for c in numeric], outputCol="numeric_raw"),
            StandardScaler(
                inputCol="numeric_raw", outputCol="numeric_scaled", withMean=True, withStd=True
            ),
            StringIndexer(
                inputCols=[f"{c}_text" for c in categorical],
                outputCols=[f"{c}_index" for c in categorical],
                handleInvalid="keep",
                stringOrderType="alphabetAsc",
            ),
            OneHotEncoder(
                inputCols=[f"{c}_index" for c in categorical],
                outputCols=[f"{c}_onehot" for c in categorical],
                dropLast=True,
            ),
            VectorAssembler(
                inputCols=["numeric_scaled", *[f"{c}_onehot" for c in categorical]],
                outputCol="features",
            ),
        ]
    )
    model = pipeline.fit(train)
    fitted = Preprocessor(model, tuple(numeric), tuple(categorical), ())
    return replace(fitted, category_sizes=tuple(len(values) for values in fitted.labels))


def with_log_target(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Add ``target`` (cleaned amount) and ``label`` = log1p(target)."""
    return df.withColumn("target", clean_target(label)).withColumn("label", F.log1p("target"))


def original_scale(prediction: str, clip: float | None = None):
    """Undo the log; ``clip`` bounds the log-scale prediction before it is raised."""
    value = F.col(prediction)
    return F.expm1(value if clip is None else F.least(value, F.lit(float(clip))))


def _literal(text: str | None) -> str:
    if text is None:
        return "''"
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
