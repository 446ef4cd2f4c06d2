"""Catalog and schema inspection as small DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def list_tables(spark: SparkSession, database: str = "default") -> DataFrame:
    rows = [(t.name, t.tableType, t.isTemporary) for t in spark.catalog.listTables(database)]
    return spark.createDataFrame(rows, "name string, table_type string, is_temporary boolean")


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type and nullability."""
    rows = [
        (i, f.name, f.dataType.simpleString(), f.nullable)
        for i, f in enumerate(df.schema.fields, start=1)
    ]
    return df.sparkSession.createDataFrame(
        rows, "position int, name string, type string, nullable boolean"
    )


def column_names(df: DataFrame) -> list[str]:
    return list(df.columns)


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in exclude
    ]
