"""Small frames in the shape of the given tables, with columns whose names clash with the operators' own."""

from pyspark.sql import functions as F


def documents(spark, rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    return frame.withColumns({c: F.lit("clash") for c in ("grp", "place", "leaf", "word", "root", "tie")})
