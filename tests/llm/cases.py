"""Documents with everything that may go wrong: nulls, empty and long texts, ties, repeats, extra columns."""

from __future__ import annotations

from pyspark.sql import DataFrame

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows) -> DataFrame:
    """Rows of (doc_id, text, source)."""
    full = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows]
    return spark.createDataFrame(full, DOCUMENTS)


ODD = [
    (1, "a b c d e f", "x"),
    (2, None, "x"),
    (3, "", "y"),
    (None, "no id at all", "y"),
    (5, "null source", None),
    (6, "same same", "x"),
    (6, "same same", "x"),
    (7, "ü € 語 \t\n tab", "y"),
    (8, "word " * 30_000, "x"),
    (9, "a b c d e f", "x"),
]


def store(df: DataFrame, folder, name: str = "documents") -> str:
    """Write a table where a query looks for it."""
    df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)
