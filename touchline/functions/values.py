"""Null handling and typed casts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that a data-frame reader takes for "missing".
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


_NULL_LIST = ", ".join(f"'{token}'" for token in NULL_TOKENS)


def text_or_null(column: str) -> Column:
    return F.expr(f"if(`{column}` in ({_NULL_LIST}), null, `{column}`)")


def typed(column: str, kind: T.DataType) -> Column:
    """Cast a text column to ``kind``; what does not fit becomes null. ``12.0`` is a valid integer,
    ``12.7`` is none.

    Of the null texts only NaN is a number to Spark, the others fail the cast.
    """
    if isinstance(kind, T.StringType):
        return text_or_null(column)
    number = F.col(column).try_cast("double")
    if isinstance(kind, T.DoubleType):
        return F.when(~F.isnan(number), number)
    return F.when(number == F.floor(number), number.try_cast(kind))


def typed_columns(df: DataFrame, schema: T.StructType, also: Sequence[str] = ()) -> DataFrame:
    """Project a text frame to ``schema``; the columns ``also`` come along as they are."""
    return df.select(*(typed(f.name, f.dataType).alias(f.name) for f in schema), *also)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in a double and the bare token NaN in a text both mean "missing"."""
    fixed = {}
    for field in df.schema:
        value = F.col(field.name)
        if isinstance(field.dataType, T.DoubleType):
            fixed[field.name] = F.when(~F.isnan(value), value)
        elif isinstance(field.dataType, T.StringType):
            fixed[field.name] = F.when(~value.isin("NaN", '"NaN"'), value)
    return df.withColumns(fixed)
