"""Missing-value predicates and type-driven column lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .constants import NULL_TOKENS


def null_like(name: str) -> Column:
    """NULL, or text that trims and lower-cases to one of the missing-value tokens."""
    text = F.lower(F.trim(F.col(name)))
    return F.col(name).isNull() | text.isin(NULL_TOKENS)


def missing(field: T.StructField) -> Column:
    """The missing test that fits the column's type."""
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return F.col(field.name).isNull() | F.isnan(field.name)
    if isinstance(field.dataType, T.StringType):
        return null_like(field.name)
    return F.col(field.name).isNull()


def is_numeric(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.NumericType)


def is_measure(field: T.StructField) -> bool:
    return isinstance(field.dataType, (T.DoubleType, T.FloatType))


def split_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> tuple[list[str], list[str]]:
    """Names of the numeric and of the text columns, in schema order."""
    fields = [f for f in df.schema.fields if f.name not in exclude]
    numeric = [f.name for f in fields if is_numeric(f)]
    text = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    return numeric, text


def nan_to_null(name: str) -> Column:
    return F.nanvl(F.col(name), F.lit(None).cast("double"))
