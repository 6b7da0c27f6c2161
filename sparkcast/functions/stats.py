"""Numeric helpers: safe division, sample moments, null-safe correlation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(a: str | Column, b: str | Column) -> Column:
    """NULL instead of an ANSI DIVIDE_BY_ZERO error (Q10)."""
    return F.try_divide(col_(a), col_(b))


def skew_sample(c: str | Column) -> Column:
    """Bias-corrected skewness (pandas ``skew``); NULL when n < 3."""
    x = col_(c)
    n = F.count(x).cast("double")
    g1 = F.skewness(x)
    return F.when(n >= 3, g1 * F.sqrt(n * (n - 1)) / (n - 2))


def kurt_sample(c: str | Column) -> Column:
    """Bias-corrected excess kurtosis (pandas ``kurtosis``); NULL when n < 4."""
    x = col_(c)
    n = F.count(x).cast("double")
    g2 = F.kurtosis(x)
    return F.when(n >= 4, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))


NUMERIC_TYPES = (
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.DecimalType,
)


def numeric_columns(schema: T.StructType, exclude: tuple = ()) -> list[str]:
    """Every numeric column, in schema order."""
    return [
        f.name
        for f in schema.fields
        if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in exclude
    ]


def int_float_columns(schema: T.StructType, exclude: tuple = ()) -> list[str]:
    """P11 (drift / explorer form): 64-bit integer and double columns only."""
    return [
        f.name
        for f in schema.fields
        if isinstance(f.dataType, (T.LongType, T.DoubleType)) and f.name not in exclude
    ]
