"""Cleaning operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkcast.functions.calendar import basic_calendar
from sparkcast.functions.stats import NUMERIC_TYPES
from sparkcast.operators import ordered
from sparkcast.sources.tables import FLOAT_COLUMNS, INT_COLUMNS, KEY

STRATEGIES = ("drop", "fill", "ffill", "bfill")


def remove_duplicates(df: DataFrame) -> DataFrame:
    """Full-row distinct; NULLs compare equal.

    Runs as a hash aggregate on all columns, so copies of a hot row are
    merged map-side before the shuffle.
    """
    return df.dropDuplicates()


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with any NULL."""
    return df.na.drop("any", subset=list(subset) if subset else None)


def fill_values(df: DataFrame, values: dict) -> DataFrame:
    """Fill given columns with given values (type-coerced per column)."""
    cols = []
    for f in df.schema.fields:
        if f.name in values:
            cols.append(F.coalesce(F.col(f.name), F.lit(values[f.name]).cast(f.dataType)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def mode_value(df: DataFrame, col: str) -> Column:
    """Most frequent non-null value of ``col``, smallest on ties, as a scalar.

    Counted with a distributed ``groupBy`` (partial aggregation), then one
    global ``min`` of (-count, value): no single task ever holds the whole
    value -> count map.
    """
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    best = counts.agg(F.min(F.struct((-F.col("_n")).alias("k"), F.col(col).alias("v"))).alias("b"))
    return best.select("b.v").scalar()


def fill_median_mode(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Numeric columns get their exact median, others their mode.

    Only columns that hold a NULL are touched (one counting job finds them).
    A column that is NULL everywhere stays NULL (Q11).
    """
    cand = list(columns) if columns else df.columns
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cand]).first()
    todo = [c for c in cand if nulls[c]]
    if not todo:
        return df
    numeric = [c for c in todo if isinstance(df.schema[c].dataType, NUMERIC_TYPES)]
    other = [c for c in todo if c not in numeric]
    fills: dict[str, Column] = {}
    if numeric:
        med = ordered.quantile_columns(df, numeric, [0.5], name=lambda c, q: c).first()
        for c in numeric:
            if med[c] is not None:
                kind = df.schema[c].dataType
                if med[c] != int(med[c]) and isinstance(kind, T.IntegralType):
                    kind = T.DoubleType()  # a fractional median widens the column
                fills[c] = F.coalesce(F.col(c).cast(kind), F.lit(med[c]).cast(kind))
    for c in other:
        fills[c] = F.coalesce(F.col(c), mode_value(df, c))
    return df.withColumns(fills) if fills else df


def forward_fill(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    order_cols: Sequence[str] = KEY,
    chunk_rows: int | None = None,
) -> DataFrame:
    """Carry the last non-null value forward over one global order."""
    cols = list(columns) if columns else [c for c in df.columns if c not in order_cols]
    return ordered.fill_nulls_ordered(df, cols, order_cols, False, chunk_rows).drop(ordered.ORD)


def backward_fill(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    order_cols: Sequence[str] = KEY,
    chunk_rows: int | None = None,
) -> DataFrame:
    """P5: carry the next non-null value backward over one global order."""
    cols = list(columns) if columns else [c for c in df.columns if c not in order_cols]
    return ordered.fill_nulls_ordered(df, cols, order_cols, True, chunk_rows).drop(ordered.ORD)


def handle_missing_values(
    df: DataFrame,
    strategy: str = "drop",
    fill_value: dict | None = None,
    order_cols: Sequence[str] = KEY,
) -> DataFrame:
    """Dispatch on the strategy name; unknown names raise at once."""
    if strategy not in STRATEGIES:
        raise ValueError(f"Unknown strategy: {strategy}")
    if strategy == "drop":
        return drop_nulls(df)
    if strategy == "fill":
        return fill_values(df, fill_value) if fill_value else fill_median_mode(df)
    if strategy == "ffill":
        return forward_fill(df, order_cols=order_cols)
    return backward_fill(df, order_cols=order_cols)


def convert_data_types(df: DataFrame, quarantine: bool = False) -> DataFrame:
    """Date parse, 7 integer and 2 float columns, each only if present.

    Double -> bigint truncates toward zero as pandas does. With ANSI on, a
    bad string fails the job; ``quarantine=True`` uses ``try_cast`` instead
    (failed values become NULL).
    """
    cast = (lambda c, t: F.col(c).try_cast(t)) if quarantine else (lambda c, t: F.col(c).cast(t))
    out = []
    for f in df.schema.fields:
        c = f.name
        if c == "date" and not isinstance(f.dataType, T.DateType):
            if quarantine:
                out.append(F.try_to_timestamp(F.col(c).cast("string")).cast("date").alias(c))
            else:
                out.append(F.to_date(F.col(c)).alias(c))
        elif c in INT_COLUMNS:
            out.append(cast(c, "bigint").alias(c))
        elif c in FLOAT_COLUMNS:
            out.append(cast(c, "double").alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def convert_with_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """P7 with quarantine: (converted rows, rejected rows).

    Rows with a value that does not convert go to the second table as they
    came, with ``bad_cells`` (column, value, expected type); NULLs convert.
    """
    raw = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_raw")
    both = convert_data_types(df.select("*", raw), quarantine=True)
    types = {f.name: f.dataType.simpleString() for f in both.schema.fields}
    bad = [
        F.when(
            F.col("_raw")[c].isNotNull() & F.col(f"`{c}`").isNull(),
            F.struct(
                F.lit(c).alias("column"),
                F.col("_raw")[c].cast("string").alias("value"),
                F.lit(types[c]).alias("expected"),
            ),
        )
        for c in df.columns
    ]
    marked = both.withColumn("bad_cells", F.array_compact(F.array(*bad)))
    accepted = marked.where(F.size("bad_cells") == 0).select(*df.columns)
    return accepted, marked.where(F.size("bad_cells") > 0).select("_raw.*", "bad_cells")


def sort_data(df: DataFrame, by: Sequence[str] = ("date",)) -> DataFrame:
    """A global sort; use only at a sink (windows carry their own order)."""
    return df.orderBy(*by)


def add_basic_features(df: DataFrame, date_col: str = "date") -> DataFrame:
    """F1 on a table."""
    return df.withColumns(basic_calendar(date_col))


def transform_data(df: DataFrame, add_features: bool = True, sort: bool = True) -> DataFrame:
    """Dedupe, drop NULL rows, cast, (features), sort by date/product/store."""
    out = convert_data_types(drop_nulls(remove_duplicates(df)))
    if add_features:
        out = add_basic_features(out)
    return sort_data(out, KEY) if sort else out
