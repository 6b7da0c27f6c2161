"""Profiling.

Every report is a DataFrame (never a driver dict): one row per column (or per
pair of columns) and metric columns. Each family is one aggregate over the
table; exact quantiles go through ``ordered.quantiles`` (hash path for
bounded distinct counts, distributed sort otherwise).
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkcast.functions.stats import (
    NUMERIC_TYPES,
    kurt_sample,
    numeric_columns,
    skew_sample,
)
from sparkcast.operators import gram, ordered

DATE_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def _explode_rows(wide: DataFrame, rows: list[Column]) -> DataFrame:
    return wide.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def table_info(df: DataFrame) -> DataFrame:
    """Rows, columns, and per column dtype, missing count and percent."""
    n = F.count(F.lit(1))
    wide = df.agg(n.alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    ncols = len(df.columns)
    rows = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("dtype"),
            F.col("_rows").cast("bigint").alias("rows"),
            F.lit(ncols).cast("bigint").alias("columns"),
            F.col(f.name).cast("bigint").alias("missing"),
            F.try_divide(F.col(f.name) * 100.0, F.col("_rows")).alias("missing_pct"),
        )
        for f in df.schema.fields
    ]
    return _explode_rows(wide, rows)


def overview(df: DataFrame) -> DataFrame:
    """A1: rows, columns, duplicate rows, total missing (one row)."""
    total = df.agg(
        F.count(F.lit(1)).alias("rows"),
        sum((F.count_if(F.col(c).isNull()) for c in df.columns), F.lit(0)).alias("total_missing"),
    )
    distinct_rows = df.dropDuplicates().agg(F.count(F.lit(1)).alias("d"))
    return total.select(
        F.col("rows").cast("bigint").alias("rows"),
        F.lit(len(df.columns)).cast("bigint").alias("columns"),
        (F.col("rows") - distinct_rows.scalar()).cast("bigint").alias("duplicate_rows"),
        F.col("total_missing").cast("bigint").alias("total_missing"),
    )


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, unique): distinct non-null values per column.

    One pass: unpivoted to (column, value) and grouped twice, instead of a
    copy of every row for each distinct count of one aggregate.
    """

    def text(c):
        x = F.col(c)
        if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
            x = x + F.lit(0.0)  # -0.0 and 0.0 are one value
        return x.cast("string")

    kv = F.array(
        *[F.struct(F.lit(c).alias("column"), text(c).alias("value")) for c in columns or df.columns]
    )
    values = df.select(F.inline(kv)).groupBy("column", "value").agg(F.count(F.lit(1)).alias("_n"))
    return values.groupBy("column").agg(F.count("value").cast("bigint").alias("unique"))


def column_counts(df: DataFrame, exact: bool = True) -> DataFrame:
    """A2: per column missing, missing % (2 dp), distinct non-null, distinct % (2 dp)."""
    n = F.count(F.lit(1)).alias("_rows")
    wide = df.agg(n, *[F.count_if(F.col(c).isNull()).alias(f"{c}__m") for c in df.columns])
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col("_rows").alias("_rows"),
            F.col(f"{c}__m").cast("bigint").alias("missing"),
            F.round(F.try_divide(F.col(f"{c}__m") * 100.0, F.col("_rows")), 2).alias("missing_pct"),
        )
        for c in df.columns
    ]
    if exact:
        unique = distinct_counts(df)
    else:
        approx = df.agg(*[F.approx_count_distinct(c).alias(c) for c in df.columns])
        unique = _explode_rows(
            approx, [F.struct(F.lit(c).alias("column"), F.col(c).alias("unique")) for c in df.columns]
        )
    # both sides hold one row per column
    return _explode_rows(wide, rows).join(unique, "column", "left").select(
        "column",
        "missing",
        "missing_pct",
        F.coalesce("unique", F.lit(0).cast("bigint")).alias("unique"),
        F.round(F.try_divide(F.coalesce("unique", F.lit(0)) * 100.0, F.col("_rows")), 2).alias("unique_pct"),
    )


def numeric_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A3: min, max, mean (2 dp), median, std (2 dp), zeros, zeros %, q1, q3, iqr."""
    cols = list(columns) if columns else numeric_columns(df.schema)
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for c in cols:
        x = F.col(c)
        aggs += [
            F.min(x).cast("double").alias(f"{c}__min"),
            F.max(x).cast("double").alias(f"{c}__max"),
            F.avg(x).alias(f"{c}__mean"),
            F.stddev_samp(x).alias(f"{c}__std"),
            F.count_if(x == 0).alias(f"{c}__z"),
        ]
    wide = df.agg(*aggs)
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"{c}__min").alias("min"),
            F.col(f"{c}__max").alias("max"),
            F.round(F.col(f"{c}__mean"), 2).alias("mean"),
            F.round(F.col(f"{c}__std"), 2).alias("std"),
            F.col(f"{c}__z").cast("bigint").alias("zeros"),
            F.round(F.try_divide(F.col(f"{c}__z") * 100.0, F.col("_rows")), 2).alias("zeros_pct"),
        )
        for c in cols
    ]
    simple = _explode_rows(wide, rows)
    q = ordered.quantiles(df, cols, [0.25, 0.5, 0.75])
    qw = q.groupBy("column").agg(
        F.max(F.when(F.col("q") == 0.25, F.col("value"))).alias("q1"),
        F.max(F.when(F.col("q") == 0.5, F.col("value"))).alias("median"),
        F.max(F.when(F.col("q") == 0.75, F.col("value"))).alias("q3"),
    )
    # both sides hold one row per column
    out = simple.join(qw, "column", "left")
    return out.select(
        "column", "min", "max", "mean", "median", "std", "zeros", "zeros_pct", "q1", "q3",
        (F.col("q3") - F.col("q1")).alias("iqr"),
    )


def datetime_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A4: min, max and range in whole days per date/timestamp column."""
    cols = list(columns) if columns else [
        f.name for f in df.schema.fields if isinstance(f.dataType, DATE_TYPES)
    ]
    wide = df.agg(
        *[F.min(F.col(c)).cast("timestamp").alias(f"{c}__lo") for c in cols],
        *[F.max(F.col(c)).cast("timestamp").alias(f"{c}__hi") for c in cols],
    )
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"{c}__lo").alias("min"),
            F.col(f"{c}__hi").alias("max"),
            F.floor(
                (F.unix_micros(F.col(f"{c}__hi")) - F.unix_micros(F.col(f"{c}__lo"))) / 86_400_000_000
            )
            .cast("bigint")
            .alias("range_days"),
        )
        for c in cols
    ]
    return _explode_rows(wide, rows)


def top_values(df: DataFrame, columns: Sequence[str] | None = None, k: int = 5) -> DataFrame:
    """A5: the k most frequent non-null values per column (ties by value).

    Values are counted per (column, value) with one distributed groupBy over
    the unpivoted columns; the top-k pick is a window per column over the
    count table (one row per distinct value), not over data rows.
    """
    cols = list(columns) if columns else [
        f.name
        for f in df.schema.fields
        if not isinstance(f.dataType, NUMERIC_TYPES + DATE_TYPES)
    ]
    kv = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])
        ).alias("_kv")
    ).select("_kv.*").where(F.col("value").isNotNull())
    counts = kv.groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
    # ``rank <= k`` over row_number is planned as a WindowGroupLimit: each
    # task keeps only its local top k per column before the shuffle
    w = Window.partitionBy("column").orderBy(F.desc("count"), F.asc("value"))
    return (
        counts.withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= k)
        .select("column", F.col("rank").cast("bigint").alias("rank"), "value", F.col("count").cast("bigint").alias("count"))
    )


def correlation_long(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson r for every pair (both orders and the diagonal), unrounded;
    NULL where a side is constant."""
    cols = list(columns) if columns else numeric_columns(df.schema)
    return gram.pair_correlations(df, cols).select("col1", "col2", "r")


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A6 as the reference reports it: 3 dp."""
    return correlation_long(df, columns).select(
        "col1", "col2", F.round(F.col("r"), 3).alias("correlation")
    )


def high_correlations(df: DataFrame, columns: Sequence[str] | None = None, threshold: float = 0.7) -> DataFrame:
    """Upper-triangle pairs with |r| > threshold (tested before rounding)."""
    cols = list(columns) if columns else numeric_columns(df.schema)
    return (
        gram.pair_correlations(df, cols)
        .where(F.col("a") < F.col("b"))
        .where(F.abs(F.col("r")) > threshold)
        .select("col1", "col2", F.round(F.col("r"), 3).alias("correlation"))
    )


def target_statistics(df: DataFrame, target_col: str = "target_demand") -> DataFrame:
    """A8 (+A9 quantiles): one row."""
    x = F.col(target_col)
    base = df.agg(
        F.round(F.avg(x), 2).alias("mean"),
        F.round(F.stddev_samp(x), 2).alias("std"),
        F.min(x).cast("double").alias("min"),
        F.max(x).cast("double").alias("max"),
        F.round(skew_sample(x), 2).alias("skewness"),
        F.round(kurt_sample(x), 2).alias("kurtosis"),
    )
    q = target_quantiles(df, target_col)
    # the one-row quantile frame rides along as a single struct scalar subquery
    qs = q.select(F.struct(*q.columns).alias("_q")).scalar()
    return base.withColumn("_q", qs).select(
        "mean", "_q.median", "std", "min", "max", "skewness", "kurtosis",
        "_q.q10", "_q.q25", "_q.q50", "_q.q75", "_q.q90",
    )


TARGET_QS = [0.1, 0.25, 0.5, 0.75, 0.9]


def target_quantiles(df: DataFrame, target_col: str = "target_demand") -> DataFrame:
    """q10, q25, q50 (= median), q75, q90."""
    w = ordered.quantile_columns(df, [target_col], TARGET_QS, name=lambda c, q: f"q{int(round(q * 100))}")
    return w.withColumn("median", F.col("q50"))


def value_ranges(df: DataFrame, target_col: str = "target_demand") -> DataFrame:
    """Bucket counts <=10, (10,20], (20,30], (30,40], >40 as one long table."""
    x = F.col(target_col)
    buckets = [
        ("0-10", x <= 10),
        ("11-20", (x > 10) & (x <= 20)),
        ("21-30", (x > 20) & (x <= 30)),
        ("31-40", (x > 30) & (x <= 40)),
        ("40+", x > 40),
    ]
    wide = df.agg(*[F.count_if(c).alias(f"_b{i}") for i, (_, c) in enumerate(buckets)])
    rows = [
        F.struct(F.lit(name).alias("bucket"), F.col(f"_b{i}").cast("bigint").alias("count"))
        for i, (name, _) in enumerate(buckets)
    ]
    return _explode_rows(wide, rows)


def profile_report(df: DataFrame, target_col: str = "target_demand") -> DataFrame:
    """A10: A1-A9 as one long table (section, column, metric, value, text).

    Numeric metrics sit in ``value`` (double), text metrics (dtype, dates,
    top values) in ``text``. A missing target column gives an error row. The
    table is written once to the checkpoint folder; every section reads that.
    """
    df = df.checkpoint(eager=True)

    def longify(section: str, frame: DataFrame, key: str | None, metrics: list[str]) -> DataFrame:
        kcol = F.col(key) if key else F.lit(None).cast("string")
        num = [
            F.struct(
                F.lit(section).alias("section"),
                kcol.alias("column"),
                F.lit(m).alias("metric"),
                F.col(m).cast("double").alias("value"),
                F.lit(None).cast("string").alias("text"),
            )
            for m in metrics
        ]
        return frame.select(F.explode(F.array(*num)).alias("_r")).select("_r.*")

    parts = [
        longify("overview", overview(df), None, ["rows", "columns", "duplicate_rows", "total_missing"]),
        longify("columns", column_counts(df), "column", ["missing", "missing_pct", "unique", "unique_pct"]),
        longify(
            "numeric",
            numeric_summary(df),
            "column",
            ["min", "max", "mean", "median", "std", "zeros", "zeros_pct", "q1", "q3", "iqr"],
        ),
    ]
    parts.append(
        table_info(df).select(
            F.lit("columns").alias("section"),
            "column",
            F.lit("dtype").alias("metric"),
            F.lit(None).cast("double").alias("value"),
            F.col("dtype").alias("text"),
        )
    )
    dcols = [f.name for f in df.schema.fields if isinstance(f.dataType, DATE_TYPES)]
    if dcols:
        dt = datetime_summary(df, dcols)
        parts.append(longify("datetime", dt, "column", ["range_days"]))
        parts.append(
            dt.select(
                F.explode(
                    F.array(
                        *[
                            F.struct(
                                F.lit("datetime").alias("section"),
                                F.col("column"),
                                F.lit(m).alias("metric"),
                                F.lit(None).cast("double").alias("value"),
                                F.col(m).cast("string").alias("text"),
                            )
                            for m in ("min", "max")
                        ]
                    )
                ).alias("_r")
            ).select("_r.*")
        )
    others = [f.name for f in df.schema.fields if not isinstance(f.dataType, NUMERIC_TYPES + DATE_TYPES)]
    if others:
        tv = top_values(df, others)
        parts.append(
            tv.select(
                F.lit("top_values").alias("section"),
                "column",
                F.concat(F.lit("top"), F.col("rank").cast("string")).alias("metric"),
                F.col("count").cast("double").alias("value"),
                F.col("value").alias("text"),
            )
        )
    ncols = numeric_columns(df.schema)
    if len(ncols) >= 2:
        corr = correlation_long(df, ncols).checkpoint(eager=True)  # a row per pair
        place = {c: i for i, c in enumerate(ncols)}
        upper = F.lit(False)
        for a, b in combinations(place, 2):
            upper = upper | ((F.col("col1") == a) & (F.col("col2") == b))
        for section, rows in (
            ("correlation", corr),
            ("high_correlation", corr.where(upper & (F.abs("r") > 0.7))),
        ):
            parts.append(
                rows.select(
                    F.lit(section).alias("section"),
                    F.col("col1").alias("column"),
                    F.col("col2").alias("metric"),
                    F.round(F.col("r"), 3).alias("value"),
                    F.lit(None).cast("string").alias("text"),
                )
            )
    if target_col in df.columns:
        ts = target_statistics(df, target_col)
        parts.append(
            longify(
                "target",
                ts,
                None,
                ["mean", "median", "std", "min", "max", "skewness", "kurtosis", "q10", "q25", "q50", "q75", "q90"],
            ).withColumn("column", F.lit(target_col))
        )
        parts.append(
            value_ranges(df, target_col).select(
                F.lit("value_ranges").alias("section"),
                F.lit(target_col).alias("column"),
                F.col("bucket").alias("metric"),
                F.col("count").cast("double").alias("value"),
                F.lit(None).cast("string").alias("text"),
            )
        )
    else:
        spark = df.sparkSession
        parts.append(
            spark.createDataFrame(
                [("target", target_col, "error", None, f"Target column '{target_col}' not found")],
                "section string, column string, metric string, value double, text string",
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, min, 25 %, 50 %, 75 %, max, std per numeric and date
    column (exact quartiles; dates as days since 1970-01-01)."""
    dates = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DateType)]
    cols = list(columns) if columns else [*dates, *numeric_columns(df.schema)]
    df = df.withColumns({c: F.unix_date(c) for c in cols if c in dates})
    wide = df.agg(
        *[
            e
            for c in cols
            for e in (
                F.count(F.col(c)).alias(f"{c}__n"),
                F.avg(F.col(c)).alias(f"{c}__mean"),
                F.min(F.col(c)).cast("double").alias(f"{c}__min"),
                F.max(F.col(c)).cast("double").alias(f"{c}__max"),
                F.stddev_samp(F.col(c)).alias(f"{c}__std"),
            )
        ]
    )
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"{c}__n").cast("bigint").alias("count"),
            F.col(f"{c}__mean").alias("mean"),
            F.col(f"{c}__min").alias("min"),
            F.col(f"{c}__max").alias("max"),
            F.col(f"{c}__std").alias("std"),
        )
        for c in cols
    ]
    simple = _explode_rows(wide, rows)
    q = ordered.quantiles(df, cols, [0.25, 0.5, 0.75]).groupBy("column").agg(
        F.max(F.when(F.col("q") == 0.25, F.col("value"))).alias("p25"),
        F.max(F.when(F.col("q") == 0.5, F.col("value"))).alias("p50"),
        F.max(F.when(F.col("q") == 0.75, F.col("value"))).alias("p75"),
    )
    return simple.join(q, "column", "left").select(
        "column", "count", "mean", "min", "p25", "p50", "p75", "max", "std"
    )
