"""Exploration aggregates a dashboard draws."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkcast.functions.calendar import day_name
from sparkcast.functions.stats import int_float_columns
from sparkcast.operators import gram, ordered
from sparkcast.sources.tables import KEY


def group_means(df: DataFrame, target_col: str = "target_demand") -> DataFrame:
    """Mean target by date, category, store and weekday (with day name).

    Long form (dimension, key, label, mean_target) from ONE grouping-sets
    aggregate: the source is scanned once, rows are expanded once per set and
    partially aggregated before the single shuffle.
    """
    t = F.col(target_col)
    base = df.select(
        F.col("date").cast("string").alias("date"),
        F.col("category_id").cast("string").alias("category_id"),
        F.col("store_id").cast("string").alias("store_id"),
        F.weekday(F.col("date")).alias("day_of_week"),
        t.alias("_t"),
    )
    dims = ["date", "category_id", "store_id", "day_of_week"]
    agg = base.groupingSets([[d] for d in dims], *dims).agg(
        F.avg("_t").alias("mean_target"), F.grouping_id().alias("_gid")
    )
    # grouping_id has one bit per grouping column (first column = highest
    # bit); a set that keeps only column i has every other bit set
    full = (1 << len(dims)) - 1
    gid_of = {d: full ^ (1 << (len(dims) - 1 - i)) for i, d in enumerate(dims)}
    dimension = F.lit(None).cast("string")
    key = F.lit(None).cast("string")
    for d in dims:
        hit = F.col("_gid") == gid_of[d]
        dimension = F.when(hit, F.lit(d)).otherwise(dimension)
        key = F.when(hit, F.col(d).cast("string")).otherwise(key)
    label = F.when(F.col("_gid") == gid_of["day_of_week"], day_name(F.col("day_of_week")))
    return agg.select(
        dimension.alias("dimension"), key.alias("key"), label.alias("label"), "mean_target"
    )


def overview_counts(df: DataFrame) -> DataFrame:
    """Rows, columns, date range, distinct products, stores, categories."""
    return df.agg(
        F.count(F.lit(1)).cast("bigint").alias("rows"),
        F.lit(len(df.columns)).cast("bigint").alias("columns"),
        F.min("date").alias("date_min"),
        F.max("date").alias("date_max"),
        F.count_distinct("product_id").cast("bigint").alias("products"),
        F.count_distinct("store_id").cast("bigint").alias("stores"),
        F.count_distinct("category_id").cast("bigint").alias("categories"),
    )


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width bins over [min, max]; the max falls in the last bin.

    min/max are scalar subqueries; the counting is one groupBy on the bin
    number. Empty bins are listed with count 0 (bins come from ``range``).
    """
    x = F.col(column).cast("double")
    mm = df.agg(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi"))).scalar()
    lo, hi = mm["lo"], mm["hi"]
    b = F.least(
        F.coalesce(F.floor(F.try_divide(x - lo, hi - lo) * bins), F.lit(0)),
        F.lit(bins - 1),
    ).cast("bigint")
    counts = df.where(x.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    spark = df.sparkSession
    all_bins = spark.range(bins).select(F.col("id").alias("bin"))
    width = (hi - lo) / F.lit(float(bins))
    return all_bins.join(counts, "bin", "left").select(
        F.col("bin"),
        (lo + width * F.col("bin")).alias("lower"),
        (lo + width * (F.col("bin") + 1)).alias("upper"),
        F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"),
    )


def box_summary(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Min, q1, median, q3, max, 1.5 IQR fences, whiskers, outliers.

    Quartiles per group from ``ordered.quantiles``; the fence counts need the
    fences first, so they are a second aggregate joined on the (few) groups.
    """
    by = list(by)
    q = ordered.quantiles(df, [column], [0.25, 0.5, 0.75], by=by)
    qw = q.groupBy(*by).agg(
        F.max(F.when(F.col("q") == 0.25, F.col("value"))).alias("q1"),
        F.max(F.when(F.col("q") == 0.5, F.col("value"))).alias("median"),
        F.max(F.when(F.col("q") == 0.75, F.col("value"))).alias("q3"),
    )
    qw = qw.withColumns(
        {
            "lower_fence": F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")),
            "upper_fence": F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")),
        }
    )
    x = F.col(column).cast("double")
    src = df.where(x.isNotNull()).select(*by, x.alias("_x"))
    if by:
        joined = src.join(qw, by, "inner")
    else:
        fences = qw.select(F.struct("lower_fence", "upper_fence").alias("_f")).scalar()
        joined = src.withColumn("_f", fences).select("_x", "_f.*")
    stats = joined.groupBy(*by).agg(
        F.count(F.lit(1)).cast("bigint").alias("count"),
        F.min("_x").alias("min"),
        F.max("_x").alias("max"),
        F.min(F.when(F.col("_x") >= F.col("lower_fence"), F.col("_x"))).alias("whisker_low"),
        F.max(F.when(F.col("_x") <= F.col("upper_fence"), F.col("_x"))).alias("whisker_high"),
        F.count_if((F.col("_x") < F.col("lower_fence")) | (F.col("_x") > F.col("upper_fence")))
        .cast("bigint")
        .alias("outliers"),
    )
    if by:
        out = stats.join(qw, by, "inner")
    else:
        qs = qw.select(F.struct(*qw.columns).alias("_q")).scalar()
        out = stats.withColumn("_q", qs).select("*", "_q.*").drop("_q")
    return out.select(
        *by, "count", "min", "q1", "median", "q3", "max", "lower_fence", "upper_fence",
        "whisker_low", "whisker_high", "outliers",
    )


def target_correlations(
    df: DataFrame, target_col: str = "target_demand", columns: Sequence[str] | None = None
) -> DataFrame:
    """R of every int/double column with the target, strongest first.

    ``rank`` orders by |r| descending (NULLs last, then by name); the window
    runs over one row per column, not over data.
    """
    cols = list(columns) if columns else int_float_columns(df.schema, exclude=(target_col,))
    long = gram.correlations_with(df, cols, target_col).withColumnRenamed("r", "correlation")
    w = Window.orderBy(F.desc_nulls_last(F.abs(F.col("correlation"))), F.asc("column"))
    return long.withColumn("rank", F.row_number().over(w).cast("bigint"))


def head(df: DataFrame, n: int = 10, order_cols: Sequence[str] = KEY) -> DataFrame:
    """The first n rows in key order (a top-k, not a global sort)."""
    return df.orderBy(*order_cols).limit(n)


def top_n(df: DataFrame, value_col: str, n: int = 20) -> DataFrame:
    """T4: the n largest rows by ``value_col`` (ties by the other columns)."""
    others = [c for c in df.columns if c != value_col]
    return df.orderBy(F.desc(value_col), *others).limit(n)
