"""Drift between a reference and a current table.

The statistics library the reference delegates to is not part of it, so the
tests and thresholds here are our own, stated plainly:

* numeric column: two-sample Kolmogorov-Smirnov statistic D and the
  Wasserstein-1 distance divided by the reference's population std; the drift
  score is the normed Wasserstein distance, drift when score >= 0.1.
* categorical column: Jensen-Shannon distance (natural log) of the value
  frequencies, drift when >= 0.1; the chi-square statistic of current counts
  against reference proportions is reported alongside.
* dataset drift: share of drifted columns >= 0.5.

Both sides are unpivoted to (kind, column, value) and counted by value in one
aggregate, numeric and categorical columns together. Counts can be added, so the
reference side may also be a stored count table (``drift_reference``). The
cumulative distributions are chunked prefix sums over the *count* table (one
row per distinct value), so no task holds a whole column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkcast.functions.stats import int_float_columns
from sparkcast.operators import ordered
from sparkcast.session import checkpoint_dir

DEFAULT_THRESHOLD = 0.1
DATASET_SHARE = 0.5
FLAGS = ("promotion_flag", "holiday_flag")


def column_roles(df: DataFrame, exclude: Sequence[str] = ("date", "target_demand")) -> tuple[list[str], list[str]]:
    """(numeric, categorical). Flags are categorical only."""
    numeric = [c for c in int_float_columns(df.schema, exclude=tuple(exclude)) if c not in FLAGS]
    categorical = [c for c in FLAGS if c in df.columns]
    return numeric, categorical


def value_rows(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], side: str) -> DataFrame:
    """(kind, column, value, label, cr, cc): one row per cell, counted 1 on its
    ``side`` ("reference" or "current"). Numeric cells have a ``value``,
    categorical ones a ``label``; NULL cells have neither."""
    no_value, no_label = F.lit(None).cast("double").alias("value"), F.lit(None).cast("string").alias("label")
    cells = [
        F.struct(F.lit("numeric").alias("kind"), F.lit(c).alias("column"), F.col(c).cast("double").alias("value"), no_label)
        for c in numeric
    ] + [
        F.struct(F.lit("categorical").alias("kind"), F.lit(c).alias("column"), no_value, F.col(c).cast("string").alias("label"))
        for c in categorical
    ]
    ref = int(side == "reference")
    return df.select(
        F.inline(F.array(*cells)), F.lit(ref).cast("bigint").alias("cr"), F.lit(1 - ref).cast("bigint").alias("cc")
    )


def sum_counts(*parts: DataFrame) -> DataFrame:
    """Counts of both sides by value: one map-side combined aggregate over cells
    and counts made earlier alike."""
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return rows.groupBy("kind", "column", "value", "label").agg(F.sum("cr").alias("cr"), F.sum("cc").alias("cc"))


def _both_counts(reference, current, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """The count table of two frames, each read once, written to the checkpoint
    folder: every statistic below reads it instead of the data."""
    checkpoint_dir(reference.sparkSession)
    return sum_counts(
        value_rows(reference, numeric, categorical, "reference"),
        value_rows(current, numeric, categorical, "current"),
    ).checkpoint(eager=True)


def numeric_counts(counts: DataFrame) -> DataFrame:
    return counts.where((F.col("kind") == "numeric") & F.col("value").isNotNull()).select("column", "value", "cr", "cc")


def _categorical_counts(counts: DataFrame) -> DataFrame:
    return counts.where((F.col("kind") == "categorical") & F.col("label").isNotNull()).select(
        "column", F.col("label").alias("value"), "cr", "cc"
    )


def _side_totals(counts: DataFrame) -> DataFrame:
    return counts.groupBy("column").agg(F.sum("cr").alias("nr"), F.sum("cc").alias("nc"))


def running_counts(counts: DataFrame) -> DataFrame:
    """Adds cumulative cr/cc (``ccr``, ``ccc``) and the next value per column.

    Prefix sums over (column, value) in chunks of consecutive values: sums
    inside chunks, running sums of chunk totals per column, next value by
    ``lead`` inside the chunk and the first value of the column's next chunk
    behind it; a column with any number of distinct values is never one task.
    """
    d, n = ordered.with_ordinal_n(counts, ["column", "value"])
    chunk_rows = ordered.adaptive_chunk_rows(counts, n, 1)
    d = d.withColumn(
        "_chunk", F.floor(F.col(ordered.ORD) / F.lit(chunk_rows)).cast("bigint")
    )
    place = Window.partitionBy("_chunk", "column").orderBy(ordered.ORD)
    inner = place.rowsBetween(Window.unboundedPreceding, 0)
    within = d.withColumns(
        {
            "_icr": F.sum("cr").over(inner),
            "_icc": F.sum("cc").over(inner),
            "_inner_next": F.lead("value").over(place),
        }
    )
    totals = d.groupBy("column", "_chunk").agg(
        F.sum("cr").alias("_tr"), F.sum("cc").alias("_tc"), F.min("value").alias("_first")
    )
    chunks = Window.partitionBy("column").orderBy("_chunk")
    before = chunks.rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(
        "column",
        "_chunk",
        F.coalesce(F.sum("_tr").over(before), F.lit(0)).alias("_pr"),
        F.coalesce(F.sum("_tc").over(before), F.lit(0)).alias("_pc"),
        F.lead("_first").over(chunks).alias("_next_first"),
    )
    out = within.join(carry, ["column", "_chunk"])
    return out.select(
        "column",
        "value",
        "cr",
        "cc",
        (F.col("_icr") + F.col("_pr")).alias("ccr"),
        (F.col("_icc") + F.col("_pc")).alias("ccc"),
        F.coalesce("_inner_next", "_next_first").alias("next_value"),
    )


def numeric_drift(
    reference: DataFrame,
    current: DataFrame,
    columns: Sequence[str],
    threshold: float = DEFAULT_THRESHOLD,
) -> DataFrame:
    """D1 numeric: per column ks (D), wasserstein, ref_std, wasserstein_normed, drift."""
    return numeric_drift_of(numeric_counts(_both_counts(reference, current, columns, [])), threshold)


def numeric_drift_of(counts: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """D1 numeric over a stored count table (column, value, cr, cc): the CDFs,
    the next-value gaps and the reference moments all come from it."""
    totals = _side_totals(counts)
    run = running_counts(counts).join(totals, "column")
    fr = F.try_divide(F.col("ccr"), F.col("nr"))
    fc = F.try_divide(F.col("ccc"), F.col("nc"))
    gap = F.abs(fr - fc)
    stats = run.groupBy("column").agg(
        F.max(gap).alias("ks"),
        F.sum(F.coalesce(gap * (F.col("next_value") - F.col("value")), F.lit(0.0))).alias("wasserstein"),
    )
    # reference population std from the weighted value table, two passes
    # (mean, then squared deviations) to stay as stable as a streaming std
    means = counts.groupBy("column").agg(
        F.try_divide(F.sum(F.col("cr") * F.col("value")), F.sum("cr")).alias("_mu")
    )
    ref_std = (
        counts.join(means, "column")
        .groupBy("column")
        .agg(
            F.sqrt(
                F.try_divide(
                    F.sum(F.col("cr") * (F.col("value") - F.col("_mu")) * (F.col("value") - F.col("_mu"))),
                    F.sum("cr"),
                )
            ).alias("ref_std")
        )
    )
    out = stats.join(ref_std, "column", "left").withColumn(
        "wasserstein_normed", F.try_divide(F.col("wasserstein"), F.col("ref_std"))
    )
    return out.select(
        "column",
        "ks",
        "wasserstein",
        "ref_std",
        "wasserstein_normed",
        F.lit("wasserstein_normed").alias("stattest_name"),
        F.col("wasserstein_normed").alias("drift_score"),
        F.coalesce(F.col("wasserstein_normed") >= threshold, F.lit(False)).alias("drift_detected"),
    )


def categorical_drift(
    reference: DataFrame,
    current: DataFrame,
    columns: Sequence[str],
    threshold: float = DEFAULT_THRESHOLD,
) -> DataFrame:
    """D1 categorical: Jensen-Shannon distance and chi-square statistic per column."""
    return categorical_drift_of(_categorical_counts(_both_counts(reference, current, [], columns)), threshold)


def categorical_drift_of(vc: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """D1 categorical over a count table (column, value, cr, cc)."""
    counts = vc.join(_side_totals(vc), "column")
    p = F.try_divide(F.col("cr"), F.col("nr"))
    q = F.try_divide(F.col("cc"), F.col("nc"))
    m = (p + q) / 2

    def kl_term(a):
        return F.when(a > 0, a * F.log(a / m)).otherwise(F.lit(0.0))

    expected = F.col("nc") * p
    stats = counts.groupBy("column").agg(
        F.sqrt(F.greatest(F.lit(0.0), 0.5 * F.sum(kl_term(p)) + 0.5 * F.sum(kl_term(q)))).alias("jensenshannon"),
        F.sum(F.when(expected > 0, (F.col("cc") - expected) * (F.col("cc") - expected) / expected)).alias(
            "chisquare"
        ),
    )
    return stats.select(
        "column",
        "jensenshannon",
        "chisquare",
        F.lit("jensenshannon").alias("stattest_name"),
        F.col("jensenshannon").alias("drift_score"),
        F.coalesce(F.col("jensenshannon") >= threshold, F.lit(False)).alias("drift_detected"),
    )


def column_drift(
    reference: DataFrame,
    current: DataFrame,
    numeric: Sequence[str] | None = None,
    categorical: Sequence[str] | None = None,
    threshold: float = DEFAULT_THRESHOLD,
) -> DataFrame:
    """One row per column (column, kind, stattest_name, drift_score, drift_detected)."""
    if numeric is None or categorical is None:
        n0, c0 = column_roles(reference)
        numeric = n0 if numeric is None else numeric
        categorical = c0 if categorical is None else categorical
    return column_drift_of(_both_counts(reference, current, numeric, categorical), numeric, categorical, threshold)


def column_drift_of(
    counts: DataFrame, numeric: Sequence[str], categorical: Sequence[str], threshold: float = DEFAULT_THRESHOLD
) -> DataFrame:
    """D2 over a stored count table of both sides (``sum_counts``)."""
    parts = []
    if numeric:
        of = numeric_counts(counts).where(F.col("column").isin(list(numeric)))
        parts.append((numeric_drift_of(of, threshold), "numeric"))
    if categorical:
        of = _categorical_counts(counts).where(F.col("column").isin(list(categorical)))
        parts.append((categorical_drift_of(of, threshold), "categorical"))
    tables = [
        p.select("column", F.lit(kind).alias("kind"), "stattest_name", "drift_score", "drift_detected")
        for p, kind in parts
    ]
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def dataset_drift(columns: DataFrame, share: float = DATASET_SHARE) -> DataFrame:
    """D3: number of columns, number drifted, share, dataset_drift, drifted names."""
    return columns.agg(
        F.count(F.lit(1)).cast("bigint").alias("number_of_columns"),
        F.count_if(F.col("drift_detected")).cast("bigint").alias("number_of_drifted_columns"),
        F.array_sort(F.collect_list(F.when(F.col("drift_detected"), F.col("column")))).alias("drifted_features"),
    ).select(
        "number_of_columns",
        "number_of_drifted_columns",
        F.try_divide(F.col("number_of_drifted_columns"), F.col("number_of_columns")).alias("share_of_drifted_columns"),
        (F.try_divide(F.col("number_of_drifted_columns"), F.col("number_of_columns")) >= share).alias("dataset_drift"),
        F.array_join("drifted_features", ",").alias("drifted_features"),
    )


def _quality(df: DataFrame, by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    kv = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols])
    long = df.select(*by, F.inline(kv))
    counts = long.groupBy(*by, "column", "value").agg(F.count(F.lit(1)).alias("_n"))
    distinct = counts.groupBy(*by, "column").agg(F.count("value").cast("bigint").alias("distinct"))
    stats = long.groupBy(*by, "column").agg(
        F.count(F.lit(1)).cast("bigint").alias("rows"),
        F.count_if(F.col("value").isNull()).cast("bigint").alias("missing"),
        F.count_if(F.col("value") == 0).cast("bigint").alias("zeros"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
    )
    top = counts.where("value is not null").groupBy(*by, "column").agg(
        F.min(F.struct((-F.col("_n")).alias("k"), F.col("value").alias("v"))).alias("_t")
    )
    quart = ordered.quantiles(df, cols, [0.25, 0.5, 0.75], by=by).groupBy(*by, "column").agg(
        *[F.max(F.when(F.col("q") == q, F.col("value"))).alias(f"q{int(q * 100)}") for q in (0.25, 0.5, 0.75)]
    )
    keys = [*by, "column"]
    return (
        stats.join(distinct, keys, "left")
        .join(quart, keys, "left")
        .join(top, keys, "left")
        .select(
            *keys, "rows", "missing", "distinct", "zeros", "min", "q25", "q50", "q75", "max", "mean", "std",
            F.col("_t.v").alias("top"), (-F.col("_t.k")).cast("bigint").alias("top_count"),
        )
    )


def quality_table(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A20 for one table: per column rows, missing, distinct, zeros, min,
    quartiles, max, mean, std, the most frequent value and its count."""
    return _quality(df, [], list(columns) if columns else int_float_columns(df.schema))


def quality_by_side(reference: DataFrame, current: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A20 for two tables: the same figures per side and column."""
    cols = list(columns) if columns else int_float_columns(reference.schema)
    both = reference.select(*cols).withColumn("side", F.lit("reference")).unionByName(
        current.select(*cols).withColumn("side", F.lit("current"))
    )
    return _quality(both, ["side"], cols)


def monitoring_run(
    reference: DataFrame,
    current: DataFrame,
    threshold: float = DEFAULT_THRESHOLD,
    numeric: Sequence[str] | None = None,
    categorical: Sequence[str] | None = None,
    quality_cols: Sequence[str] | None = None,
) -> dict:
    """The tables a monitoring run writes (drift per column, dataset row, quality)."""
    cols = column_drift(reference, current, numeric, categorical, threshold=threshold)
    return {
        "columns": cols,
        "dataset": dataset_drift(cols),
        "quality": quality_by_side(reference, current, quality_cols),
    }


def write_monitoring_run(run: dict, path: str, timestamp: str) -> DataFrame:
    """Write a run's tables and its status row under ``path``; returns the status.

    ``columns``, ``dataset`` and ``quality`` are Parquet folders named with the
    timestamp, the status is ``status_<timestamp>`` as JSON.
    """
    from sparkcast.sources.tables import save_metrics_json, save_parquet

    spark = run["dataset"].sparkSession
    for name, table in run.items():
        save_parquet(table, f"{path}/{name}_{timestamp}")
    status = spark.read.parquet(f"{path}/dataset_{timestamp}").withColumn("timestamp", F.lit(timestamp))
    save_metrics_json(status, path, "status", timestamp)
    return status
