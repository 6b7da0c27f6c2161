"""Regression metrics, CV summaries and model ranking.

Predictions stay a column next to the label; metrics are one aggregate
(optionally grouped by model, fold or side). Nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkcast.operators import ordered

METRICS = ["mae", "mse", "rmse", "r2", "mape", "mean_error", "std_error"]


def regression_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """Mae, mse, rmse, r2, mape (%), mean_error (pred - true), std_error (population).

    r2 for a constant label follows the usual finite convention: 1.0 when the
    fit is perfect, else 0.0. MAPE skips zero labels and is NULL when all are 0.
    """
    y = F.col(label).cast("double")
    p = F.col(prediction).cast("double")
    e = p - y
    aggs = [
        F.count(F.lit(1)).alias("_n"),
        F.avg(F.abs(e)).alias("mae"),
        F.avg(e * e).alias("mse"),
        F.sum(e * e).alias("_sse"),
        F.var_pop(y).alias("_vy"),
        F.avg(F.when(y != 0, F.abs((y - p) / y))).alias("_ape"),
        F.avg(e).alias("mean_error"),
        F.stddev_pop(e).alias("std_error"),
    ]
    g = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    sst = F.col("_vy") * F.col("_n")
    r2 = F.when(sst > 0, F.lit(1.0) - F.col("_sse") / sst).when(F.col("_sse") == 0, F.lit(1.0)).otherwise(
        F.lit(0.0)
    )
    return g.select(
        *by,
        F.col("_n").cast("bigint").alias("n"),
        "mae",
        "mse",
        F.sqrt("mse").alias("rmse"),
        r2.alias("r2"),
        (F.col("_ape") * 100).alias("mape"),
        "mean_error",
        "std_error",
    )


def rank_models(metrics: DataFrame, model_col: str = "model", digits: int = 4) -> DataFrame:
    """Metrics rounded to 4 dp, ranked by rmse (ties by model name).

    The window runs over one row per model.
    """
    rounded = metrics.select(
        model_col,
        *[F.round(F.col(m), digits).alias(m) for m in METRICS if m in metrics.columns],
    )
    w = Window.orderBy(F.asc_nulls_last("rmse"), F.asc(model_col))
    return rounded.withColumn("rank", F.row_number().over(w).cast("bigint"))


def compare_models(predictions: DataFrame, label: str = "label", model_col: str = "model") -> DataFrame:
    """One test set, several models' predictions (long form) -> metrics per model."""
    return regression_metrics(predictions, label, "prediction", by=[model_col])


def cv_fold_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction", fold_col: str = "fold") -> DataFrame:
    """A18 fold rows: A17 per fold."""
    return regression_metrics(df, label, prediction, by=[fold_col])


def cv_summary(fold_metrics: DataFrame) -> DataFrame:
    """Mean and sample std over folds of mae, rmse, r2 (one row)."""
    return fold_metrics.agg(
        F.count(F.lit(1)).cast("bigint").alias("folds"),
        F.avg("mae").alias("mean_mae"),
        F.stddev_samp("mae").alias("std_mae"),
        F.avg("rmse").alias("mean_rmse"),
        F.stddev_samp("rmse").alias("std_rmse"),
        F.avg("r2").alias("mean_r2"),
        F.stddev_samp("r2").alias("std_r2"),
    )


def expanding_mean_predictions(df: DataFrame, label: str, fold_col: str = "val_fold") -> DataFrame:
    """Mean-predictor CV: fold i predicts the mean label of every earlier row.

    Sums and counts per fold block (a handful of rows) are accumulated with a
    window over the blocks; each validation row gets its fold's train mean
    through a join with that small table (AQE broadcasts it at run time).
    """
    blocks = df.groupBy(fold_col).agg(
        F.sum(F.col(label).cast("double")).alias("_s"), F.count(F.lit(1)).alias("_c")
    )
    w = Window.orderBy(F.asc_nulls_first(fold_col)).rowsBetween(Window.unboundedPreceding, -1)
    means = blocks.select(
        fold_col, (F.sum("_s").over(w) / F.sum("_c").over(w)).alias("prediction")
    ).where(F.col(fold_col).isNotNull())
    return df.where(F.col(fold_col).isNotNull()).join(means, fold_col, "inner")


def residual_report(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    side_col: str = "side",
    qs: Sequence[float] = (0.05, 0.25, 0.5, 0.75, 0.95),
) -> DataFrame:
    """A17 per side plus residual (actual - predicted) quantiles per side."""
    m = regression_metrics(df, label, prediction, by=[side_col])
    res = df.select(side_col, (F.col(label).cast("double") - F.col(prediction).cast("double")).alias("residual"))
    q = ordered.quantile_columns(
        res, ["residual"], list(qs), by=[side_col], name=lambda c, q: f"residual_q{int(round(q * 100)):02d}"
    )
    return m.join(q, side_col, "left")


def residual_table(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    date_col: str = "date",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Date, (kept columns,) actual, predicted, residual = actual - predicted."""
    return df.select(
        date_col,
        *keep,
        F.col(label).alias("actual"),
        F.col(prediction).alias("predicted"),
        (F.col(label) - F.col(prediction)).alias("residual"),
    )


def residual_histogram(
    df: DataFrame, label: str = "label", prediction: str = "prediction", bins: int = 20
) -> DataFrame:
    """Rows per equal-width residual bin (empty bins have no row)."""
    res = df.select((F.col(label).cast("double") - F.col(prediction).cast("double")).alias("x")).where("x is not null")
    edges = res.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi"))).scalar()
    width = (edges["hi"] - edges["lo"]) / bins
    at = F.least(F.floor(F.try_divide(F.col("x") - edges["lo"], width)), F.lit(bins - 1))
    return res.groupBy(F.coalesce(at, F.lit(0)).cast("bigint").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
