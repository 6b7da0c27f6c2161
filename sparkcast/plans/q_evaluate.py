"""Catalogue: splits, metrics, CV and model comparison on fixed predictors.

Predictors that SQL can reproduce exactly: the train mean, ``lag_1`` and
``lag_7`` of the target per series (missing lags are 0, as the feature
pipeline fills them). The test set is the last 20 % of rows in
(date, product_id, store_id) order.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkcast.operators import evaluate as E
from sparkcast.operators import features as fe
from sparkcast.operators import split as S
from sparkcast.plans.catalog import register
from sparkcast.plans.common import r, round_doubles
from sparkcast.sources.tables import DEMAND_SQL, RAW_DEFECTS_SQL, demand_view, raw_with_defects

# --------------------------------------------------------------------------
# shared frames
# --------------------------------------------------------------------------


def eval_frame(spark, sf):
    """demand + lag_1/lag_7 per series + split label ('train'/'test')."""
    d = demand_view(spark, sf)
    mask = S.temporal_train_mask(d, 0.2)
    f = fe.create_lag_features(d, lags=(1, 7), group_cols=fe.SERIES)
    return f.withColumns(
        {
            "lag_1": F.coalesce("lag_1", F.lit(0).cast("bigint")),
            "lag_7": F.coalesce("lag_7", F.lit(0).cast("bigint")),
            "split": F.when(mask, F.lit("train")).otherwise(F.lit("test")),
        }
    )


def predictions_long(spark, sf):
    """Test rows with one prediction per model: mean, lag_1, lag_7."""
    f = eval_frame(spark, sf)
    train_mean = f.where(F.col("split") == "train").agg(F.avg(F.col("target_demand").cast("double"))).scalar()
    test = f.where(F.col("split") == "test")
    base = ["date", "product_id", "store_id", F.col("target_demand").alias("label")]
    parts = [
        test.select(*base, F.lit("mean").alias("model"), train_mean.alias("prediction")),
        test.select(*base, F.lit("lag_1").alias("model"), F.col("lag_1").cast("double").alias("prediction")),
        test.select(*base, F.lit("lag_7").alias("model"), F.col("lag_7").cast("double").alias("prediction")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


EVAL_SQL = f"""
WITH d AS ({DEMAND_SQL}),
f AS (SELECT *,
        COALESCE(lag(target_demand, 1) OVER (PARTITION BY product_id, store_id ORDER BY date), 0) AS lag_1,
        COALESCE(lag(target_demand, 7) OVER (PARTITION BY product_id, store_id ORDER BY date), 0) AS lag_7,
        row_number() OVER (ORDER BY date, product_id, store_id) AS rn,
        count(*) OVER () AS n
      FROM d),
t AS (SELECT *, CASE WHEN rn <= CAST(floor(n * 0.8) AS BIGINT) THEN 'train' ELSE 'test' END AS split FROM f),
tm AS (SELECT avg(CAST(target_demand AS DOUBLE)) AS m FROM t WHERE split = 'train'),
p AS (
  SELECT date, product_id, store_id, target_demand AS label, 'mean' AS model, m AS prediction FROM t, tm WHERE split = 'test'
  UNION ALL SELECT date, product_id, store_id, target_demand, 'lag_1', CAST(lag_1 AS DOUBLE) FROM t WHERE split = 'test'
  UNION ALL SELECT date, product_id, store_id, target_demand, 'lag_7', CAST(lag_7 AS DOUBLE) FROM t WHERE split = 'test')
"""


def metrics_sql(src: str, by: str | None = None, y: str = "label", p: str = "prediction", rounded: bool = True) -> str:
    e = f"(CAST({p} AS DOUBLE) - CAST({y} AS DOUBLE))"
    yy = f"CAST({y} AS DOUBLE)"
    R = r if rounded else (lambda x: x)
    sel = f"{by}, " if by else ""
    gb = f"GROUP BY {by}" if by else ""
    return f"""SELECT {sel}CAST(count(*) AS BIGINT) AS n, {R(f"avg(abs({e}))")} AS mae, {R(f"avg({e} * {e})")} AS mse,
  {R(f"sqrt(avg({e} * {e}))")} AS rmse,
  {R(f"CASE WHEN var_pop({yy}) * count(*) > 0 THEN 1 - sum({e} * {e}) / (var_pop({yy}) * count(*)) WHEN sum({e} * {e}) = 0 THEN 1.0 ELSE 0.0 END")} AS r2,
  {R(f"avg(CASE WHEN {yy} <> 0 THEN abs(({yy} - CAST({p} AS DOUBLE)) / {yy}) END) * 100")} AS mape,
  {R(f"avg({e})")} AS mean_error, {R(f"stddev_pop({e})")} AS std_error
FROM ({src}) {gb}"""


# --------------------------------------------------------------------------
# splits
# --------------------------------------------------------------------------


@register(
    "w9_temporal_split",
    f"""WITH d AS ({DEMAND_SQL}),
f AS (SELECT date, product_id, store_id, row_number() OVER (ORDER BY date, product_id, store_id) AS rn,
             count(*) OVER () AS n FROM d)
SELECT date, product_id, store_id,
       CASE WHEN rn <= CAST(floor(n * 0.8) AS BIGINT) THEN 'train' ELSE 'test' END AS split FROM f""",
)
def w9_temporal_split(spark, sf):
    d = demand_view(spark, sf).select("date", "product_id", "store_id")
    return S.label_split(d, 0.2)


@register("w10_random_split")
def w10_random_split(spark, sf):
    """Row counts only: a seeded Bernoulli split cannot match another engine's draw."""
    d = demand_view(spark, sf).select("date", "product_id", "store_id")
    train, test = S.random_split(d, 0.2, seed=42)
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


FOLDS_SQL = f"""
WITH d AS ({DEMAND_SQL}),
f AS (SELECT *, row_number() OVER (ORDER BY date, product_id, store_id) - 1 AS pos,
             count(*) OVER () AS n FROM d),
g AS (SELECT *, n // 6 AS b FROM f)
SELECT *, CAST(CASE WHEN b > 0 AND pos >= n - 5 * b THEN (pos - (n - 5 * b)) // b + 1 END AS BIGINT) AS val_fold
FROM g
"""


@register("w11_folds", f"SELECT date, product_id, store_id, val_fold FROM ({FOLDS_SQL})")
def w11_folds(spark, sf):
    d = demand_view(spark, sf).select("date", "product_id", "store_id")
    return S.time_series_folds(d, 5)


# --------------------------------------------------------------------------
# metrics
# --------------------------------------------------------------------------


@register("a17_metrics", EVAL_SQL + metrics_sql("SELECT * FROM p WHERE model = 'lag_7'"))
def a17_metrics(spark, sf):
    p = predictions_long(spark, sf).where(F.col("model") == "lag_7")
    return round_doubles(E.regression_metrics(p))


@register("m12_mean_baseline", EVAL_SQL + metrics_sql("SELECT * FROM p WHERE model = 'mean'"))
def m12_mean_baseline(spark, sf):
    p = predictions_long(spark, sf).where(F.col("model") == "mean")
    return round_doubles(E.regression_metrics(p))


@register("m11_compare_models", EVAL_SQL + metrics_sql("SELECT * FROM p", by="model"))
def m11_compare_models(spark, sf):
    return round_doubles(E.compare_models(predictions_long(spark, sf)))


@register(
    "w8_model_rank",
    EVAL_SQL
    + f""", m AS ({metrics_sql("SELECT * FROM p", by="model", rounded=False)})
SELECT model, {", ".join(f"{r(f'round({c}, 4)')} AS {c}" for c in E.METRICS)},
  CAST(row_number() OVER (ORDER BY round(rmse, 4) ASC NULLS LAST, model) AS BIGINT) AS rank FROM m""",
)
def w8_model_rank(spark, sf):
    return round_doubles(E.rank_models(E.compare_models(predictions_long(spark, sf))))


@register(
    "a18_cv_folds",
    f"""WITH x AS ({FOLDS_SQL}),
blocks AS (SELECT val_fold, sum(CAST(target_demand AS DOUBLE)) AS s, count(*) AS c FROM x GROUP BY val_fold),
means AS (SELECT val_fold,
  sum(s) OVER (ORDER BY val_fold ASC NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
  / sum(c) OVER (ORDER BY val_fold ASC NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prediction
  FROM blocks),
v AS (SELECT x.val_fold AS fold, target_demand AS label, prediction FROM x JOIN means USING (val_fold)
      WHERE x.val_fold IS NOT NULL)
"""
    + metrics_sql("SELECT * FROM v", by="fold"),
)
def a18_cv_folds(spark, sf):
    return round_doubles(_cv_fold_metrics(spark, sf))


def _cv_fold_metrics(spark, sf):
    d = demand_view(spark, sf)
    folds = S.time_series_folds(d, 5)
    preds = E.expanding_mean_predictions(folds, "target_demand", "val_fold")
    return E.cv_fold_metrics(
        preds.withColumnRenamed("val_fold", "fold"), label="target_demand", fold_col="fold"
    )


@register(
    "a18_cv_summary",
    f"""WITH x AS ({FOLDS_SQL}),
blocks AS (SELECT val_fold, sum(CAST(target_demand AS DOUBLE)) AS s, count(*) AS c FROM x GROUP BY val_fold),
means AS (SELECT val_fold,
  sum(s) OVER (ORDER BY val_fold ASC NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
  / sum(c) OVER (ORDER BY val_fold ASC NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prediction
  FROM blocks),
v AS (SELECT x.val_fold AS fold, target_demand AS label, prediction FROM x JOIN means USING (val_fold)
      WHERE x.val_fold IS NOT NULL),
fm AS ({metrics_sql("SELECT * FROM v", by="fold", rounded=False)})
SELECT CAST(count(*) AS BIGINT) AS folds, {r("avg(mae)")} AS mean_mae, {r("stddev_samp(mae)")} AS std_mae,
  {r("avg(rmse)")} AS mean_rmse, {r("stddev_samp(rmse)")} AS std_rmse,
  {r("avg(r2)")} AS mean_r2, {r("stddev_samp(r2)")} AS std_r2 FROM fm""",
)
def a18_cv_summary(spark, sf):
    return round_doubles(E.cv_summary(_cv_fold_metrics(spark, sf)))


@register(
    "a21_regression_report",
    f"""WITH d AS ({DEMAND_SQL}),
f AS (SELECT *,
        COALESCE(lag(target_demand, 7) OVER (PARTITION BY product_id, store_id ORDER BY date), 0) AS lag_7,
        row_number() OVER (ORDER BY date, product_id, store_id) AS rn, count(*) OVER () AS n FROM d),
t AS (SELECT CASE WHEN rn <= CAST(floor(n * 0.8) AS BIGINT) THEN 'reference' ELSE 'current' END AS side,
             target_demand AS label, CAST(lag_7 AS DOUBLE) AS prediction FROM f),
m AS ({metrics_sql("SELECT * FROM t", by="side")}),
q AS (SELECT side,
  {", ".join(f"{r(f'quantile_cont(CAST(label AS DOUBLE) - prediction, {q})')} AS residual_q{int(round(q * 100)):02d}" for q in (0.05, 0.25, 0.5, 0.75, 0.95))}
  FROM t GROUP BY side)
SELECT * FROM m JOIN q USING (side)""",
)
def a21_regression_report(spark, sf):
    f = eval_frame(spark, sf)
    t = f.select(
        F.when(F.col("split") == "train", F.lit("reference")).otherwise(F.lit("current")).alias("side"),
        F.col("target_demand").alias("label"),
        F.col("lag_7").cast("double").alias("prediction"),
    )
    return round_doubles(E.residual_report(t))


@register(
    "w10_exact_split",
    f"""WITH d AS ({DEMAND_SQL}), c AS (SELECT count(*) AS n FROM d)
SELECT 'train' AS split, CAST(floor(n * 0.8) AS BIGINT) AS count FROM c
UNION ALL SELECT 'test', CAST(n - floor(n * 0.8) AS BIGINT) FROM c""",
)
def w10_exact_split(spark, sf):
    d = demand_view(spark, sf).select("date", "product_id", "store_id")
    train, test = S.exact_random_split(d, 0.2, seed=42)
    both = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    return both.groupBy("split").count()


#: Defects and missing dates: exact duplicates are equal rows in every column.
_DEFECTS = """SELECT * REPLACE (CASE WHEN historical_sales % 7 <> 0 THEN date END AS date) FROM ({raw})"""


def _defect_rows(spark, sf):
    d = raw_with_defects(demand_view(spark, sf))
    return d.withColumn("date", F.when(F.col("historical_sales") % 7 != 0, F.col("date")))


@register(
    "w9_split_with_defects",
    f"""WITH d AS ({_DEFECTS.format(raw=RAW_DEFECTS_SQL)}), f AS (
SELECT *, row_number() OVER (ORDER BY date NULLS LAST, product_id NULLS LAST, store_id NULLS LAST) AS rn, count(*) OVER () AS n FROM d)
SELECT split, count(*) AS count, count(date) AS dated, min(date) AS first_date, max(date) AS last_date FROM (
  SELECT *, CASE WHEN rn <= CAST(floor(n * 0.8) AS BIGINT) THEN 'train' ELSE 'test' END AS split FROM f) x
GROUP BY split""",
)
def w9_split_with_defects(spark, sf):
    d = S.label_split(_defect_rows(spark, sf), 0.2)
    return d.groupBy("split").agg(
        F.count(F.lit(1)).alias("count"),
        F.count("date").alias("dated"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    )


@register(
    "m10_residuals",
    EVAL_SQL
    + f"""SELECT date, product_id, store_id, label AS actual, {r("prediction")} AS predicted,
  {r("CAST(label AS DOUBLE) - prediction")} AS residual FROM p WHERE model = 'lag_7'""",
)
def m10_residuals(spark, sf):
    p = predictions_long(spark, sf).where(F.col("model") == "lag_7")
    return round_doubles(E.residual_table(p, keep=["product_id", "store_id"]))


@register(
    "a21_residual_histogram",
    EVAL_SQL
    + """, e AS (SELECT CAST(label AS DOUBLE) - prediction AS x FROM p WHERE model = 'lag_7'),
b AS (SELECT min(x) AS lo, max(x) AS hi FROM e)
SELECT CAST(least(floor((x - lo) / ((hi - lo) / 20)), 19) AS BIGINT) AS bin, count(*) AS count
FROM e, b GROUP BY 1""",
)
def a21_residual_histogram(spark, sf):
    p = predictions_long(spark, sf).where(F.col("model") == "lag_7")
    return E.residual_histogram(p, bins=20)
