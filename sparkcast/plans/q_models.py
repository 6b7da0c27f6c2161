"""Catalogue: models, scoring and scenarios.

Model scores cannot equal another engine's tree library, so the scores are
rows-only; row counts and the quality bound (mean absolute error at most 1.5
times the mean predictor's) are checked against SQL, and so is the scenario
table (M9), which is plain data. All fits use the configured 100 trees. A
session fits each model once per input folder and the entries share it.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkcast.operators import features as fe
from sparkcast.operators import models as M
from sparkcast.operators import split as S
from sparkcast.operators import tuning as T
from sparkcast.operators.boosting import PATIENCE
from sparkcast.plans.catalog import register
from sparkcast.plans.common import round_doubles
from sparkcast.plans.q_rules import requests_table
from sparkcast.session import scratch_dir, small_methods
from sparkcast.sources.store import FeatureStore
from sparkcast.sources.tables import DEMAND_SQL, demand_view

HORIZON = 14
_fitted: dict[tuple, M.DemandModel] = {}
_searched: dict[tuple, T.Search] = {}


def written_demand(spark, sf):
    """The daily panel, written once: the split, the windows, the statistics and
    the scenarios read it many times, and each reading of the view would
    aggregate ``lineitem`` again."""
    path = scratch_dir(spark, "demand")
    demand_view(spark, sf).write.parquet(path)
    return spark.read.parquet(path)


def model_frames(spark, sf, demand=None):
    """(train, test, feature columns): per-series features, temporal 80/20.

    Written once: the splits, the imputer, the vectors and the scores read them,
    and each reading would run the windows again.
    """
    d = demand or written_demand(spark, sf)
    mask = S.temporal_train_mask(d, 0.2)
    built = fe.create_features(d.withColumn("_train", mask), group_cols=fe.SERIES)
    cols = [c for c in fe.training_columns(built) if c != "_train"]
    path = scratch_dir(spark, "features")
    with small_methods(spark):
        built.write.parquet(path)
    feats = spark.read.parquet(path)
    return feats.where("_train").drop("_train"), feats.where(~F.col("_train")).drop("_train"), cols


def fitted(spark, sf, kind="gbt"):
    train, test, cols = model_frames(spark, sf)
    key = (spark.sparkContext.applicationId, sf, kind)
    if key not in _fitted:
        _fitted[key] = M.DemandModel(cols, kind).fit(train)
    return _fitted[key], train, test


def fitted_model(spark, sf, kind="gbt", demand=None):
    """The model alone: no features are built if the session has it."""
    key = (spark.sparkContext.applicationId, sf, kind)
    if key not in _fitted:
        train, _, cols = model_frames(spark, sf, demand)
        _fitted[key] = M.DemandModel(cols, kind).fit(train)
    return _fitted[key]


def _bounded(spark, metrics, train, test, label="target_demand"):
    """(n, good): test rows, and whether the model meets the quality bound."""
    mean = train.agg(F.avg(F.col(label).cast("double"))).scalar()
    base = test.agg(F.avg(F.abs(F.col(label) - mean))).scalar()
    return metrics.select(F.col("n").cast("bigint").alias("n"), (F.col("mae") <= base * 1.5).alias("good"))


BOUND_SQL = f"""
WITH d AS ({DEMAND_SQL}), c AS (SELECT count(*) AS n FROM d)
SELECT CAST(n - floor(n * 0.8) AS BIGINT) AS n, true AS good FROM c
"""


@register("m6_quality_bound", BOUND_SQL)
def m6_quality_bound(spark, sf):
    m, train, test = fitted(spark, sf)
    return _bounded(spark, M.evaluate_model(m, test), train, test)


@register("m6_quality_bound_forest", BOUND_SQL)
def m6_quality_bound_forest(spark, sf):
    m, train, test = fitted(spark, sf, "forest")
    return _bounded(spark, M.evaluate_model(m, test), train, test)


CV_SQL = f"""
WITH d AS ({DEMAND_SQL}), c AS (SELECT count(*) // 6 AS b FROM d)
SELECT CAST(f AS BIGINT) AS fold, CAST(b AS BIGINT) AS n, true AS good
FROM c, (SELECT unnest(range(1, 6)) AS f)
"""


@register("a18_model_cv", CV_SQL)
def a18_model_cv(spark, sf):
    """Cross-validation of the forest on expanding folds, with its bound."""
    d = written_demand(spark, sf)
    folds = S.time_series_folds(d, 5)
    feats = fe.create_features(folds, group_cols=fe.SERIES)
    cols = [c for c in fe.training_columns(feats) if c != "val_fold"]
    rows = M.cross_validate(lambda: M.DemandModel(cols, "forest"), feats, 5)
    spread = d.agg(F.avg("target_demand").alias("m")).select("m").scalar()
    base = d.agg(F.avg(F.abs(F.col("target_demand") - spread))).scalar()
    return rows.select(
        F.col("fold").cast("bigint").alias("fold"),
        F.col("n").cast("bigint").alias("n"),
        (F.col("mae") <= base * 1.5).alias("good"),
    )


@register("m1_fit_score")
def m1_fit_score(spark, sf):
    m, _, test = fitted(spark, sf)
    return round_doubles(m.predict(test).select("date", "product_id", "store_id", "target_demand", "prediction"))


@register("m1_fit_score_forest")
def m1_fit_score_forest(spark, sf):
    m, _, test = fitted(spark, sf, "forest")
    return round_doubles(m.predict(test).select("date", "product_id", "store_id", "target_demand", "prediction"))


def stopped_early(spark, sf):
    """Boosting with a validation slice (the last 10 % of the train part)."""
    train, test, cols = model_frames(spark, sf)
    key = (spark.sparkContext.applicationId, sf, "early stopping")
    if key not in _fitted:
        fit_part, val_part = S.temporal_split(train, 0.1)
        _fitted[key] = M.DemandModel(cols, "gbt").fit(fit_part, val_part)
    return _fitted[key], test


@register("m2_early_stopping")
def m2_early_stopping(spark, sf):
    m, test = stopped_early(spark, sf)
    trees = m.model.stages[-1].getNumTrees
    return round_doubles(M.evaluate_model(m, test).withColumn("trees", F.lit(trees).cast("bigint")))


@register("m2_validation_curve")
def m2_validation_curve(spark, sf):
    """A row a round: validation RMSE, and whether the model is cut there."""
    m, _ = stopped_early(spark, sf)
    trees = m.model.stages[-1].getNumTrees
    curve = spark.createDataFrame(m.curve, "round int, rmse double")
    return round_doubles(curve.withColumn("cut_here", F.col("round") == trees))


@register("m2_curve_rules", """
SELECT unnest(['a row a round', 'cut at the best round', 'ended by patience or limit',
               'no earlier end', 'no better round']) AS rule, true AS holds""")
def m2_curve_rules(spark, sf):
    """What the curve must show: patience of 20 rounds, the model cut at the best one."""
    m, _ = stopped_early(spark, sf)
    trees, limit = m.model.stages[-1].getNumTrees, M.GBT_PARAMS["maxIter"]
    spark.createDataFrame(m.curve, "round int, rmse double").createOrReplaceTempView("_m2_curve")
    return spark.sql(f"""
        WITH c AS (SELECT round, rmse, min(rmse) OVER (ORDER BY round) AS least,
                          row_number() OVER (ORDER BY round) AS at FROM _m2_curve),
        b AS (SELECT *, min_by(round, round) OVER (PARTITION BY least) AS best FROM c),
        s AS (SELECT count_if(round <> at) AS gaps, max(round) AS last, min_by(round, (rmse, round)) AS best,
                     max(round - best) AS waited, max(CASE WHEN round = {trees} THEN rmse END) AS at_cut, min(rmse) AS least,
                     max(CASE WHEN round - best >= {PATIENCE} THEN 1 ELSE 0 END
                         * CASE WHEN round < (SELECT max(round) FROM c) THEN 1 ELSE 0 END) AS late FROM b)
        SELECT inline(array(
          named_struct('rule', 'a row a round', 'holds', gaps = 0),
          named_struct('rule', 'cut at the best round', 'holds', best = {trees}),
          named_struct('rule', 'ended by patience or limit', 'holds', waited = {PATIENCE} OR last = {limit}),
          named_struct('rule', 'no earlier end', 'holds', late = 0),
          named_struct('rule', 'no better round', 'holds', least = at_cut))) FROM s""")


@register("m4_importance")
def m4_importance(spark, sf):
    m = fitted_model(spark, sf)
    return round_doubles(m.feature_importance(spark))


@register("m4_importance_rules", """
SELECT unnest(['a row a feature', 'none negative', 'sum of one', 'in falling order', 'names of features']) AS rule,
       true AS holds""")
def m4_importance_rules(spark, sf):
    m = fitted_model(spark, sf)
    rows = [tuple(r) for r in m.feature_importance(spark).collect()]  # one row a feature
    shares = [x for _, x in rows]
    found = {
        "a row a feature": len(rows) == len(m.feature_cols),
        "none negative": min(shares) >= 0,
        "sum of one": abs(sum(shares) - 1) < 1e-9,
        "in falling order": shares == sorted(shares, reverse=True),
        "names of features": {c for c, _ in rows} == set(m.feature_cols),
    }
    return spark.createDataFrame(list(found.items()), "rule string, holds boolean")


#: Rows of the test part, each with one true column.
TEST_ROWS = f"""
WITH d AS ({DEMAND_SQL}), f AS (
  SELECT date, product_id, store_id, row_number() OVER (ORDER BY date, product_id, store_id) AS rn,
         count(*) OVER () AS n FROM d)
SELECT date, product_id, store_id, true AS NAME FROM f WHERE rn > CAST(floor(n * 0.8) AS BIGINT)"""


@register("m5_save_load", TEST_ROWS.replace("NAME", "same"))
def m5_save_load(spark, sf):
    m, _, test = fitted(spark, sf)
    path = scratch_dir(spark, "model")
    m.save(path)
    loaded = M.DemandModel.load(spark, path)
    a = m.predict(test).select("date", "product_id", "store_id", F.col("prediction").alias("p1"))
    b = loaded.predict(test).select("date", "product_id", "store_id", F.col("prediction").alias("p2"))
    return a.join(b, ["date", "product_id", "store_id"]).select(
        "date", "product_id", "store_id", (F.abs(F.col("p1") - F.col("p2")) < 1e-9).alias("same")
    )


@register("m6_evaluate")
def m6_evaluate(spark, sf):
    m, _, test = fitted(spark, sf)
    return round_doubles(M.evaluate_model(m, test))


def searched(spark, sf, kind="gbt", frames=None):
    key = (spark.sparkContext.applicationId, sf, kind)
    if key not in _searched:
        train, _, cols = frames or model_frames(spark, sf)
        fit_part, val_part = S.temporal_split(train, 0.2)
        _searched[key] = T.tune(fit_part, val_part, cols, kind, seed=42)
    return _searched[key]


@register("m7_search")
def m7_search(spark, sf):
    """The whole search space: Parzen sampling, poor trials stopped at rungs."""
    return searched(spark, sf).trials


@register("m7_search_forest")
def m7_search_forest(spark, sf):
    return searched(spark, sf, "forest").trials


BOUNDS_SQL = """
SELECT CAST(i AS INTEGER) AS trial, true AS in_space, true AS scored, true AS within_rounds,
       CAST(1 AS BIGINT) AS best_trials
FROM (SELECT unnest(range(0, 50)) AS i)
"""


def _bounds(spark, sf, kind):
    """A row a trial: its parameters lie in the space, its error is finite, one is best.

    Its rounds are at most its own, and it ends there, by patience or at a rung."""
    space = T.SPACES[kind]
    names = {"int": "int", "log": "double", "float": "double", "share": "string"}
    schema = ", ".join(f"{k} {names[v[0]]}" for k, v in space.items())
    p = F.from_json("params", schema)
    inside = F.lit(True)
    for k, (_, low, high) in space.items():
        inside = inside & F.coalesce(p[k].cast("double").between(low, high), F.lit(False))
    own = p["maxIter" if kind == "gbt" else "numTrees"]
    ended = ((F.col("state") == "complete") & (F.col("trees") == own)) | F.col("state").isin("stopped", "pruned")
    trials = searched(spark, sf, kind).trials
    best = trials.where(F.col("best") & (F.col("rmse") == trials.agg(F.min("rmse")).scalar()))
    return trials.select(
        "trial",
        inside.alias("in_space"),
        (F.col("rmse").isNotNull() & (F.col("rmse") < 1e300)).alias("scored"),
        (F.col("trees").between(1, own) & ended).alias("within_rounds"),
        best.agg(F.count(F.lit(1))).scalar().alias("best_trials"),
    )


@register("m7_search_bounds", BOUNDS_SQL)
def m7_search_bounds(spark, sf):
    return _bounds(spark, sf, "gbt")


@register("m7_search_bounds_forest", BOUNDS_SQL)
def m7_search_bounds_forest(spark, sf):
    return _bounds(spark, sf, "forest")


@register("m7_tuned_quality", BOUND_SQL)
def m7_tuned_quality(spark, sf):
    """The best trial's model meets the quality bound on the test part."""
    frames = model_frames(spark, sf)
    train, test, _ = frames
    return _bounded(spark, M.evaluate_model(searched(spark, sf, frames=frames).model, test), train, test)


@register("m8_batch_score")
def m8_batch_score(spark, sf):
    m = fitted_model(spark, sf)
    scored, rejected = M.batch_score(
        requests_table(spark, sf), m, keep=["prediction_date", "product_id", "store_id"]
    )
    return scored


@register("m8_true_features", TEST_ROWS.replace("NAME", "scored"))
def m8_true_features(spark, sf):
    """Batch scoring on the stored features instead of the request proxies."""
    m, _, test = fitted(spark, sf)
    store = FeatureStore(spark, scratch_dir(spark, "scoring-features"))
    store.save_features(test, "scoring", "v1")
    scored = M.score_features(store.load_features("scoring", "v1"), m, ["date", "product_id", "store_id"])
    good = F.col("predicted_demand").isNotNull() & (F.col("predicted_demand") >= 0)
    return scored.select("date", "product_id", "store_id", good.alias("scored"))


SCENARIO_SQL = f"""
WITH d AS ({DEMAND_SQL}),
l AS (SELECT product_id, store_id, max(date) AS last, arg_max(price, date) AS price,
             arg_max(category_id, date) AS category_id FROM d GROUP BY product_id, store_id)
SELECT CAST(last + CAST(k AS INTEGER) AS DATE) AS prediction_date, product_id, category_id, store_id,
       CAST(100 AS DOUBLE) AS historical_sales, price, CAST(0 AS BIGINT) AS promotion_flag,
       CAST(0 AS BIGINT) AS holiday_flag, CAST(100 AS DOUBLE) AS economic_index
FROM l, (SELECT unnest(range(1, {HORIZON + 1})) AS k)
"""


@register("m9_scenarios", SCENARIO_SQL)
def m9_scenarios(spark, sf):
    return M.scenario_requests(demand_view(spark, sf), HORIZON)


@register("m9_scenario_scores")
def m9_scenario_scores(spark, sf):
    d = written_demand(spark, sf)
    m = fitted_model(spark, sf, demand=d)
    req = M.scenario_requests(d, HORIZON)
    scored, _ = M.batch_score(req, m, keep=["prediction_date", "product_id", "store_id"])
    return scored


@register("a19_forecast_rules", f"""
WITH d AS ({DEMAND_SQL})
SELECT DISTINCT product_id, store_id, CAST({HORIZON} AS BIGINT) AS days, true AS ordered, true AS not_negative
FROM d""")
def a19_forecast_rules(spark, sf):
    """A row a series: all days scored, least <= mean <= most, none below 0."""
    found = a19_forecast_summary(spark, sf)
    low, mean, high = (F.col(f"{x}_predicted") for x in ("min", "mean", "max"))
    return found.select(
        "product_id",
        "store_id",
        "days",
        ((low <= mean + 1e-6) & (mean <= high + 1e-6)).alias("ordered"),
        (low >= 0).alias("not_negative"),
    )


@register("a19_forecast_summary")
def a19_forecast_summary(spark, sf):
    d = written_demand(spark, sf)
    m = fitted_model(spark, sf, demand=d)
    req = M.scenario_requests(d, HORIZON)
    scored, _ = M.batch_score(req, m, keep=["prediction_date", "product_id", "store_id"])
    return round_doubles(M.forecast_summary(scored))
