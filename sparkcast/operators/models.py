"""Boosted-tree demand models on Spark ML.

The two tree families of the reference map to ``GBTRegressor`` (boosting)
and ``RandomForestRegressor``. Parameter names: max_depth -> maxDepth,
learning_rate -> stepSize, n_estimators -> maxIter / numTrees, subsample ->
subsamplingRate, colsample -> featureSubsetStrategy (per node),
min_child_* -> minInstancesPerNode. Training, scoring and evaluation are
distributed; only the fitted model (a few trees) lives on the driver.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkcast.operators.boosting import FEATURES, LABEL, PATIENCE, Ensemble
from sparkcast.operators.features import align_columns, serving_features
from sparkcast.operators.validate import split_requests
from sparkcast.session import small_methods

# The configured tree settings (depth 6, rate 0.1, 100 trees,
# row and column sampling 0.8, seed 42).
GBT_PARAMS = {
    "maxDepth": 6,
    "stepSize": 0.1,
    "maxIter": 100,
    "subsamplingRate": 0.8,
    "featureSubsetStrategy": "0.8",
    "seed": 42,
}
FOREST_PARAMS = {
    "maxDepth": 6,
    "numTrees": 100,
    "subsamplingRate": 0.8,
    "featureSubsetStrategy": "0.8",
    "seed": 42,
}
#: Rows of a written part of the vectors, above two parts a core.
PART_ROWS = 1 << 18
#: Rows of a part when no stage of the fit is judged, above one part a core.
FIT_PART_ROWS = 1 << 20
KINDS = {"gbt": (GBTRegressor, GBT_PARAMS), "forest": (RandomForestRegressor, FOREST_PARAMS)}


def _estimator(kind: str, params: dict | None, label: str):
    cls, defaults = KINDS[kind]
    p = dict(defaults)
    p.update(params or {})
    return cls(featuresCol="_features", labelCol=label, predictionCol="_raw_prediction", **p)


@dataclass
class DemandModel:
    """A plug-in model -- fit, predict, importances, save/load."""

    feature_cols: list[str]
    kind: str = "gbt"
    params: dict = field(default_factory=dict)
    label: str = "target_demand"
    name: str = ""
    model: PipelineModel | None = None
    #: Validation RMSE after each round, when fitted with a validation frame.
    curve: list = field(default_factory=list)

    def pipeline(self, extra: dict | None = None) -> Pipeline:
        imp_out = [f"_imp_{c}" for c in self.feature_cols]
        imputer = Imputer(inputCols=[f"_d_{c}" for c in self.feature_cols], outputCols=imp_out, strategy="median")
        assembler = VectorAssembler(inputCols=imp_out, outputCol="_features", handleInvalid="keep")
        p = dict(self.params)
        p.update(extra or {})
        return Pipeline(stages=[imputer, assembler, _estimator(self.kind, p, self.label)])

    def _prepare(self, df: DataFrame) -> DataFrame:
        return df.withColumns({f"_d_{c}": F.col(c).cast("double") for c in self.feature_cols})

    def fit(
        self, train: DataFrame, validation: DataFrame | None = None, patience: int = PATIENCE, stage: int = 10
    ) -> "DemandModel":
        """M1. M2: with a validation frame the ensemble grows in stages, stops
        after ``patience`` rounds without a better validation RMSE and is cut
        at the best round; ``curve`` holds the RMSE by round."""
        if validation is None:
            # the vectors are written once: the trees read their input several times
            shaped = self.shaped(train)
            trees = self.pipeline().getStages()[-1].fit(self.dealt_vectors(shaped, train))
            self.model = PipelineModel(stages=[*shaped.stages, trees])
        else:
            self._fit_stopping(train, validation, patience, stage)
        self.name = self.name or f"{self.kind}_model"
        return self

    def shaped(self, df: DataFrame) -> PipelineModel:
        """The stages before the trees, fitted."""
        with small_methods(df.sparkSession):
            return Pipeline(stages=self.pipeline().getStages()[:-1]).fit(self._prepare(df))

    def dealt_vectors(self, shaped: PipelineModel, df: DataFrame) -> DataFrame:
        """(features, label) written once in even parts, as many for each core.

        A fit runs a stage a tree level, whose time is that of its fullest core,
        and each part sends the statistics of every open node. Dealt and ordered
        by a hash of the columns that are no fractions (of all if there are none).
        """
        cores = df.sparkSession.sparkContext.defaultParallelism
        n = cores * max(1, -(-df.count() // (cores * FIT_PART_ROWS)))
        keys = [f"`{c}`" for c, t in df.dtypes if t not in ("double", "float")]
        keyed = self._prepare(df.withColumn("_h", F.xxhash64(*(keys or [f"`{c}`" for c in df.columns]))))
        rows = shaped.transform(keyed).select(FEATURES, self.label, "_h")
        with small_methods(df.sparkSession):
            return rows.repartition(n, "_h").sortWithinPartitions("_h").drop("_h").checkpoint()

    def vectors(self, shaped: PipelineModel, df: DataFrame, fits: int = 1) -> DataFrame:
        """(features, label) written once for many rounds over them.

        Dealt and ordered by a hash of the columns that are no features (the
        row's keys; of the whole row if there are none): even parts, and the
        same parts in each run, on which row sampling depends. ``fits`` that run
        at the same time share the cores: each needs parts for its share only.
        """
        spark = df.sparkSession
        cores = -(-spark.sparkContext.defaultParallelism // fits)
        n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), cores)
        if n > 2 * cores:
            # each part sends the statistics of every open tree node, at every
            # level: no more parts than the cores and the rows need
            n = min(n, max(2 * cores, -(-df.count() // PART_ROWS)))
        known = {*self.feature_cols, self.label}
        keys = [f"`{c}`" for c, t in df.dtypes if c not in known and t not in ("double", "float")]
        keyed = self._prepare(df.withColumn("_h", F.xxhash64(*(keys or [f"`{c}`" for c in df.columns]))))
        rows = shaped.transform(keyed).select(FEATURES, F.col(self.label).cast("double").alias(LABEL), "_h")
        return rows.repartition(n, "_h").sortWithinPartitions("_h").drop("_h").checkpoint()

    def _fit_stopping(self, train, validation, patience, stage):
        shaped = self.shaped(train)
        frames = (self.vectors(shaped, df) for df in (train, validation))
        grown = Ensemble(*frames, self.kind, KINDS[self.kind][1] | self.params, patience, stage)
        grown.grow(grown.limit).close()
        self.curve = list(zip(grown.rounds, grown.curve))
        self.model = PipelineModel(stages=[*shaped.stages, grown.model()])

    def predict(self, df: DataFrame) -> DataFrame:
        """M3: adds ``prediction`` clamped at 0; unfitted raises."""
        if self.model is None:
            raise ValueError("Model not fitted")
        out = self.model.transform(self._prepare(df))
        keep = [c for c in df.columns]
        return out.select(*keep, F.greatest(F.col("_raw_prediction"), F.lit(0.0)).alias("prediction"))

    def feature_importance(self, spark: SparkSession) -> DataFrame:
        """M4: (feature, importance), descending; one row per feature."""
        if self.model is None:
            raise ValueError("Model not fitted")
        imp = self.model.stages[-1].featureImportances.toArray().tolist()
        rows = sorted(zip(self.feature_cols, [float(x) for x in imp]), key=lambda t: (-t[1], t[0]))
        return spark.createDataFrame(rows, "feature string, importance double")

    def save(self, path: str) -> str:
        """M5: Spark ML pipeline folder + a metadata JSON next to it."""
        if self.model is None:
            raise ValueError("Model not fitted")
        self.model.write().overwrite().save(f"{path}/pipeline")
        meta = {
            "feature_cols": self.feature_cols,
            "kind": self.kind,
            "params": self.params,
            "label": self.label,
            "name": self.name,
        }
        spark = SparkSession.getActiveSession()
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").text(
            f"{path}/meta"
        )
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "DemandModel":
        rows = spark.read.text(f"{path}/meta").collect()
        if not rows:
            raise FileNotFoundError(path)
        meta = json.loads(rows[0][0])
        m = cls(meta["feature_cols"], meta["kind"], meta["params"], meta["label"], meta["name"])
        m.model = PipelineModel.load(f"{path}/pipeline")
        return m


def evaluate_model(model: DemandModel, test: DataFrame):
    """M6: predictions + A17 metrics (one row)."""
    from sparkcast.operators.evaluate import regression_metrics

    pred = model.predict(test)
    return regression_metrics(pred, model.label, "prediction")


def cross_validate(make_model, df: DataFrame, n_splits: int, fold_col: str = "val_fold") -> DataFrame:
    """A18 with a model: one row of metrics per expanding fold.

    ``df`` carries ``fold_col`` (``split.time_series_folds``): fold i trains
    on every row of no fold or an earlier one and is scored on its own rows.
    """
    data = df.checkpoint(eager=True)
    out = None
    for i in range(1, n_splits + 1):
        model = make_model().fit(data.where(F.coalesce(F.col(fold_col), F.lit(0)) < i))
        row = evaluate_model(model, data.where(F.col(fold_col) == i)).withColumn("fold", F.lit(i))
        out = row if out is None else out.unionByName(row)
    return out


# --------------------------------------------------------------------------
# M8 / M9: scoring request tables
# --------------------------------------------------------------------------


def batch_score(requests: DataFrame, model: DemandModel, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """M8: rules -> serving features -> align to the model's columns -> predict
    -> clamp -> 2 dp. Returns (scored, rejected); no batch size limit."""
    valid, rejected = split_requests(requests)
    feats = serving_features(valid)
    keep = list(keep)
    aligned = align_columns(feats, list(dict.fromkeys(keep + model.feature_cols)))
    pred = model.predict(aligned)
    scored = pred.select(
        *keep,
        F.round(F.col("prediction"), 2).alias("predicted_demand"),
        F.lit(model.name).alias("model_used"),
    )
    return scored, rejected


def score_features(features: DataFrame, model: DemandModel, keep: Sequence[str] = ()) -> DataFrame:
    """M8 on stored feature rows: align to the model's columns, predict, clamp, 2 dp."""
    keep = list(keep)
    aligned = align_columns(features, list(dict.fromkeys(keep + model.feature_cols)))
    return model.predict(aligned).select(
        *keep,
        F.round(F.col("prediction"), 2).alias("predicted_demand"),
        F.lit(model.name).alias("model_used"),
    )


def scenario_requests(demand: DataFrame, horizon_days: int = 14) -> DataFrame:
    """M9: one request per series and future day after its last observed day.

    Per series: last date, last price and category (an aggregate), then
    ``sequence`` + ``explode`` generates the horizon -- no cross join. Sales
    and index are fixed at 100, flags at 0.
    """
    last = demand.groupBy("product_id", "store_id").agg(
        F.max("date").alias("_last"),
        F.max_by("price", "date").alias("price"),
        F.max_by("category_id", "date").alias("category_id"),
    )
    days = F.sequence(F.date_add("_last", 1), F.date_add("_last", horizon_days))
    return last.select(
        F.explode(days).alias("prediction_date"),
        "product_id",
        "category_id",
        "store_id",
        F.lit(100.0).alias("historical_sales"),
        "price",
        F.lit(0).cast("bigint").alias("promotion_flag"),
        F.lit(0).cast("bigint").alias("holiday_flag"),
        F.lit(100.0).alias("economic_index"),
    )


def forecast_summary(scored: DataFrame, by: Sequence[str] = ("product_id", "store_id")) -> DataFrame:
    """Mean, min and max predicted demand over the horizon."""
    return scored.groupBy(*by).agg(
        F.avg("predicted_demand").alias("mean_predicted"),
        F.min("predicted_demand").alias("min_predicted"),
        F.max("predicted_demand").alias("max_predicted"),
        F.count(F.lit(1)).cast("bigint").alias("days"),
    )
