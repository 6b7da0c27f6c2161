"""Tree ensembles grown in stages, with a validation curve by round (M2, M7).

A round of boosting is one regression tree on the residual. The rounds are those
of Spark ML's ``GBTRegressor``, which bins the rows once for all of them; one
pass over the validation rows gives the error after each. Spark ML cannot go on
from a grown model, so more rounds mean a fit from the first one: equal seeds
give the same trees again. Its trees fit twice the residual (the gradient of the
squared error), so half the rate is the rate here. A forest grows by whole
stages of trees, whose mean is its prediction.

A grown ensemble is an ordinary ``GBTRegressionModel`` or
``RandomForestRegressionModel`` and is saved, loaded and scored like any other.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.ml.regression import (
    GBTRegressionModel,
    GBTRegressor,
    RandomForestRegressionModel,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

#: Rounds without a better validation error after which growing ends.
PATIENCE = 20
#: Trees a forest grows between two looks at the validation error.
STAGE = 10
#: Rounds of a first boosting fit; the next one has three times as many, so
#: rounds past the end of patience and rounds grown again stay a bounded share.
FIRST = 100

FEATURES, LABEL, SO_FAR = "_features", "_label", "_so_far"


def _settled(error: float) -> float:
    """The error to 12 digits: the last ones hang on the order tasks end in."""
    return float(f"{error:.12g}")


def _java_ensemble(spark, kind: str, trees, weights, n_features: int):
    """The trees as one Spark ML model."""
    sc = spark.sparkContext
    regression = sc._jvm.org.apache.spark.ml.regression
    held = sc._gateway.new_array(regression.DecisionTreeRegressionModel, len(trees))
    for i, t in enumerate(trees):
        held[i] = t._java_obj
    if kind == "forest":
        java = regression.RandomForestRegressionModel(f"forest_{id(held):x}", held, n_features)
        java.set(java.numTrees(), len(trees))  # the mean divides by this parameter
        return RandomForestRegressionModel(java)
    share = sc._gateway.new_array(sc._jvm.double, len(weights))
    for i, w in enumerate(weights):
        share[i] = float(w)
    java = regression.GBTRegressionModel(f"gbt_{id(held):x}", held, share, n_features)
    return GBTRegressionModel(java)


@dataclass
class Ensemble:
    """An ensemble that grows on ``fit_rows`` and is judged on ``check_rows``.

    Both frames hold ``_features`` (vector) and ``_label`` (double). ``curve``
    has the validation RMSE after each round; boosting evaluates every round, a
    forest every stage (``rounds`` names the rounds of the curve).
    """

    fit_rows: DataFrame
    check_rows: DataFrame
    kind: str = "gbt"
    params: dict = field(default_factory=dict)
    patience: int = PATIENCE
    stage: int = STAGE
    trees: list = field(default_factory=list)
    weights: list = field(default_factory=list)
    rounds: list = field(default_factory=list)
    curve: list = field(default_factory=list)
    _held: list = field(default_factory=list)

    @property
    def limit(self) -> int:
        return int(self.params["maxIter" if self.kind == "gbt" else "numTrees"])

    @property
    def best_round(self) -> int:
        """Rounds up to the first of the least errors; 0 before any round."""
        return self.rounds[self.curve.index(min(self.curve))] if self.curve else 0

    @property
    def best_error(self) -> float:
        return min(self.curve, default=math.inf)

    @property
    def stopped(self) -> bool:
        """Whether ``patience`` rounds went by without a better error."""
        return bool(self.rounds) and self.rounds[-1] - self.best_round >= self.patience

    @property
    def finished(self) -> bool:
        return self.stopped or len(self.trees) >= self.limit

    def _tree_params(self) -> dict:
        names = ("maxDepth", "subsamplingRate", "featureSubsetStrategy", "minInstancesPerNode", "maxBins")
        return {k: self.params[k] for k in names if k in self.params}

    def _fit(self, rows: DataFrame, label: str, n: int) -> RandomForestRegressionModel:
        return RandomForestRegressor(
            featuresCol=FEATURES,
            labelCol=label,
            predictionCol="_step",
            numTrees=n,
            bootstrap=self.kind == "forest",
            seed=int(self.params.get("seed", 42)) + len(self.trees),
            **self._tree_params(),
        ).fit(rows)

    def _write(self, rows: DataFrame) -> DataFrame:
        # kept near the executors as well: each tree reads it once a level
        kept = rows.checkpoint(eager=True).persist(StorageLevel.MEMORY_AND_DISK)
        self._held.append(kept)
        return kept

    def grow(self, rounds: int) -> "Ensemble":
        """Grow to ``rounds`` rounds, or until the limit or the end of patience."""
        goal = min(rounds, self.limit)
        while len(self.trees) < goal and not self.stopped:
            if self.kind == "gbt":
                self._boost(min(goal, max(FIRST, 3 * len(self.trees))))
            else:
                self._plant(min(self.stage, goal - len(self.trees)))
        return self

    def _boost(self, n: int) -> None:
        """The first ``n`` rounds; those past the end of patience do not count."""
        grown = GBTRegressor(
            featuresCol=FEATURES,
            labelCol=LABEL,
            predictionCol="_step",
            maxIter=n,
            stepSize=float(self.params.get("stepSize", 0.1)) / 2,
            seed=int(self.params.get("seed", 42)),
            **self._tree_params(),
        ).fit(self.fit_rows)
        check = self.check_rows.where(F.col(LABEL).isNotNull())
        errors = [math.inf] * n if check.isEmpty() else grown.evaluateEachIteration(check, "squared")
        self.rounds, self.curve = [], []
        for i, error in enumerate(errors, 1):
            if self.stopped:
                break
            self.rounds.append(i)
            self.curve.append(_settled(math.sqrt(error)))
        self.trees = list(grown.trees[: len(self.rounds)])
        self.weights = list(grown.treeWeights[: len(self.rounds)])

    def _plant(self, n: int) -> None:
        step = self._fit(self.fit_rows, LABEL, n)
        before = len(self.trees)
        self.trees += step.trees
        self.weights += [1.0] * n
        if not before:
            self._check_left = self.check_rows.select(FEATURES, LABEL, F.lit(0.0).alias(SO_FAR))
        mean = (F.col(SO_FAR) * before + F.col("_step") * n) / (before + n)
        old = self._held[:]
        self._check_left = self._write(
            step.transform(self._check_left).select(FEATURES, LABEL, mean.alias(SO_FAR))
        )
        self._release(old)
        error = self._check_left.agg(F.sqrt(F.avg(F.pow(F.col(LABEL) - F.col(SO_FAR), 2)))).first()[0]
        self.rounds.append(before + n)
        self.curve.append(_settled(error) if error is not None else math.inf)

    def _release(self, frames) -> None:
        for f in frames:
            f.unpersist()
            self._held.remove(f)

    def close(self) -> "Ensemble":
        """Give back what the executors keep for growing on."""
        self._release(self._held[:])
        return self

    def model(self, rounds: int | None = None):
        """The Spark ML model cut at ``rounds`` (default: the best round)."""
        n = rounds or self.best_round
        first = self.fit_rows.schema[FEATURES].metadata.get("ml_attr", {}).get("num_attrs")
        n_features = first or len(self.fit_rows.select(FEATURES).first()[0])
        model = _java_ensemble(
            self.fit_rows.sparkSession, self.kind, self.trees[:n], self.weights[:n], n_features
        )
        return model.setFeaturesCol(FEATURES).setPredictionCol("_raw_prediction")
