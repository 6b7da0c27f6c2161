"""Staged boosting, early stopping and the adaptive search."""

import json
import random

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from sparkcast.operators import models as M
from sparkcast.operators import tuning as T
from sparkcast.operators.boosting import FEATURES, LABEL, Ensemble
from sparkcast.session import scratch_dir


@pytest.fixture(scope="module")
def frames(spark):
    rng = np.random.default_rng(2)
    x = rng.uniform(-1, 1, (1500, 3))
    y = 3 * x[:, 0] ** 2 + np.sign(x[:, 1]) + rng.normal(0, 0.3, 1500)
    rows = spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y)], "a double, b double, c double, target_demand double")
    marked = rows.withColumn("n", F.monotonically_increasing_id() % 10).checkpoint()
    return marked.where("n < 7").drop("n"), marked.where("n >= 7").drop("n")


@pytest.fixture(scope="module")
def vectors(frames):
    make = VectorAssembler(inputCols=["a", "b", "c"], outputCol=FEATURES)
    return [make.transform(f).select(FEATURES, F.col("target_demand").alias(LABEL)).checkpoint() for f in frames]


PARAMS = {"maxDepth": 3, "stepSize": 0.5, "maxIter": 60, "subsamplingRate": 0.8, "featureSubsetStrategy": "1.0", "seed": 3}


def rmse(model, rows):
    p = model.transform(rows)
    return p.agg(F.sqrt(F.avg(F.pow(F.col(LABEL) - F.col("_raw_prediction"), 2)))).first()[0]


def test_curve_is_the_error_of_the_model_cut_at_each_round(vectors):
    e = Ensemble(*vectors, "gbt", PARAMS, patience=100, stage=4).grow(6).close()
    assert e.rounds == [1, 2, 3, 4, 5, 6] and len(e.trees) == 6
    for n in (1, 4, 6):
        assert rmse(e.model(n), vectors[1]) == pytest.approx(e.curve[n - 1], rel=1e-9)


def test_stages_change_no_tree(vectors):
    a, b = (Ensemble(*vectors, "gbt", PARAMS, stage=s).grow(5).close() for s in (1, 5))
    assert a.curve == pytest.approx(b.curve, rel=1e-9)


def test_patience_ends_and_the_model_is_cut_at_the_best_round(frames):
    model = M.DemandModel(["a", "b", "c"], "gbt", PARAMS).fit(*frames, patience=3, stage=4)
    rounds, errors = zip(*model.curve)
    best = errors.index(min(errors)) + 1
    assert rounds == tuple(range(1, len(rounds) + 1))
    assert len(rounds) == best + 3 < 60
    assert all(i - (errors[: i].index(min(errors[: i])) + 1) < 3 for i in range(1, len(errors)))
    assert model.model.stages[-1].getNumTrees == best
    path = scratch_dir(frames[0].sparkSession, "stopped-model")
    model.save(path)
    again = M.DemandModel.load(frames[0].sparkSession, path)
    a, b = ([r.prediction for r in m.predict(frames[1]).collect()] for m in (model, again))
    assert a == b
    assert again.feature_importance(frames[0].sparkSession).first().feature in ("a", "b")


def test_a_forest_grows_by_stages(vectors):
    params = M.FOREST_PARAMS | {"numTrees": 12, "maxDepth": 4}
    e = Ensemble(*vectors, "forest", params, stage=5).grow(100).close()
    assert e.rounds == [5, 10, 12] and e.finished
    assert rmse(e.model(12), vectors[1]) == pytest.approx(e.curve[-1], rel=1e-9)


@pytest.mark.parametrize("kind", ["gbt", "forest"])
def test_search_is_bounded_and_repeats(frames, kind):
    sizes = {"n_trials": 5, "batch": 3, "rungs": (2, 4), "max_rounds": 6, "stage": 2}
    runs = [T.tune(*frames, ["a", "b", "c"], kind, seed=5, **sizes) for _ in range(2)]
    rows = [sorted(map(tuple, r.trials.collect())) for r in runs]
    assert rows[0] == rows[1] and len(rows[0]) == 5
    assert sum(r[-1] for r in rows[0]) == 1
    for _, params, state, trees, best_round, error, best in rows[0]:
        assert T.in_space(json.loads(params), T.SPACES[kind])
        assert 1 <= best_round <= trees <= 6 and state in ("pruned", "budget", "complete", "stopped")
        assert error >= runs[0].best_error and best == (error == runs[0].best_error)
    assert "pruned" in {r[2] for r in rows[0]}
    assert runs[0].model.predict(frames[1]).where("prediction < 0").count() == 0


def test_sampler_goes_where_the_errors_are_small():
    def error(p):
        return (p[0] - 0.8) ** 2 + (p[1] - 0.2) ** 2

    means = []
    for seed in range(8):
        sampler, rng = T.ParzenSampler(2, seed, startup=8), random.Random(seed)
        found = []
        for _ in range(10):
            for p in sampler.ask(4):
                sampler.tell(p, error(p))
                found.append(error(p))
        blind = [error((rng.random(), rng.random())) for _ in range(40)]
        means.append((np.mean(found[20:]), np.mean(blind)))
    assert np.mean([a for a, _ in means]) < 0.4 * np.mean([b for _, b in means])


def test_values_lie_in_the_space():
    for space in T.SPACES.values():
        for u in (0.0, 0.3, 0.999999, 1.0):
            assert T.in_space({k: T.value_at(v, u) for k, v in space.items()}, space)
    assert not T.in_space({"maxDepth": 11}, {"maxDepth": ("int", 3, 10)})
