"""The search entries run the whole search: 50 trials, each to its own rounds, its patience or a rung."""

import datetime as dt
import json

import duckdb
import pytest
from pyspark.sql import functions as F

from sparkcast.operators.boosting import Ensemble
from sparkcast.plans import catalog, q_models

RUNGS = (10, 30, 90)
OWN = {"gbt": "maxIter", "forest": "numTrees"}


class Falling(Ensemble):
    """Grows without data: a round takes off a hundredth, so no patience ends it."""

    def grow(self, rounds):
        for i in range(len(self.trees) + 1, min(rounds, self.limit) + 1):
            self.trees.append(i)
            self.rounds.append(i)
            self.curve.append(self.params["subsamplingRate"] * 0.99**i)
        return self

    def model(self, rounds=None):
        return f"{len(self.trees)} rounds"


@pytest.fixture()
def small(spark, monkeypatch, tmp_path):
    day = dt.date(2024, 1, 1)
    made = [(day + dt.timedelta(days=i // 4), i % 2, i % 4 // 2, float(i % 7), float(i % 5)) for i in range(80)]
    rows = spark.createDataFrame(
        made, "date date, product_id long, store_id long, a double, target_demand double"
    ).checkpoint()
    last = dt.date(2024, 1, 17)
    frames = rows.where(F.col("date") < last), rows.where(F.col("date") >= last), ["a"]
    monkeypatch.setattr(q_models, "model_frames", lambda *_: frames)
    monkeypatch.setattr(q_models.T, "Ensemble", Falling)
    return str(tmp_path)


def check_whole(trials, kind):
    rows = trials.collect()
    assert sorted(r.trial for r in rows) == list(range(50))
    for r in rows:
        own = json.loads(r.params)[OWN[kind]]
        assert (r.state, r.trees) == ("complete", own) or (r.state == "pruned" and r.trees in RUNGS and r.trees < own)
    whole = [r.trees for r in rows if r.state == "complete"]
    assert whole and max(whole) > 90


def check_bounds(found, sql):
    want = duckdb.sql(sql).fetchall()
    assert len(want) == 50 and sorted(map(tuple, found.collect())) == sorted(want)


def test_m7_search_is_whole(spark, small):
    check_whole(q_models.m7_search(spark, small), "gbt")


def test_m7_search_bounds_is_whole(spark, small):
    check_bounds(q_models.m7_search_bounds(spark, small), catalog.ORACLE["m7_search_bounds"])


def test_m7_tuned_quality_takes_the_whole_search(spark, small, monkeypatch):
    taken = []
    monkeypatch.setattr(q_models.M, "evaluate_model", lambda model, test: taken.append(model))
    monkeypatch.setattr(q_models, "_bounded", lambda *_: None)
    q_models.m7_tuned_quality(spark, small)
    search = q_models.searched(spark, small)
    check_whole(search.trials, "gbt")
    best = search.trials.where("best").first()
    assert taken == [search.model] and search.model.model.stages[-1] == f"{best.trees} rounds"


def test_m7_search_forest_is_whole(spark, small):
    check_whole(q_models.m7_search_forest(spark, small), "forest")


def test_m7_search_bounds_forest_is_whole(spark, small):
    check_bounds(q_models.m7_search_bounds_forest(spark, small), catalog.ORACLE["m7_search_bounds_forest"])


@pytest.mark.parametrize("kind", ["gbt", "forest"])
def test_a_trial_that_a_bound_ends_is_seen(spark, monkeypatch, kind):
    params = json.dumps({"maxIter": 213, "numTrees": 213})
    rows = [(0, params, "complete", 213, 200, 1.0, True), (1, params, "budget", 16, 16, 2.0, False),
            (2, params, "complete", 16, 16, 2.0, False), (3, params, "pruned", 10, 10, 2.0, False),
            (4, params, "stopped", 40, 20, 2.0, False)]
    trials = spark.createDataFrame(rows, q_models.T.TRIALS)
    monkeypatch.setattr(q_models, "searched", lambda *_: q_models.T.Search(trials, {}, 1.0, None))
    found = {r.trial: r.within_rounds for r in q_models._bounds(spark, "", kind).collect()}
    assert found == {0: True, 1: False, 2: False, 3: True, 4: True}


def test_fits_at_the_same_time_share_the_cores(spark, small):
    train, _, cols = q_models.model_frames(spark, small)
    model = q_models.M.DemandModel(cols)
    shaped = model.shaped(train)
    cores, before = spark.sparkContext.defaultParallelism, spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(25 * cores))
        found = model.vectors(shaped, train, fits=cores)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found.rdd.getNumPartitions() == 2 and found.count() == train.count()
