"""What fitting costs: jobs by round, readings of the input and of lineitem."""

import datetime as dt

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Window
from pyspark.sql import functions as F

from sparkcast.operators import models as M
from sparkcast.operators import ordered
from sparkcast.operators import split as S
from sparkcast.operators.boosting import FEATURES, LABEL, Ensemble
from sparkcast.plans import q_models

PARAMS = {"maxDepth": 3, "stepSize": 0.5, "maxIter": 60, "subsamplingRate": 0.8, "featureSubsetStrategy": "1.0", "seed": 3}


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    x = rng.uniform(-1, 1, (400, 2))
    y = 3 * x[:, 0] ** 2 + np.sign(x[:, 1]) + rng.normal(0, 0.3, 400)
    made = [(float(a), float(b), float(c)) for (a, b), c in zip(x, y)]
    return spark.createDataFrame(made, "a double, b double, target_demand double").checkpoint()


def test_a_round_costs_no_more_than_its_levels(spark, rows):
    vectors = VectorAssembler(inputCols=["a", "b"], outputCol=FEATURES).transform(rows)
    vectors = vectors.select(FEATURES, F.col("target_demand").alias(LABEL)).checkpoint()
    sc, jobs = spark.sparkContext, {}
    for n in (5, 15):
        sc.setJobGroup(f"rounds {n}", "")
        e = Ensemble(vectors, vectors, "gbt", PARAMS, patience=100, stage=5).grow(n).close()
        assert len(e.trees) == len(e.curve) == n
        jobs[n] = len(sc.statusTracker().getJobIdsForGroup(f"rounds {n}"))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[15] - jobs[5] <= 10 * PARAMS["maxDepth"] + 5


def test_rows_without_a_label_are_not_judged(spark, rows):
    vectors = VectorAssembler(inputCols=["a", "b"], outputCol=FEATURES).transform(rows)
    vectors = vectors.select(FEATURES, F.col("target_demand").alias(LABEL)).checkpoint()
    blank = vectors.limit(5).withColumn(LABEL, F.lit(None).cast("double"))
    a, b = (Ensemble(vectors, c, "gbt", PARAMS).grow(3).close().curve for c in (vectors, vectors.unionByName(blank)))
    assert a == pytest.approx(b, rel=1e-12)
    assert Ensemble(vectors, vectors.limit(0), "gbt", PARAMS).grow(2).close().curve == [float("inf")] * 2


@pytest.mark.parametrize("kind", ["gbt", "forest"])
def test_fit_reads_its_input_twice(spark, rows, kind):
    read = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def seen(x):
        read.add(1)
        return x

    watched = rows.withColumn("a", seen.asNondeterministic()("a"))
    size = {"maxDepth": 2, "maxIter": 2} if kind == "gbt" else {"maxDepth": 2, "numTrees": 2}
    M.DemandModel(["a", "b"], kind, size).fit(watched)
    assert read.value <= 2 * rows.count()


def test_the_panel_is_aggregated_once(spark, tmp_path, monkeypatch):
    day = dt.datetime(2024, 1, 1)
    made = [
        (i % 3, i % 2, 1 + i % 4, float(1 + i % 5), 100.0 + i, 0.05, 0.02, day + dt.timedelta(days=i // 4))
        for i in range(80)
    ]
    spark.createDataFrame(
        made,
        "l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_shipdate timestamp",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    given, mask = [], S.temporal_train_mask
    monkeypatch.setattr(S, "temporal_train_mask", lambda d, share: given.append(d) or mask(d, share))
    train, test, _ = q_models.model_frames(spark, str(tmp_path))
    assert not [f for f in given[0].inputFiles() if "lineitem" in f]
    view = q_models.demand_view(spark, str(tmp_path))
    assert sorted(map(tuple, given[0].select(*view.columns).collect())) == sorted(map(tuple, view.collect()))
    assert train.count() + test.count() == view.count()


def test_vectors_have_no_more_parts_than_cores_and_rows_need(spark, rows, monkeypatch):
    model = M.DemandModel(["a", "b"], "forest")
    shaped = model.shaped(rows)
    cores, before = spark.sparkContext.defaultParallelism, spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(25 * cores))
        few = model.vectors(shaped, rows)
        monkeypatch.setattr(M, "PART_ROWS", 20)
        more = model.vectors(shaped, rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert few.rdd.getNumPartitions() == 2 * cores
    assert more.rdd.getNumPartitions() == max(2 * cores, 20)
    assert few.count() == more.count() == rows.count()


def test_quantiles_do_not_deal_all_values_by_column(rows):
    found = ordered.quantiles(rows, ["a", "b"], [0.25, 0.5, 0.75])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    a = np.array([r.a for r in rows.collect()])
    got = {r.q: r.value for r in found.where("column = 'a'").collect()}
    assert got == pytest.approx({q: np.quantile(a, q) for q in got}, rel=1e-12) and len(got) == 3


def test_the_rows_of_a_fit_are_dealt_evenly(spark, rows, monkeypatch):
    fitted_on, fit = [], M.GBTRegressor.fit
    monkeypatch.setattr(M.GBTRegressor, "fit", lambda self, df: fitted_on.append(df) or fit(self, df))
    key = "spark.sql.codegen.hugeMethodLimit"
    before, limits, fit_stages = spark.conf.get(key), [], M.Pipeline.fit
    monkeypatch.setattr(M.Pipeline, "fit", lambda self, df: limits.append(spark.conf.get(key)) or fit_stages(self, df))
    # one part holds nearly all rows
    uneven = rows.withColumn("i", F.row_number().over(Window.orderBy("a"))).repartitionByRange(
        3, F.when(F.col("i") <= 380, 0).otherwise(F.col("i"))
    )
    for _ in range(2):
        m = M.DemandModel(["a", "b"], "gbt", {"maxDepth": 2, "maxIter": 2}).fit(uneven)
        assert m.model.stages[-1].getLabelCol() == "target_demand"
    sizes = fitted_on[0].rdd.glom().map(len).collect()
    assert len(sizes) % spark.sparkContext.defaultParallelism == 0
    assert sum(sizes) == 400 and max(sizes) <= 2 * 400 / len(sizes)
    one, two = (df.rdd.glom().collect() for df in fitted_on)
    assert one == two
    assert set(limits) == {"8000"} and spark.conf.get(key) == before
