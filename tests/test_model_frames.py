"""The features of the model entries are built and written once."""

import datetime as dt
from types import SimpleNamespace

from pyspark.sql import functions as F

from sparkcast.operators import features as fe
from sparkcast.plans import q_models


def test_the_features_are_built_once(spark, tmp_path, monkeypatch):
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
    built, create = [], fe.create_features
    monkeypatch.setattr(fe, "create_features", lambda *a, **k: built.append(create(*a, **k)) or built[-1])
    taken = []
    monkeypatch.setattr(q_models.T, "tune", lambda train, *a, **k: taken.append(train) or SimpleNamespace(model=None))
    monkeypatch.setattr(q_models.M, "evaluate_model", lambda model, test: test)
    monkeypatch.setattr(q_models, "_bounded", lambda spark, metrics, train, test: (train, test))
    train, test = q_models.m7_tuned_quality(spark, str(tmp_path))
    assert len(built) == len(taken) == 1 and taken[0].inputFiles()
    for part, mark in ((train, F.col("_train")), (test, ~F.col("_train"))):
        want = built[0].where(mark).drop("_train")
        assert part.inputFiles() and part.dtypes == want.dtypes
        assert part.exceptAll(want).count() == want.exceptAll(part).count() == 0 < part.count()
