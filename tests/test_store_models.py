"""Feature store round trip and trimming; model quality bound vs mean baseline."""

import pytest
from pyspark.sql import functions as F

from sparkcast.operators import evaluate as E
from sparkcast.operators import features as fe
from sparkcast.operators import models as M
from sparkcast.operators import split as S
from sparkcast.session import scratch_dir
from sparkcast.sources.store import FeatureStore


def test_store_round_trip_and_trim(spark, demand):
    st = FeatureStore(spark, scratch_dir(spark, "test-store"))
    for i in range(1, 6):
        st.save_features(demand, "demand", f"v{i}", {"i": i})
    assert st.load_features("demand").count() == demand.count()
    assert [r.version for r in st.list_feature_versions("demand").collect()] == ["v5", "v4", "v3", "v2", "v1"]
    assert st.delete_old_versions("demand", keep_last=3) == 2
    assert [r.version for r in st.list_feature_versions("demand").collect()] == ["v5", "v4", "v3"]
    with pytest.raises(FileNotFoundError):
        st.load_features("demand", "v1")
    with pytest.raises(FileNotFoundError):
        st.load_features("other")


def test_model_beats_one_and_half_mean_baseline(spark, demand):
    feats = fe.create_features(demand)
    train, test = S.temporal_split(feats, 0.2)
    cols = fe.training_columns(feats)
    model = M.DemandModel(cols, "gbt", {"maxIter": 10, "maxDepth": 4}).fit(train)
    pred = model.predict(test)
    assert pred.where(F.col("prediction") < 0).count() == 0
    assert pred.where(F.isnan("prediction")).count() == 0
    mae = E.regression_metrics(pred, "target_demand").first().mae
    mean = train.agg(F.avg("target_demand")).first()[0]
    base = E.regression_metrics(test.withColumn("p", F.lit(mean)), "target_demand", "p").first().mae
    assert mae <= 1.5 * base
    path = scratch_dir(spark, "test-model")
    model.save(path)
    again = M.DemandModel.load(spark, path)
    assert again.feature_cols == cols
    assert again.feature_importance(spark).count() == len(cols)


def test_unfitted_predict_raises(demand):
    with pytest.raises(ValueError):
        M.DemandModel(["price"]).predict(demand)


def test_a_failed_save_leaves_the_old_version(spark, demand):
    st = FeatureStore(spark, scratch_dir(spark, "test-atomic"))
    st.save_features(demand, "demand", "v1")
    old = st.load_features("demand", "v1")
    with pytest.raises(Exception):
        st.save_features(demand.withColumn("x", F.raise_error(F.lit("stop"))), "demand", "v1")
    assert st.load_features("demand", "v1").columns == demand.columns
    st.save_features(demand.select("price"), "demand", "v1")
    # a reader that began before the second save keeps its snapshot
    assert old.count() == demand.count() and old.columns == demand.columns
    assert st.load_features("demand", "v1").columns == ["price"]
    assert st.get_feature_metadata("demand", "v1").first().dtypes == '{"price": "double"}'


def test_no_writer_loses_an_event(spark):
    from concurrent.futures import ThreadPoolExecutor

    root = scratch_dir(spark, "test-writers")
    stores = [FeatureStore(spark, root) for _ in range(4)]
    rows = spark.range(5)
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: stores[i % 4].save_features(rows, "f", f"v{i}"), range(12)))
    assert stores[0].list_feature_versions("f").count() == 12
    assert sorted(stores[0]._numbers()) == list(range(1, 13))
    # a number taken by another process is not replaced
    taken = stores[0]._numbers
    stores[1]._numbers = lambda: taken()[:0]
    assert stores[1]._append_log([{"event": "delete", "name": "f", "version": "v0"}]) == 13
    assert stores[0].list_feature_versions("f").count() == 11


def test_csv_quarantine_loses_no_line(spark, tmp_path):
    from sparkcast.sources.tables import RAW_COLUMNS, load_csv_with_rejects

    good = "2024-01-02,1,2,3,4,9.99,0,1,100.0,7"
    lines = [good, good.replace("9.99", "x"), good + ",1", "", "2024-01-02,1", good.replace("2024-01-02", "")]
    (tmp_path / "a.csv").write_text("\n".join([",".join(RAW_COLUMNS), *lines]) + "\n")
    accepted, rejected = load_csv_with_rejects(spark, str(tmp_path))
    found = {r.line: (r.reason, [tuple(c) for c in r.bad_cells]) for r in rejected.collect()}
    assert accepted.count() == 2 and accepted.where("date is null").count() == 1
    assert found == {
        lines[1]: ("cells", [("price", "x", "double")]),
        lines[2]: ("width", []),
        lines[4]: ("width", []),
    }
