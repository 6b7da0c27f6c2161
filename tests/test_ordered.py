"""The parallel ordered methods against brute force (metamorphic checks)."""

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from sparkcast.operators import features as fe
from sparkcast.operators import ordered
from sparkcast.sources.tables import KEY


def test_ordinal_is_dense_row_number(demand):
    got = ordered.with_ordinal(demand, KEY, num_partitions=5)
    ref = demand.withColumn("rn", F.row_number().over(Window.orderBy(*KEY)) - 1)
    joined = got.join(ref, KEY)
    assert joined.where(F.col(ordered.ORD) != F.col("rn")).count() == 0
    assert got.count() == demand.count()


def test_keys_at_ranks_brute_force(demand_pd, demand):
    ranks = [1, 17, len(demand_pd) // 2, len(demand_pd)]
    got = ordered.keys_at_ranks(demand, KEY, ranks)
    for rank, key in zip(ranks, got):
        row = demand_pd.iloc[rank - 1]
        assert (row["date"], row["product_id"], row["store_id"]) == key


def test_quantiles_equal_numpy(demand, demand_pd):
    cols = ["price", "target_demand", "promotion_flag"]
    qs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {(r.column, r.q): r.value for r in ordered.quantiles(demand, cols, qs).collect()}
    for c in cols:
        for q in qs:
            assert abs(got[(c, q)] - float(np.quantile(demand_pd[c].astype(float), q))) < 1e-9


def test_quantiles_beyond_the_sketch(spark):
    """Small groups, ties, and more rows than the sketch holds exactly."""
    rng = np.random.default_rng(2)
    values = {
        "one": [4.0], "two": [1.0, 2.0], "ties": [3.0] * 50 + [9.0], "many": rng.normal(size=150_000).tolist(),
        "heavy": np.repeat([0.0, 1.0, 5.0], [70_000, 1, 60_000]).tolist(),
    }
    df = spark.createDataFrame(
        pd.DataFrame([(k, x) for k, v in values.items() for x in v], columns=["k", "x"])
    )
    qs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {(r.k, r.q): r.value for r in ordered.quantiles(df, ["x"], qs, by=["k"]).collect()}
    for k, v in values.items():
        for q in qs:
            assert abs(got[k, q] - np.quantile(v, q)) < 1e-9, (k, q)


def test_quantiles_by_group(demand, demand_pd):
    got = ordered.quantiles(demand, ["target_demand"], [0.5], by=["promotion_flag"]).collect()
    for r in got:
        part = demand_pd[demand_pd.promotion_flag == r.promotion_flag]["target_demand"]
        assert abs(r.value - float(part.median())) < 1e-9


def _features_equal(a, b, cols):
    pa = a.toPandas().sort_values(KEY).reset_index(drop=True)
    pb = b.toPandas().sort_values(KEY).reset_index(drop=True)
    assert len(pa) == len(pb)
    for c in cols:
        x = pa[c].astype(float).fillna(-999.0).to_numpy()
        y = pb[c].astype(float).fillna(-999.0).to_numpy()
        assert np.allclose(x, y, rtol=1e-9, atol=1e-9), c


def test_chunked_equals_partitioned_per_series(demand):
    base = demand.select(*KEY, "target_demand", "price")
    cols = ["lag_1", "lag_7", "rolling_7_mean", "rolling_14_std", "rolling_30_max"]
    a = fe.create_lag_features(base, lags=(1, 7), strategy="partition")
    a = fe.create_rolling_features(a, strategy="partition")
    b = fe.create_lag_features(base, lags=(1, 7), strategy="chunked", chunk_rows=64)
    b = fe.create_rolling_features(b, strategy="chunked", chunk_rows=64)
    _features_equal(a, b, cols)


def test_global_lag_by_chunks_equals_one_window(demand):
    base = demand.select(*KEY, "target_demand")
    got = fe.create_lag_features(base, lags=(1, 30), group_cols=None, chunk_rows=50)
    w = Window.orderBy(*KEY)
    ref = base.withColumns({"lag_1": F.lag("target_demand", 1).over(w), "lag_30": F.lag("target_demand", 30).over(w)})
    _features_equal(got, ref, ["lag_1", "lag_30"])


def test_partition_count_does_not_change_results(spark, demand):
    base = demand.select(*KEY, "target_demand")
    a = fe.create_rolling_features(base.repartition(1), strategy="partition")
    b = fe.create_rolling_features(base.repartition(7), strategy="partition")
    _features_equal(a, b, ["rolling_7_mean", "rolling_30_std"])


def test_rank_boundaries_with_nulls_and_ties(spark):
    rows = [(None, 1), (3, 2), (3, 2), (3, 2), (1, None), (1, 5), (None, None), (2, 0)]
    df = spark.createDataFrame(rows, "a int, b int")
    order = sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))
    n, got = ordered.rank_boundaries(df, ["a", "b"], lambda n: range(1, n + 1))
    assert n == len(rows)
    for i, (key, place, size) in enumerate(got):
        assert key == order[i]
        assert size == rows.count(key) and place == i - order.index(key) + 1


def test_running_totals(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"), (F.col("id") % 5).alias("v"))
    got, total = ordered.running_totals(df, ["k"], "v", "cum", 7)
    rows = got.orderBy("k").collect()
    assert total == sum(r.v for r in rows)
    assert [r.cum for r in rows] == np.cumsum([r.v for r in rows]).tolist()


def test_create_features_chunked_equals_partitioned(demand):
    from sparkcast.sources.tables import with_nulls

    src = with_nulls(demand)
    a = fe.create_features(src, strategy="partition")
    b = fe.create_features(src, strategy="chunked", chunk_rows=500)
    assert sorted(a.columns) == sorted(b.columns)
    num = [c for c, t in a.dtypes if t in ("double", "bigint", "int")]
    _features_equal(a, b, num)


def test_hot_series_matches(demand):
    """One series holding about a third of all rows gives the same features
    in chunks as in one task."""
    n = demand.count()
    hot = (
        demand.limit(n // 2)
        .withColumn("date", F.date_add(F.lit("1990-01-01").cast("date"), F.monotonically_increasing_id().cast("int")))
        .withColumn("product_id", F.lit(999))
        .withColumn("store_id", F.lit(99).cast("bigint"))
    )
    skewed = demand.unionByName(hot).cache()
    a = fe.create_features(skewed, strategy="partition")
    b = fe.create_features(skewed, chunk_rows=1000)
    num = [c for c, t in a.dtypes if t in ("double", "bigint", "int")]
    _features_equal(a, b, num)
