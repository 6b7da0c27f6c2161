"""Feature pipeline (reference: engineering tests) plus value checks."""

import math

import numpy as np
from pyspark.sql import functions as F

from sparkcast.functions.calendar import full_calendar
from sparkcast.operators import features as fe
from sparkcast.sources.tables import KEY


def test_create_features_columns(demand):
    out = fe.create_features(demand)
    for c in ["lag_1", "lag_30", "rolling_7_mean", "rolling_30_std", "price_vs_mean", "promo_weekend",
              "day_of_week_sin", "is_quarter_end"]:
        assert c in out.columns
    assert len(out.columns) > len(demand.columns)
    nulls = out.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in out.columns]).first().asDict()
    n = out.count()
    assert all(v < n for v in nulls.values())  # no column entirely null
    assert nulls["lag_1"] == 0  # lags filled with 0
    assert set(r[0] for r in out.select("is_weekend").distinct().collect()) <= {0, 1}


def test_rolling_matches_pandas_shift_rolling(demand, demand_pd):
    out = fe.create_rolling_features(demand.select(*KEY, "target_demand"), windows=(7,), stats=("mean", "std"))
    got = out.toPandas().sort_values(KEY).reset_index(drop=True)
    g = demand_pd.groupby(["product_id", "store_id"])["target_demand"]
    exp_mean = g.transform(lambda x: x.shift(1).rolling(7, min_periods=1).mean())
    exp_std = g.transform(lambda x: x.shift(1).rolling(7, min_periods=1).std())
    assert np.allclose(got["rolling_7_mean"].astype(float).fillna(-1), exp_mean.fillna(-1))
    assert np.allclose(got["rolling_7_std"].astype(float).fillna(-1), exp_std.fillna(-1))


def test_pct_change_carries_nulls_like_pandas(spark):
    import pandas as pd

    rows = [("2024-01-0%d" % i, 1, 1, p) for i, p in enumerate([10.0, None, 12.0, 6.0, None], start=1)]
    df = spark.createDataFrame(rows, "date string, product_id long, store_id long, price double").withColumn(
        "date", F.to_date("date")
    )
    got = fe.create_price_features(df).orderBy("date").select("price_change_pct").toPandas()["price_change_pct"]
    exp = pd.Series([10.0, None, 12.0, 6.0, None]).ffill().pct_change().fillna(0)
    assert np.allclose(got.to_numpy(), exp.to_numpy())


def test_calendar_iso_edges(spark):
    df = spark.createDataFrame([("2024-12-30",), ("2024-03-31",), ("2024-01-01",)], "d string").select(
        F.to_date("d").alias("date")
    )
    rows = {str(r.date): r for r in df.select("date", *[v.alias(k) for k, v in full_calendar().items()]).collect()}
    assert rows["2024-12-30"].week_of_year == 1 and rows["2024-12-30"].day_of_week == 0
    assert rows["2024-03-31"].is_quarter_end == 1 and rows["2024-03-31"].is_month_end == 1
    assert rows["2024-01-01"].is_quarter_start == 1 and rows["2024-01-01"].is_month_start == 1


def test_serving_features_and_align(spark):
    df = spark.createDataFrame(
        [("2024-01-15", 1, 2, 3, 150.5, 29.99, 1, 0, 102.5)],
        "prediction_date string, product_id long, category_id long, store_id long, historical_sales double, "
        "price double, promotion_flag long, holiday_flag long, economic_index double",
    ).withColumn("prediction_date", F.to_date("prediction_date"))
    f = fe.serving_features(df).first()
    assert f.store_category == 302 and f.sales_lag_30 == 150.5 and f.sales_rolling_std_7 == 0.0
    assert math.isclose(f.price_per_category, 29.99 / 2)
    aligned = fe.align_columns(fe.serving_features(df), ["price", "lag_1", "store_id"])
    assert aligned.columns == ["price", "lag_1", "store_id"] and aligned.first().lag_1 == 0


def test_pct_change_chunked_carries_long_null_runs(spark):
    """A NULL run longer than any halo must still carry the last price."""
    import pandas as pd

    prices = [10.0] + [None] * 80 + [12.0, 6.0] + [None] * 5
    rows = [(i, 1, 1, p) for i, p in enumerate(prices)]
    df = spark.createDataFrame(rows, "d long, product_id long, store_id long, price double").withColumn(
        "date", F.date_add(F.lit("2024-01-01").cast("date"), F.col("d").cast("int"))
    ).drop("d")
    exp = pd.Series(prices).ffill().pct_change().fillna(0).to_numpy()
    for strategy in ("partition", "chunked"):
        got = fe._with_price_changes(df, "price", ["product_id", "store_id"], "date", strategy, 16)
        got = got.orderBy("date").select("price_change_pct").toPandas()["price_change_pct"].to_numpy()
        assert np.allclose(got, exp), strategy


def test_null_series_key_rows(spark, demand):
    """Rows with a NULL series key keep NULL group features (pandas drops
    NULL groups) but still count for global min/max."""
    odd = demand.limit(3).withColumn("store_id", F.lit(None).cast("bigint")).withColumn("price", F.lit(1e6))
    out = fe.create_features(demand.unionByName(odd)).where(F.col("store_id").isNull()).collect()
    assert len(out) == 3
    assert all(r.price_mean is None and r.lag_1 == 0 for r in out)
    top = fe.create_features(demand.unionByName(odd)).agg(F.min("promo_discount_effect")).first()[0]
    assert top is None or top <= 1.0
    eff = fe.create_features(demand.unionByName(odd)).where(F.col("store_id").isNull()).select(
        "promotion_flag", "promo_discount_effect"
    ).collect()
    assert all(r.promo_discount_effect == 0.0 for r in eff)  # price at the global max -> scaled 1
