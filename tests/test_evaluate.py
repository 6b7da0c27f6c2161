"""Metrics on the reference's fixed vectors, and the split/fold methods."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkcast.operators import evaluate as E
from sparkcast.operators import split as S
from sparkcast.sources.tables import KEY


def _metrics(spark, y, p):
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "label double, prediction double")
    return E.regression_metrics(df).first()


def _numpy(y, p):
    y, p = np.array(y, float), np.array(p, float)
    e = p - y
    sse, sst = (e ** 2).sum(), ((y - y.mean()) ** 2).sum()
    m = y != 0
    return {
        "mae": np.abs(e).mean(), "mse": (e ** 2).mean(), "rmse": math.sqrt((e ** 2).mean()),
        "r2": 1 - sse / sst, "mape": np.abs((y[m] - p[m]) / y[m]).mean() * 100,
        "mean_error": e.mean(), "std_error": e.std(),
    }


@pytest.mark.parametrize(
    "y,p",
    [
        ([1, 2, 3, 4, 5], [1.1, 2.2, 2.9, 4.1, 5.0]),
        ([1, 2, 3, 4, 5], [2, 3, 4, 5, 6]),
        ([10, 20, 30, 40, 50], [12, 18, 33, 38, 52]),
    ],
)
def test_metric_vectors(spark, y, p):
    got = _metrics(spark, y, p)
    for k, v in _numpy(y, p).items():
        assert math.isclose(got[k], v, rel_tol=1e-9, abs_tol=1e-12), k


def test_perfect_prediction(spark):
    got = _metrics(spark, [1, 2, 3], [1, 2, 3])
    assert got.mae == 0 and got.rmse == 0 and got.r2 == 1.0


def test_temporal_split_sizes(demand, demand_pd):
    train, test = S.temporal_split(demand, 0.2)
    n = len(demand_pd)
    k = int(n * 0.8)
    assert train.count() == k and test.count() == n - k
    last_train = demand_pd.iloc[k - 1]
    assert train.agg(F.max(F.struct(*KEY))).first()[0] == tuple(last_train[KEY])


def test_folds_follow_expanding_window(demand, demand_pd):
    out = S.time_series_folds(demand, 5).toPandas().sort_values(KEY).reset_index(drop=True)
    n = len(out)
    block, starts = S.fold_starts(n, 5)
    pos = np.arange(n)
    exp = np.where(pos >= starts[0], (pos - starts[0]) // block + 1, 0)
    assert (out["val_fold"].fillna(0).astype(int).to_numpy() == exp).all()


def test_rank_models(spark):
    m = spark.createDataFrame(
        [("a", 2.0, 4.0, 2.0, 0.5, 1.0, 0.0, 1.0), ("b", 1.0, 1.0, 1.0, 0.9, 1.0, 0.0, 1.0)],
        "model string, mae double, mse double, rmse double, r2 double, mape double, mean_error double, std_error double",
    )
    ranks = {r.model: r.rank for r in E.rank_models(m).collect()}
    assert ranks == {"b": 1, "a": 2}
