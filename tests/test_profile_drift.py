"""Profile moments and drift statistics against numpy brute force."""

import numpy as np

from sparkcast.operators import drift as D
from sparkcast.operators import profile as P
from sparkcast.operators import split as S


def test_target_statistics_bias_corrected(demand, demand_pd):
    import pandas as pd

    row = P.target_statistics(demand).first()
    t = demand_pd["target_demand"].astype(float)
    assert row.skewness == round(float(t.skew()), 2)
    assert row.kurtosis == round(float(t.kurtosis()), 2)
    assert row.median == float(t.median())
    assert isinstance(t, pd.Series)


def test_correlation_null_on_constant(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, b double")
    rows = {(r.col1, r.col2): r.r for r in P.correlation_long(df, ["a", "b"]).collect()}
    assert rows[("a", "b")] is None and abs(rows[("a", "a")] - 1.0) < 1e-12


def _ks_w(a, b):
    grid = np.unique(np.concatenate([a, b]))
    fa = np.searchsorted(np.sort(a), grid, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), grid, side="right") / len(b)
    return np.abs(fa - fb).max(), (np.abs(fa - fb)[:-1] * np.diff(grid)).sum()


def test_ks_and_wasserstein_match_numpy(demand, demand_pd):
    ref, cur = S.temporal_split(demand, 0.2)
    k = int(len(demand_pd) * 0.8)
    got = {r.column: r for r in D.numeric_drift(ref, cur, ["price", "historical_sales"]).collect()}
    for c in ("price", "historical_sales"):
        a = demand_pd[c].to_numpy(float)[:k]
        b = demand_pd[c].to_numpy(float)[k:]
        ks, w = _ks_w(a, b)
        assert abs(got[c].ks - ks) < 1e-12
        assert abs(got[c].wasserstein - w) < 1e-6
        assert abs(got[c].ref_std - a.std()) < 1e-6


def test_dataset_drift_share(demand):
    ref, cur = S.temporal_split(demand, 0.2)
    cols = D.column_drift(ref, cur, ["price", "historical_sales"], ["promotion_flag"])
    row = D.dataset_drift(cols).first()
    assert row.number_of_columns == 3
    assert row.share_of_drifted_columns == row.number_of_drifted_columns / 3
