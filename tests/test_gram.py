"""Pairwise-complete correlations against pandas."""

import numpy as np
import pandas as pd

from sparkcast.operators import explore, gram, profile


def _frame(rows=400):
    rng = np.random.default_rng(3)
    x = rng.normal(size=rows)
    df = pd.DataFrame({"x": x + 1e7, "y": 2 * x + rng.normal(size=rows), "flat": 0.1, "none": np.nan})
    df["z"] = np.where(rng.random(rows) < 0.3, np.nan, x * x)
    df["w"] = np.where(df["z"].isna(), rng.normal(size=rows), np.nan)  # never beside z
    return df


def _close(got, want):
    if want is None or np.isnan(want):
        return got is None
    return got is not None and abs(got - want) < 1e-9


def test_pairs_equal_pandas(spark):
    pdf = _frame()
    cols = list(pdf.columns)
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), ", ".join(f"{c} double" for c in cols))
    df = df.repartition(7)
    want = pdf.corr()
    rows = gram.pair_correlations(df, cols).collect()
    assert len(rows) == len(cols) ** 2
    for r in rows:
        expected = None if "flat" in (r["col1"], r["col2"]) else want.loc[r["col1"], r["col2"]]
        assert _close(r["r"], expected), r
    for r in explore.target_correlations(df, "y").collect():
        expected = None if r["column"] == "flat" else want.loc[r["column"], "y"]
        assert _close(r["correlation"], expected), r
    # NaN is missing, as NULL
    nan = spark.createDataFrame(pdf)
    assert {(r["col1"], r["col2"]): r["r"] is None for r in rows} == {
        (r["col1"], r["col2"]): r["r"] is None for r in gram.pair_correlations(nan, cols).collect()
    }


def test_many_columns_and_no_rows(spark):
    many = spark.range(50).selectExpr(*[f"sin(id * {k + 1}) AS c{k}" for k in range(200)])
    rows = profile.correlation_long(many).collect()
    assert len(rows) == 200 * 200 and all(r["r"] is not None for r in rows)
    empty = profile.correlation_long(many.limit(0), ["c0", "c1"]).collect()
    assert len(empty) == 4 and all(r["r"] is None for r in empty)
    assert profile.high_correlations(many.limit(0), ["c0", "c1"]).count() == 0
