"""Drift and quality against a stored reference: equal to the two-sided form."""

import math

import pytest
from pyspark.sql import functions as F

from sparkcast.operators import drift as D
from sparkcast.operators import drift_reference as DR
from sparkcast.session import scratch_dir
from sparkcast.sources.store import FeatureStore

COLS = "x double, n int, flag int, name string, none double"


def _frames(spark):
    rows = [(None if i % 7 == 0 else float(i % 13), i % 5, i % 2, "ab"[i % 2], None) for i in range(200)]
    cur = [(float(i % 9) * 2, 3, 1, None if i % 3 else "c", None) for i in range(90)]
    return spark.createDataFrame(rows, COLS), spark.createDataFrame(cur, COLS)


def _rows(df):
    def same(v):
        return round(v, 9) if isinstance(v, float) and not math.isnan(v) else v

    return sorted((tuple(same(v) for v in r) for r in df.collect()), key=str)


def test_stored_reference_equals_two_sides(spark):
    ref, cur = _frames(spark)
    num, cat, quality = ["x", "n", "none"], ["flag", "name"], ["x", "n", "flag", "none"]
    odd = F.col("n") % 2 == 1
    halves = [DR.fit_reference(ref.where(c), num, cat, quality) for c in (odd, ~odd)]
    store = FeatureStore(spark, scratch_dir(spark, "reference"))
    halves[0].merge(halves[1]).save(store, "t", "v1")
    kept = DR.load_reference(store, "t")
    assert kept.counts.count() < ref.count()

    whole = D.column_drift(ref, cur, num, cat)
    assert _rows(DR.drift_against(kept, cur).select(whole.columns)) == _rows(whole)
    run, plain = DR.monitoring_against(kept, cur), D.monitoring_run(ref, cur, 0.1, num, cat, quality)
    assert _rows(run["dataset"]) == _rows(plain["dataset"])
    assert _rows(run["quality"].select(plain["quality"].columns)) == _rows(plain["quality"])


def test_reference_edges(spark):
    ref, cur = _frames(spark)
    kept = DR.fit_reference(ref, ["x"], ["name"], ["x"])
    with pytest.raises(ValueError, match="lack columns"):
        DR.drift_against(kept, cur.drop("name"))
    with pytest.raises(ValueError, match="different columns"):
        kept.merge(DR.fit_reference(ref, ["n"], [], []))
    for r in DR.drift_against(kept, cur.limit(0)).collect():
        assert r["drift_detected"] is False
    figures = {r["side"]: r for r in DR.monitoring_against(kept, cur.limit(0))["quality"].collect()}
    assert figures["current"]["rows"] == 0 and figures["current"]["q50"] is None
    assert figures["reference"]["rows"] == 200 and figures["reference"]["missing"] == 29
    blank = DR.fit_reference(ref.limit(0), ["x"], ["name"], ["x"])
    assert all(r["drift_detected"] is False for r in DR.drift_against(blank, cur).collect())
