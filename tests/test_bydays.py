"""Lags and rolling statistics by days against plain Python."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from sparkcast.operators import bydays

BEGIN = dt.date(1969, 12, 1)  # day numbers on both sides of zero


def messy_rows(seed=4, n=500):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        day = BEGIN + dt.timedelta(days=rng.choice([rng.randrange(120), 40, 41]))  # gaps, two full days
        rows.append(
            (
                i,
                None if rng.random() < 0.03 else day,
                rng.choice([1, 1, 2, 3, None]),
                None if rng.random() < 0.1 else 1e9 + rng.randrange(100) / 4,
            )
        )
    return rows + rows[:5]  # repeated rows


SCHEMA = "id long, date date, product_id long, v double"


def brute(rows, row, k, until, grouped):
    _, day, g, _ = row
    if day is None or (grouped and g is None):
        return None
    return [
        v
        for _, d, h, v in rows
        if d is not None and v is not None and until <= (day - d).days <= k and (not grouped or h == g)
    ]


@pytest.mark.parametrize("group_cols", [["product_id"], None])
@pytest.mark.parametrize("span", [7, 31, None])
def test_against_brute_force(spark, group_cols, span):
    rows = messy_rows()
    out = bydays.day_features(
        spark.createDataFrame(rows, SCHEMA),
        "v",
        lags=(1, 7),
        windows=(3, 7),
        stats=tuple(bydays.DAY_STATS),
        group_cols=group_cols,
        span=span,
    )
    got = sorted(map(tuple, out.collect()), key=lambda r: r[0])
    assert len(got) == len(rows)
    names = out.columns
    for have, row in zip(got, sorted(rows, key=lambda r: r[0])):
        have = dict(zip(names, have))
        for k in (1, 7):
            x = brute(rows, row, k, k, bool(group_cols))
            assert have[f"lag_{k}d"] == (pytest.approx(statistics.fmean(x), abs=1e-6) if x else None)
        for w in (3, 7):
            x = brute(rows, row, w, 1, bool(group_cols))
            want = {
                "mean": statistics.fmean(x) if x else None,
                "std": statistics.stdev(x) if x and len(x) > 1 else None,
                "var": statistics.variance(x) if x and len(x) > 1 else None,
                "min": min(x) if x else None,
                "max": max(x) if x else None,
                "sum": sum(x) if x else None,
                "count": None if x is None else len(x),
            }
            for s, value in want.items():
                value = value if value is None else pytest.approx(value, rel=1e-9, abs=1e-5)
                assert have[f"rolling_{w}d_{s}"] == value, (row, w, s)


def test_a_gap_is_not_skipped(spark):
    days = [BEGIN, BEGIN + dt.timedelta(days=1), BEGIN + dt.timedelta(days=5)]
    df = spark.createDataFrame([(i, d, 1, float(i)) for i, d in enumerate(days)], SCHEMA)
    got = bydays.create_day_lag_features(df, "v", lags=(1, 4), group_cols=["product_id"]).orderBy("id").collect()
    assert [(r.lag_1d, r.lag_4d) for r in got] == [(None, None), (0.0, None), (None, 1.0)]


def test_empty_table_and_clashing_names(spark):
    empty = spark.createDataFrame([], SCHEMA)
    out = bydays.create_day_rolling_features(empty, "v", windows=(7,), group_cols=["product_id"])
    assert out.columns == ["id", "date", "product_id", "v", *[f"rolling_7d_{s}" for s in ("mean", "std", "min", "max")]]
    assert out.count() == 0
    df = spark.createDataFrame([(1, BEGIN, 1, 2.0)], SCHEMA).withColumn("lag_1d", F.lit("old")).withColumn("_day", F.lit(9)).withColumn("_n", F.lit(5))
    row = bydays.create_day_lag_features(df, "v", lags=(1,), group_cols=["product_id"]).first()
    assert row.asDict() == {"id": 1, "date": BEGIN, "product_id": 1, "v": 2.0, "_day": 9, "_n": 5, "lag_1d": None}


def test_refuses_what_it_cannot_do(spark):
    df = spark.createDataFrame([(1, BEGIN, 1, 2.0)], SCHEMA)
    for bad in (dict(lags=(0,)), dict(windows=(7,), stats=("mode",)), dict(windows=(7,), span=3)):
        with pytest.raises(ValueError):
            bydays.day_features(df, "v", group_cols=["product_id"], **bad)


def test_days_are_summed_before_the_shuffle(demand):
    out = bydays.create_day_rolling_features(demand, stats=("mean",))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "SinglePartition" not in plan and "CartesianProduct" not in plan
