"""Features of new days from a fitted state: appended = recomputed."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sparkcast.operators import appending
from sparkcast.operators import features as fe
from sparkcast.session import scratch_dir
from sparkcast.sources.store import FeatureStore

SCHEMA = (
    "date date, product_id bigint, store_id bigint, price double, economic_index double, "
    "promotion_flag int, historical_sales double, target_demand double, _extra string"
)


def _panel(spark):
    """Two long series, one that starts after the cut, one with NULL prices at
    the cut, a NULL key."""
    rows = []
    for product, store, start, days in [(1, 1, 0, 60), (1, 2, 0, 45), (2, 1, 47, 10), (3, None, 30, 25)]:
        for i in range(start, start + days):
            price = None if product == 1 and store == 1 and 36 <= i <= 43 else 10.0 + (i * 7 + product) % 11
            day = dt.date(2024, 1, 1) + dt.timedelta(days=i)
            rows.append((day, product, store, price, 100.0 + i % 5, i % 2, float(i), float((i * i) % 17), "x"))
    return spark.createDataFrame(rows, SCHEMA)


CUT, MID = "2024-02-10", "2024-02-20"


def _whole(df, groups):
    """Window columns of the whole panel, not filled, rows from the cut on."""
    out = fe.window_features(
        df, "target_demand", "date", list(groups or []), True, True, True,
        fe.DEFAULT_LAGS, fe.DEFAULT_WINDOWS, fe.DEFAULT_STATS,
    )
    return out.where(F.col("date") >= CUT)


def _rows(df, cols):
    key = lambda r: tuple((v is not None, str(v)) for v in r)
    show = lambda v: round(v, 9) if isinstance(v, float) else v
    return sorted((tuple(show(v) for v in r) for r in df.select(*cols).collect()), key=key)


@pytest.mark.parametrize("groups", [fe.SERIES, None])
def test_appended_equals_recomputed(spark, groups):
    df = _panel(spark)
    old, new = df.where(F.col("date") < CUT), df.where(F.col("date") >= CUT)
    feats, state = appending.fit_features(old, group_cols=groups)
    expected = fe.create_features(old, group_cols=groups)
    assert feats.columns == expected.columns
    assert _rows(feats, feats.columns) == _rows(expected, feats.columns)

    once = state.transform(new)
    assert once.columns == expected.columns
    whole = _whole(df, groups)
    windows = [c for c in whole.columns if c not in df.columns]
    for c in windows:
        if c.startswith("lag_"):
            whole = whole.withColumn(c, F.coalesce(c, F.lit(0.0)))
        elif c.startswith("rolling_"):
            whole = whole.withColumn(c, F.coalesce(F.col(c).cast("double"), F.lit(state.fitted["medians"][c])))
    keys = ["date", "product_id", "store_id", *windows]
    assert _rows(once, keys) == _rows(whole, keys)

    # in two parts, by way of the store
    store = FeatureStore(spark, scratch_dir(spark, "state"))
    first, then = new.where(F.col("date") < MID), new.where(F.col("date") >= MID)
    state.advance(first).save(store, "panel", "v2")
    twice = state.transform(first).unionByName(appending.load_state(store, "panel").transform(then))
    assert _rows(twice, once.columns) == _rows(once, once.columns)


def test_state_is_short_and_fit_does_not_move(spark):
    df = _panel(spark)
    old, new = df.where(F.col("date") < CUT), df.where(F.col("date") >= CUT)
    _, state = appending.fit_features(old)
    assert max(r["count"] for r in state.tail.groupBy("product_id", "store_id").count().collect()) <= 30
    later = state.advance(new)
    assert later.fitted == state.fitted
    assert max(r["count"] for r in later.tail.groupBy("product_id", "store_id").count().collect()) <= 30
    # a series the state has never seen: no statistics, no look back
    row = state.transform(new).where("product_id = 2").orderBy("date").first()
    assert row["price_mean"] is None and row["lag_1"] == 0.0
    carried = {(r["product_id"], r["store_id"]): r["_carry"] for r in later.series.collect()}
    assert carried[(2, 1)] is not None


def test_late_rows_are_refused_and_empty_parts_are_fine(spark):
    df = _panel(spark)
    old = df.where(F.col("date") < CUT)
    _, state = appending.fit_features(old)
    with pytest.raises(ValueError, match="not later"):
        state.transform(df)
    assert state.transform(df.limit(0)).count() == 0
    _, blank = appending.fit_features(df.limit(0))
    assert blank.transform(old).count() == old.count()
    _, plain = appending.fit_features(old, include_price=False, include_lags=False)
    got = plain.transform(df.where(F.col("date") >= CUT))
    assert "price_mean" not in got.columns and "rolling_7_mean" in got.columns
