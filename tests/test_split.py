"""Splits lose no row: NULL keys, repeated keys and identical rows."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from sparkcast.operators import split as S
from sparkcast.sources.tables import KEY, raw_with_defects


@pytest.fixture(scope="module")
def defects(demand):
    d = raw_with_defects(demand)
    return d.withColumn("date", F.when(F.col("historical_sales") % 7 != 0, F.col("date"))).cache()


def _rows(df):
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("split", [S.temporal_split, S.random_split, S.exact_random_split])
def test_parts_add_up(defects, split):
    train, test = split(defects, 0.2)
    assert _rows(train) + _rows(test) == _rows(defects)


def test_sizes_and_order(defects):
    n = defects.count()
    for split in (S.temporal_split, S.exact_random_split):
        train, test = split(defects, 0.2)
        assert train.count() == S.train_size(n, 0.2)
    train, test = S.temporal_split(defects, 0.2)
    last = train.agg(F.max("date")).first()[0]
    assert test.where(F.col("date") < F.lit(last)).count() == 0
    assert train.where("date is null").count() == 0  # missing dates come last


@pytest.mark.parametrize("size", [0.0, 0.3, 0.5, 0.8, 1.0])
def test_cut_among_identical_rows(spark, size):
    rows = [(1, "x")] * 6 + [(0, "a"), (2, "b"), (None, "c"), (1, "y")]
    df = spark.createDataFrame(rows, "k int, v string").repartition(3)
    train, test = S.temporal_split(df, size, ["k"])
    assert train.count() == S.train_size(len(rows), size)
    assert _rows(train) + _rows(test) == Counter(rows)
    labels = S.label_split(df, size, ["k"]).groupBy("split").count().collect()
    assert sum(r["count"] for r in labels) == len(rows)


def test_folds_label_every_row(defects):
    folds = S.time_series_folds(defects, 5)
    assert folds.count() == defects.count()
    assert folds.where("date is null and val_fold is null").count() == 0
    assert folds.columns == [*defects.columns, "val_fold"]


def test_empty(demand):
    train, test = S.temporal_split(demand.where("false"), 0.2, KEY)
    assert train.count() == 0 and test.count() == 0
