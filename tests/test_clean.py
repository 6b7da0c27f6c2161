"""Cleaning operators (reference: transformation tests) on the sf0.001 panel."""

import pytest
from pyspark.sql import functions as F

from sparkcast.operators import clean
from sparkcast.sources.tables import KEY, raw_with_defects, with_nulls


def test_remove_duplicates_restores_count(demand):
    n = demand.count()
    doubled = demand.unionByName(demand.limit(5))
    assert clean.remove_duplicates(doubled).count() == n


def test_drop_nulls_leaves_none(demand):
    out = clean.drop_nulls(with_nulls(demand))
    assert out.where(F.col("price").isNull() | F.col("economic_index").isNull()).count() == 0
    assert out.count() > 0


def test_fill_median_mode_matches_pandas(spark):
    import pandas as pd

    pdf = pd.DataFrame(
        {
            "x": [1.0, None, 3.0, 10.0, None, 4.0],
            "s": ["a", "b", None, "b", "a", None],
            "k": [1, 2, 3, 4, 5, 6],
        }
    )
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "x double, s string, k long")
    out = clean.fill_median_mode(df).toPandas().sort_values("k")
    assert out["x"].tolist() == [1.0, 3.5, 3.0, 10.0, 3.5, 4.0]  # median of 1,3,10,4
    # mode tie between 'a' and 'b' -> smallest
    assert out["s"].tolist() == ["a", "b", "a", "b", "a", "a"]


def test_ffill_bfill_chunked_equal_pandas(demand):
    nulls = with_nulls(demand)
    ff = clean.forward_fill(nulls, ["price", "economic_index"], chunk_rows=97).toPandas()
    bf = clean.backward_fill(nulls, ["price", "economic_index"], chunk_rows=97).toPandas()
    ref = nulls.toPandas().sort_values(KEY).reset_index(drop=True)
    for got, method in ((ff, "ffill"), (bf, "bfill")):
        got = got.sort_values(KEY).reset_index(drop=True)
        exp = getattr(ref[["price", "economic_index"]], method)()
        assert got["price"].fillna(-1).tolist() == exp["price"].fillna(-1).tolist()
        assert got["economic_index"].fillna(-1).tolist() == exp["economic_index"].fillna(-1).tolist()


def test_unknown_strategy_raises(demand):
    with pytest.raises(ValueError):
        clean.handle_missing_values(demand, "median")


def test_string_dates_convert(demand):
    s = demand.withColumn("date", F.col("date").cast("string"))
    out = clean.convert_data_types(s)
    assert dict(out.dtypes)["date"] == "date"
    assert out.count() == demand.count()


def test_cast_truncates_toward_zero(spark):
    df = spark.createDataFrame([(2.9, -2.9)], "target_demand double, historical_sales double")
    row = clean.convert_data_types(df).first()
    assert (row.target_demand, row.historical_sales) == (2, -2)


def test_transform_data(demand):
    raw = raw_with_defects(demand)
    out = clean.transform_data(raw)
    assert "is_weekend" in out.columns and "week_of_year" in out.columns
    assert out.count() == clean.drop_nulls(clean.remove_duplicates(raw)).count()
