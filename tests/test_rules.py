"""Validation rules: violations are counted, validation raises for real (Q1)."""

import pytest
from pyspark.sql import functions as F

from sparkcast.operators import validate as V
from sparkcast.sources.tables import raw_with_defects


def test_violation_table_counts(demand):
    raw = raw_with_defects(demand)
    table = {(r.rule, r.column): r.violations for r in V.violations(raw, "raw").collect()}
    assert table[("not_null", "price")] == raw.where(F.col("price").isNull()).count()
    assert table[("greater_than", "price")] == raw.where(F.col("price") > 100).count()
    dups = raw.count() - raw.dropDuplicates(["date", "product_id", "store_id"]).count()
    assert table[("unique_key", "date,product_id,store_id")] == dups


def test_validate_raises_and_passes(demand):
    raw = raw_with_defects(demand)
    with pytest.raises(V.ValidationError):
        V.validate_data(raw, "raw")
    ok, msg = V.validate_to_result(demand, "processed")
    assert ok, msg


def test_strict_columns(demand):
    assert V.strict_columns(demand.withColumn("extra", F.lit(1))) == ["unexpected column extra"]
    assert V.strict_columns(demand.drop("price"))[0] == "missing column price"


def test_coercion_failures(spark):
    df = spark.createDataFrame([("1.5",), ("oops",), (None,)], "price string")
    (r,) = V.rule_violations(df, V.coercion_rules(df)).collect()
    assert r.violations == 1


def test_request_rules(spark):
    df = spark.createDataFrame(
        [("2024-01-15", 1, 1, 1, 150.5, 29.99, 1, 0, 102.5), ("2024-01-15", 1, 1, 1, 150.5, -10.0, 1, 0, 102.5)],
        "prediction_date string, product_id long, category_id long, store_id long, historical_sales double, "
        "price double, promotion_flag long, holiday_flag long, economic_index double",
    )
    valid, rejected = V.split_requests(df)
    assert valid.count() == 1
    assert rejected.first().reasons == ["price must be > 0"]
