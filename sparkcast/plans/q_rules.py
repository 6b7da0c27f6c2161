"""Catalogue: validation rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkcast.operators import validate as V
from sparkcast.plans.catalog import register
from sparkcast.plans.common import r, round_doubles
from sparkcast.sources.tables import (
    DEMAND_SQL,
    RAW_COLUMNS,
    RAW_DEFECTS_SQL,
    demand_view,
    raw_with_defects,
)


def _raw(spark, sf):
    return raw_with_defects(demand_view(spark, sf))


def _union(parts: list[tuple[str, str, str]], src: str) -> str:
    """(rule, column, violation predicate) -> one aggregate, unpivoted."""
    aggs = ", ".join(
        f"CAST(count(*) FILTER (WHERE {pred}) AS BIGINT) AS r{i}" for i, (_, _, pred) in enumerate(parts)
    )
    rows = " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, '{col}' AS column, r{i} AS violations FROM a"
        for i, (rule, col, _) in enumerate(parts)
    )
    return f"WITH a AS (SELECT {aggs} FROM ({src})) {rows}"


NOT_NULL = [("not_null", c, f"{c} IS NULL") for c in RAW_COLUMNS]


def _range_pred(c, lo, hi, lo_open):
    parts = []
    if lo is not None:
        parts.append(f"{c} <= {lo}" if lo_open else f"{c} < {lo}")
    if hi is not None:
        parts.append(f"{c} > {hi}")
    return f"{c} IS NOT NULL AND ({' OR '.join(parts)})"


RANGES = [
    ("greater_than" if lo_open else "in_range", c, _range_pred(c, lo, hi, lo_open))
    for c, lo, hi, lo_open in V.RANGE_RULES
]
SETS = [
    ("isin", c, f"{c} IS NOT NULL AND {c} NOT IN ({', '.join(map(str, vals))})")
    for c, vals in V.ALLOWED_SETS
]
UNIQUE_SQL = f"""
SELECT 'unique_key' AS rule, 'date,product_id,store_id' AS column,
       CAST(COALESCE(SUM(CASE WHEN n > 1 THEN n - 1 END), 0) AS BIGINT) AS violations
FROM (SELECT count(*) AS n FROM ({RAW_DEFECTS_SQL}) GROUP BY date, product_id, store_id)
"""


@register("v1_not_null", _union(NOT_NULL, RAW_DEFECTS_SQL))
def v1_not_null(spark, sf):
    return V.rule_violations(_raw(spark, sf), V.not_null_rules())


@register("v2_ranges", _union(RANGES, RAW_DEFECTS_SQL))
def v2_ranges(spark, sf):
    return V.rule_violations(_raw(spark, sf), V.range_rules())


@register("v3_allowed_sets", _union(SETS, RAW_DEFECTS_SQL))
def v3_allowed_sets(spark, sf):
    return V.rule_violations(_raw(spark, sf), V.allowed_set_rules())


@register("v4_unique_key", UNIQUE_SQL)
def v4_unique_key(spark, sf):
    return V.duplicate_key_rows(_raw(spark, sf))


# text input where some values do not parse
TEXT_SQL = f"""
SELECT CASE WHEN holiday_flag = 1 THEN 'not-a-date' ELSE CAST(date AS VARCHAR) END AS date,
       product_id, category_id, store_id, historical_sales,
       CASE WHEN target_demand < 3 THEN 'n/a' ELSE CAST(price AS VARCHAR) END AS price,
       promotion_flag, holiday_flag, economic_index, target_demand
FROM ({DEMAND_SQL})
"""


def _text_input(spark, sf):
    d = demand_view(spark, sf)
    return d.select(
        F.when(F.col("holiday_flag") == 1, F.lit("not-a-date"))
        .otherwise(F.col("date").cast("string"))
        .alias("date"),
        "product_id",
        "category_id",
        "store_id",
        "historical_sales",
        F.when(F.col("target_demand") < 3, F.lit("n/a"))
        .otherwise(F.col("price").cast("string"))
        .alias("price"),
        "promotion_flag",
        "holiday_flag",
        "economic_index",
        "target_demand",
    )


COERCE = [
    ("coerce", "date", "date IS NOT NULL AND TRY_CAST(date AS DATE) IS NULL"),
    ("coerce", "price", "price IS NOT NULL AND TRY_CAST(price AS DOUBLE) IS NULL"),
]


@register("v6_coercion", _union(COERCE, TEXT_SQL))
def v6_coercion(spark, sf):
    return V.rule_violations(_text_input(spark, sf), V.coercion_rules(_text_input(spark, sf)))


@register(
    "v7_validate",
    f"SELECT * FROM ({_union(NOT_NULL + RANGES + SETS, RAW_DEFECTS_SQL)}) UNION ALL SELECT * FROM ({UNIQUE_SQL})",
)
def v7_validate(spark, sf):
    """The full violation table ``validate_data`` raises on."""
    return V.violations(_raw(spark, sf), "raw")


def _report_sql(src: str = RAW_DEFECTS_SQL) -> str:
    dtypes = {
        "date": "date",
        "price": "double",
        "economic_index": "double",
    }
    rows = []
    for c in RAW_COLUMNS:
        num = c != "date"
        dt = dtypes.get(c, "bigint")
        rows.append(
            f"""SELECT '{c}' AS column, '{dt}' AS dtype,
  CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS null_count,
  {r(f"round(count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*), 2)")} AS null_percentage,
  CAST(count(DISTINCT {c}) AS BIGINT) AS unique_count,
  {r(f"min({c})") if num else "CAST(NULL AS DOUBLE)"} AS min,
  {r(f"max({c})") if num else "CAST(NULL AS DOUBLE)"} AS max,
  {r(f"avg({c})") if num else "CAST(NULL AS DOUBLE)"} AS mean,
  {r(f"stddev_samp({c})") if num else "CAST(NULL AS DOUBLE)"} AS std
FROM ({src})"""
        )
    return " UNION ALL ".join(rows)


@register("v9_report", _report_sql())
def v9_report(spark, sf):
    return round_doubles(V.validation_report(_raw(spark, sf)))


# scoring requests derived from the panel: product ids shifted to 0..99
# (0 is invalid), NULL prices from the defect rules
REQUESTS_SQL = f"""
SELECT date AS prediction_date, product_id - 1000 AS product_id, category_id, store_id,
       CAST(historical_sales AS DOUBLE) AS historical_sales, price,
       promotion_flag, holiday_flag, economic_index
FROM ({RAW_DEFECTS_SQL})
"""


def requests_table(spark, sf):
    d = _raw(spark, sf)
    return d.select(
        F.col("date").alias("prediction_date"),
        (F.col("product_id") - 1000).alias("product_id"),
        "category_id",
        "store_id",
        F.col("historical_sales").cast("double").alias("historical_sales"),
        "price",
        "promotion_flag",
        "holiday_flag",
        "economic_index",
    )


def _reasons_sql() -> str:
    preds = [(f"{c} is required", f"{c} IS NULL") for c in V.REQUEST_FIELDS] + [
        ("product_id must be >= 1", "product_id < 1"),
        ("category_id must be >= 1", "category_id < 1"),
        ("store_id must be >= 1", "store_id < 1"),
        ("historical_sales must be >= 0", "historical_sales < 0"),
        ("price must be > 0", "price <= 0"),
        ("promotion_flag must be 0 or 1", "NOT (promotion_flag BETWEEN 0 AND 1)"),
        ("holiday_flag must be 0 or 1", "NOT (holiday_flag BETWEEN 0 AND 1)"),
    ]
    parts = ", ".join(f"CASE WHEN COALESCE({p}, false) THEN '{t}' END" for t, p in preds)
    return f"concat_ws('; ', {parts})"


@register(
    "v10_request_rules",
    f"""SELECT prediction_date, product_id, store_id, price, reasons FROM (
  SELECT *, {_reasons_sql()} AS reasons FROM ({REQUESTS_SQL})) WHERE reasons <> ''""",
)
def v10_request_rules(spark, sf):
    """The rejected requests with their reasons (the valid ones go on to scoring)."""
    _, rejected = V.split_requests(requests_table(spark, sf))
    return rejected.select(
        "prediction_date",
        "product_id",
        "store_id",
        "price",
        F.array_join("reasons", "; ").alias("reasons"),
    )
