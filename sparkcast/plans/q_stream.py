"""Catalogue: the row-local request path run as a Structured Streaming job."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkcast.plans.catalog import register
from sparkcast.plans.common import r, round_doubles
from sparkcast.plans.q_rules import _reasons_sql
from sparkcast.sources.tables import table_path
from sparkcast.streaming import scoring as S

SERVING_COLS = [
    "prediction_date",
    "product_id",
    "store_id",
    "l_orderkey",
    "l_linenumber",
    "price",
    "day_of_week",
    "day_of_month",
    "week_of_year",
    "is_month_end",
    "price_per_category",
    "sales_price_ratio",
    "store_category",
    "economic_sales",
    "sales_lag_7",
    "sales_rolling_std_30",
]


@register(
    "st1_stream_serving",
    f"""WITH q AS ({S.STREAM_REQUESTS_SQL}),
t AS (SELECT *, {_reasons_sql()} AS reasons FROM q)
SELECT prediction_date, product_id, store_id, l_orderkey, l_linenumber, {r("price")} AS price,
  CAST(isodow(prediction_date) - 1 AS BIGINT) AS day_of_week, CAST(day(prediction_date) AS BIGINT) AS day_of_month,
  CAST(weekofyear(prediction_date) AS BIGINT) AS week_of_year,
  CAST(CASE WHEN prediction_date = last_day(prediction_date) THEN 1 ELSE 0 END AS BIGINT) AS is_month_end,
  {r("price / greatest(category_id, 1)")} AS price_per_category,
  {r("historical_sales / (price + 1)")} AS sales_price_ratio,
  store_id * 100 + category_id AS store_category,
  {r("economic_index * historical_sales")} AS economic_sales,
  {r("historical_sales")} AS sales_lag_7, {r("0.0")} AS sales_rolling_std_30
FROM t WHERE reasons = ''""",
)
def st1_stream_serving(spark, sf):
    """V10 + F10 over a lineitem stream, run to completion (availableNow)."""
    lines = S.read_lineitem_stream(spark, S.stream_glob(table_path(sf, "lineitem")))
    out = S.serving_stream(S.requests_from_lineitem(lines)).select(*SERVING_COLS)
    return round_doubles(S.run_available_now(out, "serving"))


@register(
    "st2_stream_rejects",
    f"""WITH q AS ({S.STREAM_REQUESTS_SQL}),
t AS (SELECT *, {_reasons_sql()} AS reasons FROM q)
SELECT l_orderkey, l_linenumber, reasons FROM t WHERE reasons <> ''""",
)
def st2_stream_rejects(spark, sf):
    lines = S.read_lineitem_stream(spark, S.stream_glob(table_path(sf, "lineitem")))
    tagged = S.tag_requests(S.requests_from_lineitem(lines))
    out = tagged.where(F.size("reasons") > 0).select(
        "l_orderkey", "l_linenumber", F.array_join("reasons", "; ").alias("reasons")
    )
    return S.run_available_now(out, "rejects")
