"""Catalogue: cleaning operators on the defect variants of the panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkcast.operators import clean
from sparkcast.plans.catalog import register
from sparkcast.plans.common import r, round_doubles
from sparkcast.plans.q_features import _sql_calendar_basic
from sparkcast.sources.tables import (
    DEMAND_SQL,
    NULLS_SQL,
    RAW_COLUMNS,
    RAW_DEFECTS_SQL,
    demand_view,
    raw_with_defects,
    read_table,
    with_nulls,
)

ALL = ", ".join(RAW_COLUMNS)


def _raw(spark, sf):
    return raw_with_defects(demand_view(spark, sf))


@register("u1_distinct_rows", f"SELECT DISTINCT * FROM ({RAW_DEFECTS_SQL})")
def u1_distinct_rows(spark, sf):
    return clean.remove_duplicates(_raw(spark, sf))


@register(
    "p1_drop_nulls",
    f"SELECT * FROM ({RAW_DEFECTS_SQL}) WHERE "
    + " AND ".join(f"{c} IS NOT NULL" for c in RAW_COLUMNS),
)
def p1_drop_nulls(spark, sf):
    return clean.drop_nulls(_raw(spark, sf))


FILL = {"price": 0.0, "economic_index": 100.0}


@register(
    "p2_fill_values",
    f"""SELECT date, product_id, category_id, store_id, historical_sales,
  COALESCE(price, 0.0) AS price, promotion_flag, holiday_flag,
  COALESCE(economic_index, 100.0) AS economic_index, target_demand
FROM ({RAW_DEFECTS_SQL})""",
)
def p2_fill_values(spark, sf):
    return clean.fill_values(_raw(spark, sf), FILL)


# orders with holes in one text and one numeric column
ORDERS_HOLES_SQL = """
SELECT o_orderkey, o_custkey,
       CASE WHEN o_totalprice < 50000 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_totalprice END AS o_totalprice,
       o_orderpriority
FROM orders
"""


def orders_with_holes(spark, sf):
    o = read_table(spark, sf, "orders")
    return o.select(
        "o_orderkey",
        "o_custkey",
        F.when(F.col("o_totalprice") < 50000, F.lit(None).cast("string"))
        .otherwise(F.col("o_orderstatus"))
        .alias("o_orderstatus"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None).cast("double"))
        .otherwise(F.col("o_totalprice"))
        .alias("o_totalprice"),
        "o_orderpriority",
    )


@register(
    "p3_fill_median_mode",
    f"""WITH o AS ({ORDERS_HOLES_SQL}),
med AS (SELECT quantile_cont(o_totalprice, 0.5) AS m FROM o),
md AS (SELECT o_orderstatus AS v FROM o WHERE o_orderstatus IS NOT NULL
       GROUP BY o_orderstatus ORDER BY count(*) DESC, o_orderstatus LIMIT 1)
SELECT o_orderkey, o_custkey,
  COALESCE(o_orderstatus, (SELECT v FROM md)) AS o_orderstatus,
  {r("COALESCE(o_totalprice, (SELECT m FROM med))")} AS o_totalprice,
  o_orderpriority
FROM o""",
)
def p3_fill_median_mode(spark, sf):
    return round_doubles(clean.fill_median_mode(orders_with_holes(spark, sf)))


ORDER = "ORDER BY date, product_id, store_id"


@register(
    "p4_ffill",
    f"""SELECT date, product_id, category_id, store_id, historical_sales,
  last_value(price IGNORE NULLS) OVER ({ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS price,
  promotion_flag, holiday_flag,
  last_value(economic_index IGNORE NULLS) OVER ({ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS economic_index,
  target_demand
FROM ({NULLS_SQL})""",
)
def p4_ffill(spark, sf):
    d = with_nulls(demand_view(spark, sf))
    return clean.forward_fill(d, ["price", "economic_index"])


@register(
    "p5_bfill",
    f"""SELECT date, product_id, category_id, store_id, historical_sales,
  first_value(price IGNORE NULLS) OVER ({ORDER} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS price,
  promotion_flag, holiday_flag,
  first_value(economic_index IGNORE NULLS) OVER ({ORDER} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS economic_index,
  target_demand
FROM ({NULLS_SQL})""",
)
def p5_bfill(spark, sf):
    d = with_nulls(demand_view(spark, sf))
    return clean.backward_fill(d, ["price", "economic_index"])


# raw text-ish input: string dates, fractional ids/counts (truncated on cast)
LOOSE_SQL = f"""
SELECT CAST(date AS VARCHAR) AS date,
       CAST(product_id AS DOUBLE) + 0.25 AS product_id,
       CAST(category_id AS DOUBLE) AS category_id,
       CAST(store_id AS DOUBLE) + 0.75 AS store_id,
       CAST(historical_sales AS DOUBLE) + 0.9 AS historical_sales,
       price, promotion_flag, holiday_flag, economic_index,
       CAST(target_demand AS DOUBLE) + 0.5 AS target_demand
FROM ({DEMAND_SQL})
"""


def loose_types(spark, sf):
    d = demand_view(spark, sf)
    return d.select(
        F.col("date").cast("string").alias("date"),
        (F.col("product_id").cast("double") + 0.25).alias("product_id"),
        F.col("category_id").cast("double").alias("category_id"),
        (F.col("store_id").cast("double") + 0.75).alias("store_id"),
        (F.col("historical_sales").cast("double") + 0.9).alias("historical_sales"),
        "price",
        "promotion_flag",
        "holiday_flag",
        "economic_index",
        (F.col("target_demand").cast("double") + 0.5).alias("target_demand"),
    )


def _trunc(c):
    return f"CAST(trunc({c}) AS BIGINT) AS {c}"


@register(
    "p7_cast_types",
    f"""SELECT CAST(date AS DATE) AS date, {_trunc("product_id")}, {_trunc("category_id")},
  {_trunc("store_id")}, {_trunc("historical_sales")}, CAST(price AS DOUBLE) AS price,
  CAST(promotion_flag AS BIGINT) AS promotion_flag, CAST(holiday_flag AS BIGINT) AS holiday_flag,
  CAST(economic_index AS DOUBLE) AS economic_index, {_trunc("target_demand")}
FROM ({LOOSE_SQL})""",
)
def p7_cast_types(spark, sf):
    return clean.convert_data_types(loose_types(spark, sf))


@register(
    "c1_transform",
    f"""SELECT *, {", ".join(_sql_calendar_basic())}
FROM (SELECT DISTINCT * FROM ({RAW_DEFECTS_SQL}))
WHERE {" AND ".join(f"{c} IS NOT NULL" for c in RAW_COLUMNS)}""",
)
def c1_transform(spark, sf):
    return clean.transform_data(_raw(spark, sf))


_HALVES = "SELECT event_id, CASE WHEN event_id % 10 < 8 THEN event_id % 2 END AS side FROM events"


@register(
    "p3_fractional_median",
    f"""SELECT event_id, COALESCE(side, (SELECT quantile_cont(side, 0.5) FROM ({_HALVES}))) AS side
FROM ({_HALVES})""",
)
def p3_fractional_median(spark, sf):
    """An integer column whose median is 0.5 is widened, not rounded."""
    side = F.when(F.col("event_id") % 10 < 8, F.col("event_id") % 2)
    return clean.fill_median_mode(read_table(spark, sf, "events").select("event_id", side.alias("side")))
