"""Catalogue: sources and sinks (S1-S4), column operators (P8, P10), the
single interaction features (F6-F9), serving features (F10), row concat (U2),
top-n (T4) and validate-to-result (V8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkcast.functions.calendar import basic_calendar
from sparkcast.operators import clean
from sparkcast.operators import explore as X
from sparkcast.operators import features as fe
from sparkcast.operators import validate as V
from sparkcast.operators.profile import table_info
from sparkcast.plans.catalog import register
from sparkcast.plans.common import r, round_doubles
from sparkcast.plans.q_features import MINMAX, _sql_calendar_basic
from sparkcast.plans.q_rules import REQUESTS_SQL, _reasons_sql, _report_sql, requests_table
from sparkcast.session import scratch_dir
from sparkcast.sources import tables as T
from sparkcast.sources.tables import DEMAND_SQL, RAW_COLUMNS, demand_view

KEY_SEL = "date, product_id, store_id"


@register("s1_csv_roundtrip", f"SELECT * FROM ({DEMAND_SQL})")
def s1_csv_roundtrip(spark, sf):
    """Write the panel as header CSV, read it back with the declared raw schema."""
    path = scratch_dir(spark, "csv") + "/demand"
    demand_view(spark, sf).write.mode("overwrite").option("header", True).csv(path)
    return T.load_raw_csv(spark, path)


#: Lines with a word for a price, a broken date, or a cell too many.
_BAD_PRICE = "promotion_flag = 1 AND holiday_flag = 1"
_BAD_DATE = "product_id % 40 = 7"
_TOO_WIDE = "product_id % 40 = 9"


def _defective_csv(spark, sf):
    d = demand_view(spark, sf)
    cells = {c: F.col(c).cast("string") for c in RAW_COLUMNS}
    cells["price"] = F.when(F.expr(_BAD_PRICE), F.lit("n/a")).otherwise(cells["price"])
    cells["date"] = F.when(F.expr(_BAD_DATE), F.lit("2024-13-45")).otherwise(cells["date"])
    line = F.concat_ws(",", *cells.values())
    lines = d.select(F.when(F.expr(_TOO_WIDE), F.concat(line, F.lit(",x"))).otherwise(line).alias("value"))
    path = scratch_dir(spark, "csv-defects") + "/demand"
    head = ",".join(RAW_COLUMNS)
    # one header a file, as the reader expects it
    lines.toDF(head).write.mode("overwrite").option("header", True).option("quote", "\u0000").option(
        "sep", "\u0001"
    ).csv(path)
    return path


@register(
    "s1_csv_accepted",
    f"SELECT * FROM ({DEMAND_SQL}) WHERE NOT ({_BAD_PRICE} OR {_BAD_DATE} OR {_TOO_WIDE})",
)
def s1_csv_accepted(spark, sf):
    """What a CSV with bad lines keeps."""
    return T.load_csv_with_rejects(spark, _defective_csv(spark, sf))[0]


@register("s1_csv_rejected", f"""
WITH b AS (SELECT {_BAD_PRICE} AS p, {_BAD_DATE} AS d, {_TOO_WIDE} AS w FROM ({DEMAND_SQL}))
SELECT CASE WHEN p OR d THEN 'cells' ELSE 'width' END AS reason,
       concat_ws(';', CASE WHEN d THEN 'date=2024-13-45:date' END, CASE WHEN p THEN 'price=n/a:double' END) AS cells,
       count(*) AS lines, true AS in_a_file
FROM b WHERE p OR d OR w GROUP BY 1, 2""")
def s1_csv_rejected(spark, sf):
    """The quarantined lines by reason and bad cells."""
    rejected = T.load_csv_with_rejects(spark, _defective_csv(spark, sf))[1]
    cell = F.transform(
        "bad_cells", lambda c: F.concat(c["column"], F.lit("="), c["value"], F.lit(":"), c["expected"])
    )
    return rejected.groupBy("reason", F.array_join(cell, ";").alias("cells")).agg(
        F.count(F.lit(1)).alias("lines"), F.bool_and(F.col("file").endswith(".csv")).alias("in_a_file")
    )


@register("p7_rejected", f"""
SELECT date, product_id, store_id, 'price' AS column_name, 'free' AS value, 'double' AS expected
FROM ({DEMAND_SQL}) WHERE {_BAD_PRICE}
UNION ALL
SELECT date, product_id, store_id, 'promotion_flag', 'yes', 'bigint' FROM ({DEMAND_SQL}) WHERE {_BAD_DATE}""")
def p7_rejected(spark, sf):
    """Cells that do not convert, each with its row's key."""
    d = demand_view(spark, sf)
    text = d.withColumns(
        {
            "price": F.when(F.expr(_BAD_PRICE), F.lit("free")).otherwise(F.col("price").cast("string")),
            "promotion_flag": F.when(F.expr(_BAD_DATE), F.lit("yes")).otherwise(
                F.col("promotion_flag").cast("string")
            ),
        }
    )
    rejected = clean.convert_with_rejects(text)[1]
    cell = F.explode("bad_cells").alias("c")
    return rejected.select("date", "product_id", "store_id", cell).select(
        "date", "product_id", "store_id", F.col("c.column").alias("column_name"), "c.value", "c.expected"
    )


@register("s3_parquet_roundtrip", f"SELECT *, {', '.join(_sql_calendar_basic())} FROM ({DEMAND_SQL})")
def s3_parquet_roundtrip(spark, sf):
    """C1 output to snappy Parquet (partitioned by year) and back (S2 + S3)."""
    path = scratch_dir(spark, "parquet") + "/processed"
    T.save_parquet(clean.transform_data(demand_view(spark, sf)), path, partition_by=["year"])
    back = T.load_parquet(spark, path)
    return back.select(*RAW_COLUMNS, *basic_calendar().keys())


@register("s4_json_report", _report_sql(DEMAND_SQL))
def s4_json_report(spark, sf):
    """The validation report written as JSON lines and read back with its schema."""
    path = scratch_dir(spark, "json") + "/report"
    report = V.validation_report(demand_view(spark, sf))
    T.save_report_json(report, path)
    return round_doubles(spark.read.schema(report.schema).json(path))


@register(
    "p8_feature_columns",
    f"""SELECT historical_sales, price, promotion_flag, holiday_flag, economic_index,
  CAST(month(date) AS BIGINT) AS month, CAST(day(date) AS BIGINT) AS day,
  CAST(isodow(date) - 1 AS BIGINT) AS day_of_week,
  CAST(CASE WHEN isodow(date) - 1 >= 5 THEN 1 ELSE 0 END AS BIGINT) AS is_weekend,
  CAST(weekofyear(date) AS BIGINT) AS week_of_year, CAST(quarter(date) AS BIGINT) AS quarter
FROM ({DEMAND_SQL})""",
)
def p8_feature_columns(spark, sf):
    """The model inputs of the cleaned table: all but date, target, ids, year."""
    df = clean.transform_data(demand_view(spark, sf), sort=False)
    return df.select(*fe.get_feature_names(df))


ALIGN_TO = ["product_id", "store_id", "price", "lag_1", "day_of_week", "day", "promo_weekend"]


@register(
    "p10_align_columns",
    f"""SELECT product_id - 1000 AS product_id, store_id, price, 0 AS lag_1,
  CAST(isodow(date) - 1 AS BIGINT) AS day_of_week, 0 AS day, 0 AS promo_weekend
FROM ({T.NULLS_SQL}) WHERE price IS NOT NULL AND economic_index IS NOT NULL
  AND product_id - 1000 >= 1""",
)
def p10_align_columns(spark, sf):
    """Serving features of valid requests aligned to a training column list:
    names the requests lack (lag_1, day, promo_weekend) become 0."""
    valid, _ = V.split_requests(requests_table(spark, sf).dropDuplicates())
    return fe.align_columns(fe.serving_features(valid), ALIGN_TO).withColumn(
        "lag_1", F.col("lag_1").cast("int")
    ).withColumn("day", F.col("day").cast("int")).withColumn("promo_weekend", F.col("promo_weekend").cast("int"))


def _interaction(spark, sf, col):
    d = demand_view(spark, sf).withColumn("is_weekend", basic_calendar()["is_weekend"])
    return round_doubles(fe.create_interaction_features(d).select("date", "product_id", "store_id", col))


@register(
    "f6_promo",
    f"""SELECT {KEY_SEL}, promotion_flag * (CASE WHEN isodow(date) - 1 >= 5 THEN 1 ELSE 0 END) AS promo_weekend,
  promotion_flag * holiday_flag AS promo_holiday FROM ({DEMAND_SQL})""",
)
def f6_promo(spark, sf):
    d = demand_view(spark, sf).withColumn("is_weekend", basic_calendar()["is_weekend"])
    return fe.create_interaction_features(d).select("date", "product_id", "store_id", "promo_weekend", "promo_holiday")


@register(
    "f7_discount",
    f"""WITH demand AS ({DEMAND_SQL}), mm AS {MINMAX}
SELECT {KEY_SEL}, {r("promotion_flag * (1 - (price - pmin) / (pmax - pmin))")} AS promo_discount_effect FROM demand, mm""",
)
def f7_discount(spark, sf):
    return _interaction(spark, sf, "promo_discount_effect")


@register(
    "f8_price_economy",
    f"""WITH demand AS ({DEMAND_SQL}), mm AS {MINMAX}
SELECT {KEY_SEL}, {r("((price - pmin) / (pmax - pmin)) / ((economic_index - emin) / (emax - emin) + 0.01)")} AS price_economy_ratio
FROM demand, mm""",
)
def f8_price_economy(spark, sf):
    return _interaction(spark, sf, "price_economy_ratio")


@register(
    "f9_demand_ratio",
    f"SELECT {KEY_SEL}, {r('target_demand / (historical_sales + 1)')} AS demand_vs_historical FROM ({DEMAND_SQL})",
)
def f9_demand_ratio(spark, sf):
    return _interaction(spark, sf, "demand_vs_historical")


def _serving_sql() -> str:
    lags = ", ".join(f"{r('historical_sales')} AS sales_lag_{k}" for k in fe.SERVING_LAGS)
    rolls = ", ".join(
        f"{r('historical_sales')} AS sales_rolling_mean_{w}, {r('0.0')} AS sales_rolling_std_{w}, "
        f"{r('historical_sales')} AS sales_rolling_min_{w}, {r('historical_sales')} AS sales_rolling_max_{w}"
        for w in fe.SERVING_WINDOWS
    )
    return f"""WITH q AS ({REQUESTS_SQL}), t AS (SELECT *, {_reasons_sql()} AS reasons FROM q)
SELECT prediction_date, product_id, category_id, store_id, {r("historical_sales")} AS historical_sales,
  {r("price")} AS price, promotion_flag, holiday_flag, {r("economic_index")} AS economic_index,
  CAST(isodow(prediction_date) - 1 AS BIGINT) AS day_of_week, CAST(day(prediction_date) AS BIGINT) AS day_of_month,
  CAST(month(prediction_date) AS BIGINT) AS month, CAST(quarter(prediction_date) AS BIGINT) AS quarter,
  CAST(year(prediction_date) AS BIGINT) AS year, CAST(weekofyear(prediction_date) AS BIGINT) AS week_of_year,
  CAST(CASE WHEN isodow(prediction_date) - 1 >= 5 THEN 1 ELSE 0 END AS BIGINT) AS is_weekend,
  CAST(CASE WHEN day(prediction_date) = 1 THEN 1 ELSE 0 END AS BIGINT) AS is_month_start,
  CAST(CASE WHEN prediction_date = last_day(prediction_date) THEN 1 ELSE 0 END AS BIGINT) AS is_month_end,
  {r("price / greatest(category_id, 1)")} AS price_per_category, {r("price * promotion_flag")} AS price_times_promo,
  {r("historical_sales / (price + 1)")} AS sales_price_ratio, promotion_flag * holiday_flag AS promo_holiday,
  store_id * 100 + category_id AS store_category, {r("economic_index * historical_sales")} AS economic_sales,
  {lags}, {rolls}
FROM t WHERE reasons = ''"""


@register("f10_serving", _serving_sql())
def f10_serving(spark, sf):
    valid, _ = V.split_requests(requests_table(spark, sf))
    return round_doubles(fe.serving_features(valid))


@register(
    "u2_concat",
    f"""SELECT * FROM ({REQUESTS_SQL}) WHERE promotion_flag = 1
UNION ALL SELECT * FROM ({REQUESTS_SQL}) WHERE promotion_flag = 0""",
)
def u2_concat(spark, sf):
    """Two request batches stacked by column name."""
    req = requests_table(spark, sf)
    a = req.where(F.col("promotion_flag") == 1)
    b = req.where(F.col("promotion_flag") == 0).select(*reversed(req.columns))
    return a.unionByName(b)


@register(
    "t4_top_values",
    f"SELECT * FROM ({DEMAND_SQL}) ORDER BY target_demand DESC, date, product_id, category_id, store_id, "
    "historical_sales, price, promotion_flag, holiday_flag, economic_index LIMIT 20",
)
def t4_top_values(spark, sf):
    """T4 over data: the 20 largest rows by target (a top-k, not a sort)."""
    return X.top_n(demand_view(spark, sf), "target_demand", 20)


def _v8_sql() -> str:
    from sparkcast.plans.q_rules import NOT_NULL, RANGES, SETS, UNIQUE_SQL, _union

    viol = f"SELECT * FROM ({_union(NOT_NULL + RANGES + SETS, T.RAW_DEFECTS_SQL)}) UNION ALL SELECT * FROM ({UNIQUE_SQL})"
    return f"""WITH v AS ({viol})
SELECT 'raw' AS schema, count(*) FILTER (WHERE violations > 0) = 0 AS ok,
  COALESCE(string_agg(rule || '(' || "column" || '): ' || CAST(violations AS VARCHAR), '; '
           ORDER BY rule, "column") FILTER (WHERE violations > 0), 'Validation passed') AS message
FROM v
UNION ALL SELECT 'processed', true, 'Validation passed'"""


@register("v8_validate_result", _v8_sql())
def v8_validate_result(spark, sf):
    """(ok, message) for the raw and processed schemas on the defect table."""
    d = T.raw_with_defects(demand_view(spark, sf))
    ok_raw, msg_raw = V.validate_to_result(d, "raw")
    ok_proc, msg_proc = V.validate_to_result(clean.transform_data(d, add_features=False), "processed")
    return spark.createDataFrame(
        [("raw", ok_raw, msg_raw), ("processed", ok_proc, msg_proc)], "schema string, ok boolean, message string"
    )


@register(
    "s2_nan_is_missing",
    """SELECT 'value' AS column, CAST(count(*) AS BIGINT) AS rows,
  CAST(count(*) FILTER (event_id % 7 = 0 OR value IS NULL) AS BIGINT) AS missing FROM events""",
)
def s2_nan_is_missing(spark, sf):
    """NaN written to Parquet comes back as NULL."""
    gaps = F.when(F.col("event_id") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    path = scratch_dir(spark, "nan")
    T.save_parquet(T.read_table(spark, sf, "events").select(gaps.alias("value")), path)
    return table_info(T.load_parquet(spark, path)).select("column", "rows", "missing")
