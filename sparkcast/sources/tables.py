"""Table sources and sinks (S1-S6) and the ``demand`` panel view.

The daily panel has key (date, product_id, store_id) and target
``target_demand``. The driver tables hold no such table, so ``demand_view``
derives one from ``lineitem`` with one partial+final aggregate: the scan only
reads the five lineitem columns it needs and the map-side partial aggregate
shrinks the data before the only shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY = ["date", "product_id", "store_id"]
TARGET = "target_demand"

RAW_COLUMNS = [
    "date",
    "product_id",
    "category_id",
    "store_id",
    "historical_sales",
    "price",
    "promotion_flag",
    "holiday_flag",
    "economic_index",
    "target_demand",
]
INT_COLUMNS = [
    "product_id",
    "category_id",
    "store_id",
    "historical_sales",
    "promotion_flag",
    "holiday_flag",
    "target_demand",
]
FLOAT_COLUMNS = ["price", "economic_index"]

RAW_SCHEMA = T.StructType(
    [T.StructField("date", T.DateType(), True)]
    + [
        T.StructField(c, T.LongType() if c in INT_COLUMNS else T.DoubleType(), True)
        for c in RAW_COLUMNS[1:]
    ]
)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables (column pruning happens at the scan)."""
    return spark.read.parquet(table_path(sf_dir, name))


def demand_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Daily panel derived from lineitem; same text as ``DEMAND_SQL``."""
    ship = F.col("l_shipdate")
    return lineitem.groupBy(
        F.to_date(ship).alias("date"),
        (F.lit(1000) + F.col("l_partkey") % 100).alias("product_id"),
        (F.lit(1) + F.col("l_partkey") % 5).alias("category_id"),
        (F.lit(1) + F.col("l_suppkey") % 10).alias("store_id"),
    ).agg(
        (F.sum("l_linenumber") * 10).cast("bigint").alias("historical_sales"),
        # cents cut with floor: ROUND on doubles breaks ties differently
        # across engines (decimal text vs binary value), floor does not; a
        # zero quantity gives a NULL unit price (skipped by MIN), not an error
        F.min(
            F.floor(F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")) / 20 * 100) / 100
        ).alias("price"),
        F.max(F.when(F.col("l_discount") >= 0.05, 1).otherwise(0)).cast("bigint").alias(
            "promotion_flag"
        ),
        F.max(
            F.when((F.month(ship) == 12) & (F.dayofmonth(ship) >= 20), 1).otherwise(0)
        ).cast("bigint").alias("holiday_flag"),
        (F.lit(100) + F.max("l_tax") * 100).alias("economic_index"),
        F.sum("l_quantity").cast("bigint").alias("target_demand"),
    )


def demand_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demand_from_lineitem(read_table(spark, sf_dir, "lineitem"))


# The same view for DuckDB (oracle side); kept textually next to the
# DataFrame form above so the two cannot drift apart unnoticed.
DEMAND_SQL = """
SELECT CAST(l_shipdate AS DATE) AS date,
       1000 + l_partkey % 100 AS product_id,
       1 + l_partkey % 5 AS category_id,
       1 + l_suppkey % 10 AS store_id,
       CAST(SUM(l_linenumber) * 10 AS BIGINT) AS historical_sales,
       MIN(FLOOR(l_extendedprice / l_quantity / 20 * 100) / 100) AS price,
       CAST(MAX(CASE WHEN l_discount >= 0.05 THEN 1 ELSE 0 END) AS BIGINT) AS promotion_flag,
       CAST(MAX(CASE WHEN MONTH(l_shipdate) = 12 AND DAY(l_shipdate) >= 20
                THEN 1 ELSE 0 END) AS BIGINT) AS holiday_flag,
       100 + MAX(l_tax) * 100 AS economic_index,
       CAST(SUM(l_quantity) AS BIGINT) AS target_demand
FROM lineitem GROUP BY 1, 2, 3, 4
"""


def with_nulls(demand: DataFrame) -> DataFrame:
    """The panel with NULLs where the cleaning operators need them.

    ``price`` is NULL where target_demand < 3 and ``economic_index`` where
    historical_sales < 20 (same rules as ``NULLS_SQL``). Key stays unique.
    """
    return demand.select(
        "date",
        "product_id",
        "category_id",
        "store_id",
        "historical_sales",
        F.when(F.col("target_demand") < 3, F.lit(None).cast("double"))
        .otherwise(F.col("price"))
        .alias("price"),
        "promotion_flag",
        "holiday_flag",
        F.when(F.col("historical_sales") < 20, F.lit(None).cast("double"))
        .otherwise(F.col("economic_index"))
        .alias("economic_index"),
        "target_demand",
    )


def raw_with_defects(demand: DataFrame) -> DataFrame:
    """``with_nulls`` plus exact duplicates of the rows with both flags set."""
    base = with_nulls(demand)
    dup = base.where((F.col("promotion_flag") == 1) & (F.col("holiday_flag") == 1))
    return base.unionByName(dup)


NULLS_SQL = f"""
SELECT date, product_id, category_id, store_id, historical_sales,
       CASE WHEN target_demand < 3 THEN NULL ELSE price END AS price,
       promotion_flag, holiday_flag,
       CASE WHEN historical_sales < 20 THEN NULL ELSE economic_index END AS economic_index,
       target_demand
FROM ({DEMAND_SQL})
"""

RAW_DEFECTS_SQL = f"""
WITH b AS ({NULLS_SQL})
SELECT * FROM b
UNION ALL
SELECT * FROM b WHERE promotion_flag = 1 AND holiday_flag = 1
"""


# --------------------------------------------------------------------------
# File sources and sinks
# --------------------------------------------------------------------------


def _path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def load_raw_csv(spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """Header CSV with a declared schema; malformed rows fail the job."""
    if not _path_exists(spark, path):
        raise FileNotFoundError(path)
    return nan_to_null(
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("dateFormat", "yyyy-MM-dd")
        .csv(path)
    )


def load_csv_with_rejects(
    spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA
) -> tuple[DataFrame, DataFrame]:
    """S1 with quarantine: (accepted rows, rejected lines).

    The header names the schema's columns in order; a line that is no header
    and has a cell that is not of its declared type, or another number of
    cells, is rejected whole: ``line``, ``file``, ``reason`` (``cells`` or
    ``width``) and ``bad_cells`` (column, value, expected type). Accepted and
    rejected lines together are the input; nothing is dropped.
    """
    if not _path_exists(spark, path):
        raise FileNotFoundError(path)
    corrupt = "_corrupt_line"
    declared = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    header = ",".join(schema.names)
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file"))
    lines = lines.where((F.trim("value") != "") & (F.replace("value", F.lit('"'), F.lit("")) != header))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt, "dateFormat": "yyyy-MM-dd"}
    read = lines.withColumn("_row", F.from_csv("value", F.lit(declared.toDDL()), options))
    accepted = nan_to_null(read.where(F.col("_row")[corrupt].isNull()).select("_row.*").drop(corrupt))
    texts = ", ".join(f"`{f.name}` string" for f in schema.fields)
    held = read.where(F.col("_row")[corrupt].isNotNull()).select(
        F.col("value").alias("line"), "_file", F.from_csv("value", F.lit(texts)).alias("_c")
    )
    bad = []
    for f in schema.fields:
        value = F.col("_c")[f.name]
        fits = (
            F.try_to_date(value, "yyyy-MM-dd")
            if isinstance(f.dataType, T.DateType)
            else value.try_cast(f.dataType)
        )
        entry = F.struct(
            F.lit(f.name).alias("column"),
            value.alias("value"),
            F.lit(f.dataType.simpleString()).alias("expected"),
        )
        bad.append(F.when(value.isNotNull() & fits.isNull(), entry))
    rejected = held.withColumn("bad_cells", F.array_compact(F.array(*bad)))
    return accepted, rejected.select(
        "line",
        F.col("_file").alias("file"),
        F.when(F.size("bad_cells") > 0, "cells").otherwise("width").alias("reason"),
        "bad_cells",
    )


def load_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Processed Parquet; a missing path raises FileNotFoundError."""
    if not _path_exists(spark, path):
        raise FileNotFoundError(path)
    return nan_to_null(spark.read.parquet(path))


def save_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """S3: snappy Parquet, overwrite. Parent folders are created by the writer."""
    w = df.write.mode("overwrite").option("compression", "snappy")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def save_report_json(report: DataFrame, path: str) -> str:
    """A long-form report table as JSON lines."""
    report.write.mode("overwrite").json(path)
    return path


def save_metrics_json(metrics: DataFrame, folder: str, name: str, timestamp: str) -> str:
    """Metrics as JSON in ``<folder>/<name>_<timestamp>.json``."""
    return save_report_json(metrics, f"{folder.rstrip('/')}/{name}_{timestamp}.json")


@dataclass(frozen=True)
class DataPaths:
    """Where the pipeline's tables live, below one root."""

    root: str
    raw: str = "data/raw/demand.csv"
    processed: str = "data/processed/demand.parquet"
    features: str = "data/features"
    models: str = "models"
    reports: str = "reports"

    def of(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{getattr(self, name)}"


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL once, at the source, for every floating column."""
    cols: list[Column] = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.col(f.name)
            cols.append(F.when(F.isnan(c), F.lit(None)).otherwise(c).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
