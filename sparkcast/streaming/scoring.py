"""Row-local operators on Structured Streaming (V10, F10, M8 on a stream).

Request rules, serving features and model scoring use no ordering and no
aggregate, so they run unchanged on a streaming DataFrame: no state, no
watermark needed. Results go to a Parquet file sink (exactly-once, in the
shared checkpoint folder) rather than a driver-side memory sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkcast.operators.features import serving_features
from sparkcast.operators.validate import request_reasons
from sparkcast.session import scratch_dir

LINEITEM_SCHEMA = T.StructType(
    [
        T.StructField("l_orderkey", T.LongType()),
        T.StructField("l_partkey", T.LongType()),
        T.StructField("l_suppkey", T.LongType()),
        T.StructField("l_linenumber", T.IntegerType()),
        T.StructField("l_quantity", T.DoubleType()),
        T.StructField("l_extendedprice", T.DoubleType()),
        T.StructField("l_discount", T.DoubleType()),
        T.StructField("l_tax", T.DoubleType()),
        T.StructField("l_returnflag", T.StringType()),
        T.StructField("l_linestatus", T.StringType()),
        T.StructField("l_shipdate", T.TimestampType()),
    ]
)


def stream_glob(path: str) -> str:
    """A file stream source lists a folder or a glob; a single file (or a
    folder) named ``x.parquet`` becomes a glob that matches it alone."""
    if any(ch in path for ch in "*?["):
        return path
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]"


def read_lineitem_stream(spark: SparkSession, path: str, max_files_per_trigger: int = 64) -> DataFrame:
    """lineitem files as a stream (declared schema: streaming never infers)."""
    return (
        spark.readStream.schema(LINEITEM_SCHEMA)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .parquet(path)
    )


def requests_from_lineitem(lines: DataFrame) -> DataFrame:
    """One scoring request per order line (row-local; same rules as
    ``STREAM_REQUESTS_SQL``). Product ids 0..99 (0 is invalid), prices
    shifted by 50 so that some are not positive."""
    return lines.select(
        F.to_date("l_shipdate").alias("prediction_date"),
        (F.col("l_partkey") % 100).alias("product_id"),
        (F.lit(1) + F.col("l_partkey") % 5).alias("category_id"),
        (F.lit(1) + F.col("l_suppkey") % 10).alias("store_id"),
        (F.col("l_linenumber") * 10).cast("double").alias("historical_sales"),
        (F.floor((F.try_divide("l_extendedprice", "l_quantity") / 20 - 50) * 100) / 100).alias("price"),
        F.when(F.col("l_discount") >= 0.05, 1).otherwise(0).cast("bigint").alias("promotion_flag"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).cast("bigint").alias("holiday_flag"),
        (F.lit(100) + F.col("l_tax") * 100).alias("economic_index"),
        "l_orderkey",
        "l_linenumber",
    )


STREAM_REQUESTS_SQL = """
SELECT CAST(l_shipdate AS DATE) AS prediction_date, l_partkey % 100 AS product_id,
       1 + l_partkey % 5 AS category_id, 1 + l_suppkey % 10 AS store_id,
       CAST(l_linenumber * 10 AS DOUBLE) AS historical_sales,
       FLOOR((l_extendedprice / l_quantity / 20 - 50) * 100) / 100 AS price,
       CAST(CASE WHEN l_discount >= 0.05 THEN 1 ELSE 0 END AS BIGINT) AS promotion_flag,
       CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS BIGINT) AS holiday_flag,
       100 + l_tax * 100 AS economic_index, l_orderkey, l_linenumber
FROM lineitem
"""


def tag_requests(requests: DataFrame) -> DataFrame:
    """V10 on a stream: ``reasons`` array, empty for valid rows."""
    return request_reasons(requests)


def serving_stream(requests: DataFrame) -> DataFrame:
    """Valid requests with F10 serving features (stream in, stream out)."""
    tagged = tag_requests(requests)
    return serving_features(tagged.where(F.size("reasons") == 0).drop("reasons"))


def score_stream(requests: DataFrame, model) -> DataFrame:
    """M8 on a stream: features -> aligned columns -> clamped prediction."""
    from sparkcast.operators.features import align_columns

    feats = serving_stream(requests)
    keep = ["prediction_date", "product_id", "store_id"]
    aligned = align_columns(feats, list(dict.fromkeys(keep + model.feature_cols)))
    return model.predict(aligned).select(*keep, F.round("prediction", 2).alias("predicted_demand"))


def run_available_now(stream: DataFrame, name: str) -> DataFrame:
    """Process everything available, write Parquet with a checkpoint in the
    shared folder, stop, and return the written table as a batch frame."""
    spark = stream.sparkSession
    base = scratch_dir(spark, f"stream-{name}")
    q = (
        stream.writeStream.format("parquet")
        .option("path", f"{base}/out")
        .option("checkpointLocation", f"{base}/checkpoint")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.parquet(f"{base}/out")
