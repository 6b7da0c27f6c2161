"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkcast.session import scratch_dir

#: A word: a maximal run of characters outside space and U+0009..U+000D.
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame, name: str, *by: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back.

    ``by``: columns that part the files, so that filters on them skip the rest.

    Cuts the lineage with files that any executor can read again, so a lost
    executor costs nothing that was finished before.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.mode("overwrite").partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def numbered(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` under column names that clash with nothing, and the new names."""
    names = {c: f"_c{i}" for i, c in enumerate(df.columns)}
    return df.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]), names


def restored(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """The columns that ``numbered`` renamed, under their own names."""
    return df.select(*[F.col(n).alias(c) for c, n in names.items()])
