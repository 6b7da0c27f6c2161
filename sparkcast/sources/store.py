"""Versioned feature store on Parquet (K1-K5).

Layout under ``root``::

    root/data/name=<name>/version=<version>/save=<id>/part-*.parquet
    root/_log/<number>.json          one file a commit, its events as JSON lines

A save writes a fresh folder and then commits: its event becomes the next
numbered log file by a rename that fails if the number is taken, and the writer
tries the number after it. So a save that fails leaves everything as it was, a
version saved again stays readable in its old form until the commit and for
readers that began before it, and no writer's event is lost. The file system
must rename without replacing (HDFS does; writers of one process also take
turns).

The current catalogue is "saves without a later delete", and "latest" is a
lookup (newest ``created_at``), not a second copy of the data (Q9). Names and
versions are exact partition values, so no prefix globbing.
"""

from __future__ import annotations

import json
import threading
import uuid
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LOG_SCHEMA = (
    "event string, name string, version string, created_at timestamp, seq bigint, "
    "rows bigint, columns bigint, column_names string, dtypes string, metadata string, path string"
)

_commit = threading.Lock()


class FeatureStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # paths ---------------------------------------------------------------
    def data_path(self, name: str, version: str) -> str:
        return f"{self.root}/data/name={name}/version={version}"

    @property
    def log_path(self) -> str:
        return f"{self.root}/_log"

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.root)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), jvm

    def _numbers(self) -> list[int]:
        fs, jvm = self._fs()
        path = jvm.org.apache.hadoop.fs.Path(self.log_path)
        if not fs.exists(path):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(path)]
        return [int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()]

    def _append_log(self, events: list[dict]) -> int:
        """Commit the events as the next log file; returns its number."""
        fs, jvm = self._fs()
        Path = jvm.org.apache.hadoop.fs.Path
        none = jvm.org.apache.hadoop.fs.Options.Rename.valueOf("NONE")
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = none
        qualified = fs.makeQualified(Path(self.log_path))
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            qualified.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration()
        )
        fs.mkdirs(qualified)
        with _commit:
            number = max(self._numbers(), default=0) + 1
            while True:
                seq = [{"seq": number * 1_000_000 + i, **e} for i, e in enumerate(events)]
                text = "".join(json.dumps(e, default=str) + "\n" for e in seq)
                draft = Path(qualified, f".draft-{uuid.uuid4().hex}")
                out = fs.create(draft, False)
                out.write(bytearray(text.encode()))
                out.close()
                try:
                    context.rename(draft, Path(qualified, f"{number:012d}.json"), options)
                    return number
                except Py4JJavaError as e:
                    fs.delete(draft, False)
                    if "FileAlreadyExists" not in e.java_exception.getClass().getName():
                        raise
                    number += 1

    def _log(self) -> DataFrame:
        if not self._numbers():
            return self.spark.createDataFrame([], LOG_SCHEMA)
        return self.spark.read.schema(LOG_SCHEMA).json(self.log_path)

    # K1 ------------------------------------------------------------------
    def save_features(
        self, df: DataFrame, name: str, version: str | None = None, metadata: dict | None = None
    ) -> str:
        """Write one version; returns its path. Default version = UTC timestamp."""
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        version = version or now.strftime("%Y%m%d_%H%M%S_%f")
        path = f"{self.data_path(name, version)}/save={uuid.uuid4().hex}"
        df.write.mode("errorifexists").option("compression", "snappy").parquet(path)
        # row count from the written files' footers, not a second pass over df
        rows = self.spark.read.parquet(path).count()
        self._append_log(
            [
                {
                    "event": "save",
                    "name": name,
                    "version": version,
                    "created_at": now.isoformat(),
                    "rows": rows,
                    "columns": len(df.columns),
                    "column_names": json.dumps(df.columns),
                    "dtypes": json.dumps(dict(df.dtypes)),
                    "metadata": json.dumps(metadata or {}, default=str),
                    "path": path,
                }
            ]
        )
        return path

    # catalogue -----------------------------------------------------------
    def versions(self, name: str) -> DataFrame:
        """Live versions of ``name`` (saves without a later delete)."""
        log = self._log().where(F.col("name") == name)
        saves = log.where(F.col("event") == "save")
        deletes = (
            log.where(F.col("event") == "delete").groupBy("version").agg(F.max("seq").alias("_dseq"))
        )
        live = saves.join(deletes, "version", "left").where(
            F.col("_dseq").isNull() | (F.col("_dseq") < F.col("seq"))
        )
        # a version saved twice: keep its newest save
        w = Window.partitionBy("version").orderBy(F.desc("seq"))
        return live.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn", "_dseq", "event")

    def _resolve(self, name: str, version: str | None):
        """(version, path) of the save that counts."""
        if version and version != "latest":
            row = self.versions(name).where(F.col("version") == version).select("version", "path").first()
        else:
            newest = self.versions(name).orderBy(F.desc("created_at"), F.desc("seq"))
            row = newest.select("version", "path").first()
        if row is None:
            raise FileNotFoundError(f"no features {name!r} version {version or 'latest'!r}")
        return row

    # K2 ------------------------------------------------------------------
    def load_features(self, name: str, version: str | None = None) -> DataFrame:
        """A version, or the newest one; a missing one raises FileNotFoundError."""
        return self.spark.read.parquet(self._resolve(name, version)["path"])

    # K3 ------------------------------------------------------------------
    def get_feature_metadata(self, name: str, version: str | None = None) -> DataFrame:
        """One row: the metadata of a version, or of the newest one."""
        v = self._resolve(name, version)["version"]
        return self.versions(name).where(F.col("version") == v)

    # K4 ------------------------------------------------------------------
    def list_feature_versions(self, name: str) -> DataFrame:
        """T5: version, created_at, rows, columns, newest first."""
        return (
            self.versions(name)
            .select("version", "created_at", "rows", "columns", "seq")
            .orderBy(F.desc("created_at"), F.desc("seq"))
            .drop("seq")
        )

    # K5 ------------------------------------------------------------------
    def delete_old_versions(self, name: str, keep_last: int = 3) -> int:
        """Keep the newest ``keep_last`` versions, delete the rest; returns the count."""
        w = Window.orderBy(F.desc("created_at"), F.desc("seq"))
        old = (
            self.versions(name)
            .withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") > keep_last)
            .select("version")
            .collect()  # version names only: one row per stored version
        )
        if not old:
            return 0
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        self._append_log(
            [
                {"event": "delete", "name": name, "version": r["version"], "created_at": now.isoformat()}
                for r in old
            ]
        )
        fs, jvm = self._fs()
        for r in old:
            fs.delete(jvm.org.apache.hadoop.fs.Path(self.data_path(name, r["version"])), True)
        return len(old)
