"""Session construction and the shared checkpoint location."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every sparkcast session wants, whatever the cluster size.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoints go when nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "sparkcast",
    shuffle_partitions: int | None = None,
    extra_conf: dict | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the sparkcast defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; locally
    the shuffle partition count should follow the core count.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def small_methods(spark: SparkSession):
    """Steps that run inside have no generated method of over 8,000 bytes.

    The JVM never compiles longer ones (a select of some fifty columns may make
    one), and interpreting them takes several times as long.
    """
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), 8000)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Read from ``spark.checkpoint.dir`` (or a directory already set on the
    context). Library code never invents one: a machine-local folder would
    not survive the loss of an executor on a cluster.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    raise RuntimeError(
        "spark.checkpoint.dir is not set; configure a shared (HDFS/S3/ABFS) "
        "folder for it, or call use_local_checkpoint_dir() in local tests"
    )


def use_local_checkpoint_dir(spark: SparkSession, base: str | None = None) -> str:
    """For local runs and tests only: set a /tmp checkpoint folder if unset.

    On a cluster master this never invents a machine-local folder; a missing
    ``spark.checkpoint.dir`` stays an error there.
    """
    try:
        return checkpoint_dir(spark)
    except RuntimeError:
        if not spark.sparkContext.master.startswith("local"):
            raise
        path = tempfile.mkdtemp(prefix="sparkcast-ckpt-", dir=base or "/tmp")
        spark.sparkContext.setCheckpointDir(path)
        return path


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint location for written tables."""
    root = checkpoint_dir(spark).rstrip("/")
    return f"{root}/{name}-{os.getpid()}-{next(_counter)}"


def _count():
    i = 0
    while True:
        i += 1
        yield i


_counter = _count()
