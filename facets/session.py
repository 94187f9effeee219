"""Session helpers.

On a cluster the session comes from ``spark-submit`` and its settings win;
``cluster_session`` adds ``CLUSTER_CONF`` for what they leave open.
``local_session`` is for tests and the benchmark only.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Cluster managers whose machines share no local folders.
_CLUSTER_MASTERS = ("yarn", "k8s", "mesos")

# Settings for 100 TB of Parquet (README "Sizing"); all are Spark's own knobs.
# 256 MB splits give ~400k scan tasks. A frequency shuffle carries a few rows
# per task, so a few thousand reduce partitions are plenty; every partition
# more would cost each map task an index entry and the driver a block size.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.session.timeZone": "UTC",
}

# Reduce partitions where distinct keys move (exact uniqueness, duplicates:
# ~10^12 keys, ~20 TB). Set it around these two, not for a whole session.
WIDE_SHUFFLE_PARTITIONS = 80_000


def cluster_session(app: str) -> SparkSession:
    """The session that ``spark-submit`` provides, with ``CLUSTER_CONF`` for
    the settings it was not given. Checkpointed cubes are removed once no
    DataFrame refers to them."""
    builder = SparkSession.builder.appName(app)
    given = {k for k, _ in SparkConf().getAll()}
    for k, v in {**CLUSTER_CONF, "spark.cleaner.referenceTracking.cleanCheckpoints": "true"}.items():
        if k not in given:
            builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


@contextmanager
def wide_shuffles(spark: SparkSession, partitions: int = WIDE_SHUFFLE_PARTITIONS) -> Iterator[None]:
    """More reduce partitions for the queries that run inside."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def local_session(cores: int = 8, shuffle_partitions: int | None = None, app: str = "facets",
                  driver_memory: str = "8g", conf: dict[str, str] | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.driver.memory", driver_memory)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.session.timeZone", "UTC"))
    for k, v in (conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; only when it is unset in a
    ``local[...]`` session (tests) pick a scratch folder of our own. On a
    cluster a machine-local folder would vanish with its executor, so an
    unset value is an error there, and a ``file:`` folder is one where the
    cluster manager places executors on machines of their own. (A standalone
    cluster may mount one folder everywhere; there it is the owner's word.)"""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, S3, ...)")
        d = tempfile.mkdtemp(prefix="facets-ckpt-")
    if d.startswith("file:") and spark.sparkContext.master.startswith(_CLUSTER_MASTERS):
        raise RuntimeError(f"spark.checkpoint.dir is {d}: a cluster needs a folder that its machines share")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return os.fspath(d)
