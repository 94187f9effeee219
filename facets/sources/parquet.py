"""Parquet tables: reading the supplied tables and landing a cleaned table.

Landing replaces the reference's pattern of re-reading the raw CSV for every
one of its ~70 actions: clean once, write Parquet (optionally partitioned, so
year filters prune directories), and point every report query at it. The
write goes under the shared folder the cluster names in
``spark.checkpoint.dir`` - never a machine-local temp folder - so a lost
executor costs a task retry, not the lineage.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

# The supplied test tables.
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Unset on a cluster is an error; in a ``local[...]`` session a scratch
    folder is chosen (see ``facets.session.ensure_checkpoint_dir``)."""
    from facets.session import ensure_checkpoint_dir

    return ensure_checkpoint_dir(spark)


def land_parquet(df: DataFrame, path: str | None = None, partition_by: tuple[str, ...] = (),
                 mode: str = "overwrite") -> DataFrame:
    """Write ``df`` as Parquet and return a DataFrame reading it back."""
    spark = df.sparkSession
    if path is None:
        path = os.path.join(shared_dir(spark), f"landed-{uuid.uuid4().hex}")
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.parquet(path)


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage: a reliable ``checkpoint()``
    into the shared ``spark.checkpoint.dir`` (never ``localCheckpoint``, whose
    blocks die with their executor). Meant for small intermediate results
    that several answers read, such as count cubes."""
    from facets.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
