"""Counts and ends of a Parquet table from its file statistics.

Spark can answer count, min and max from the footers of Parquet files, without
reading a page: its newer Parquet source takes the aggregate itself
(``PushedAggregation`` in the plan). That source and the push-down are settings
of a session, so the question is asked in a session of its own beside the
caller's (same application, same tables), and no setting of the caller's changes.

Spark pushes down whole-table aggregates of integers, floating-point numbers,
booleans and dates; with other types, or a filter on data, its ordinary plan
runs in the same place and gives the same answer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_statistics(spark: SparkSession, path: str, columns: Sequence[str], where: str | None = None) -> DataFrame:
    """One row for each column: (column_name, n_rows, n_null, min_value,
    max_value), the values as text."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    table = own.read.parquet(path)
    if where is not None:
        table = table.where(where)
    asked = [F.count(F.lit(1)).alias("n_rows")]
    for i, c in enumerate(columns):
        asked += [F.count(c).alias(f"k{i}"), F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}")]
    one = table.agg(*asked)
    rows = [F.struct(F.lit(c).alias("column_name"), F.col("n_rows"), (F.col("n_rows") - F.col(f"k{i}")).alias("n_null"),
                     F.col(f"lo{i}").cast("string").alias("min_value"), F.col(f"hi{i}").cast("string").alias("max_value")) for i, c in enumerate(columns)]
    return one.select(F.inline(F.array(*rows)))
