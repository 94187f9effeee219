"""Connected components of a table of links, as Spark joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facets.llm.common import materialize


def _mins(pairs: DataFrame) -> DataFrame:
    """Smallest partner of each u, combined on the map side, so that no task
    holds all pairs of a hub."""
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for every id that occurs in ``links``; component is the
    smallest id that can be reached.

    Alternates two steps until nothing changes: each id hands its smallest
    partner to its larger partners (large star), then to its smaller ones
    (small star). The number of rounds grows with the logarithm of the
    longest path. Links in either direction, repeated links and links of an
    id with itself are allowed; a link with a null end is ignored.
    """
    edges = materialize(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                        .where(F.col(a).isNotNull() & F.col(b).isNotNull()).distinct())
    ids = edges.select(F.col("u").alias("id")).union(edges.select(F.col("v").alias("id"))).distinct()
    edges = edges.where("u <> v")
    mark = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        m = _mins(both).select("u", F.least("u", "m").alias("m"))
        large = (both.join(m, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        # in `large` every v is smaller than its u
        least = _mins(large)
        small = (large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).distinct())
        edges = materialize(small)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    return (ids.join(edges.select(F.col("u").alias("id"), F.col("v").alias("component")), "id", "left")
            .select("id", F.coalesce("component", "id").alias("component")))
