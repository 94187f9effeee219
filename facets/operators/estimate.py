"""Revenue estimate from a rate table.

The reference multiplies three collected counts by a local vector matched by
row position. Here rates are matched by key:

* a ``dict`` of rates becomes a literal map expression looked up per row -
  no join, no shuffle, stays in whole-stage codegen;
* a rates *table* (of any size) is first cut to the k keys by a left-semi join
  against their broadcast - the table is streamed, never shuffled - and
  brought to one rate a key, which leaves at most k rows; these are broadcast
  into the k counts. Two rates for one key raise an error when the query
  runs.

Default is left semantics (an unpriced code keeps its count, NULL price).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facets.operators.rank import frequency, top_k


def priced_top_k(df: DataFrame, key: str, k: int, rates: Mapping | DataFrame, *, rate: str = "fine",
                 total: str = "total_fines", name: str = "n", how: str = "left",
                 by: str | None = None) -> DataFrame:
    """Counts of the k most frequent keys times their rate. With ``by``,
    ``df`` is a count cube holding ``key`` (rolled up first)."""
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    if by is not None:
        top = top_k(frequency(df, key, by=by, name=name), key, k, by=name)
    else:
        top = top_k(df, key, k, name=name)
    if isinstance(rates, Mapping):
        lookup = F.create_map(*[F.lit(x) for kv in rates.items() for x in kv])
        out = top.withColumn(rate, lookup[F.col(key)])
        if how == "inner":
            out = out.where(F.col(rate).isNotNull())
    else:
        few = rates.select(key, rate).join(F.broadcast(top.select(key)), key, "left_semi")
        twice = F.raise_error(F.concat(F.lit("more than one rate for "), F.first(key).cast("string")))
        few = few.groupBy(key).agg(F.when(F.count(F.lit(1)) > 1, twice.cast(rates.schema[rate].dataType))
                                   .otherwise(F.max(rate)).alias(rate))
        out = top.join(F.broadcast(few), key, how).select(key, name, rate)
    return out.withColumn(total, F.col(name) * F.col(rate))


def total_of_top_k(df: DataFrame, key: str, k: int, *, name: str = "n", total: str = "total",
                   by: str | None = None) -> DataFrame:
    """Sum of the counts of the k most frequent keys (a query over a query)."""
    top = top_k(frequency(df, key, by=by, name=name), key, k, by=name) if by else top_k(df, key, k, name=name)
    return top.agg(F.sum(name).alias(total))
