"""Named views: the reference composes its SQL by temp views over temp views."""

from __future__ import annotations

from pyspark.sql import DataFrame


def register_view(df: DataFrame, name: str) -> DataFrame:
    """``createOrReplaceTempView`` that returns the frame for chaining.

    A view is a plan, not data: queries over it inline the plan and Catalyst
    optimises the whole chain (pruning and pushdown reach the scan).
    """
    df.createOrReplaceTempView(name)
    return df
