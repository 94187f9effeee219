"""Chart feed (A11, A12): bar-chart rows instead of a local plot.

The reference collects the top rows into a local data.frame and draws them.
``chart_rows`` returns (category text, value, rank) and stays a DataFrame;
the caller decides whether to ``toPandas()`` the k rows. The rank is taken
**after** the limit: an unpartitioned window on the full data would pull
every row into one task, while over k rows it is free.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from facets.operators.rank import top_k


def chart_rows(df: DataFrame, category: str, k: int, *, by: str | None = None, name: str = "n") -> DataFrame:
    top = top_k(df, category, k, by=by, name=name)
    value = by or name
    w = Window.orderBy(F.col(value).desc(), F.col(category).asc_nulls_first())
    return top.select(F.col(category).cast("string").alias("category"), F.col(value).alias("value"),
                      F.row_number().over(w).alias("rank"))
