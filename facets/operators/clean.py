"""Cleaning steps.

All are narrow transformations (no shuffle) except ``replace_with_mode``,
whose mode is a scalar subquery: one aggregate, evaluated once, its single
value inlined into the projection - no join, no driver round trip.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facets.functions.clock import clock_parts, parse_clock12
from facets.functions.compare import matches
from facets.functions.dates import in_year
from facets.operators.derive import with_bound_columns
from facets.operators.rank import top_k


def keep_year(df: DataFrame, date_col: str, year: int, keep_null: bool = False) -> DataFrame:
    """Rows dated in ``year`` (a pushable date range). Undated rows go, as
    with the reference's ``year == 2017``, unless ``keep_null``."""
    cond = in_year(df, date_col, year)
    if keep_null:
        cond = cond | F.col(date_col).isNull()
    return df.where(cond)


def drop_sentinels(df: DataFrame, sentinels: Mapping[str, object], keep_null: bool = False) -> DataFrame:
    """Drop rows holding a placeholder in any listed column, in one filter.

    ``col != value`` is NULL for a NULL value, so such rows go too (as in the
    reference) unless ``keep_null``. The same holds for text that is not a
    number when a text column is checked against a number (it compares as
    NULL, as Spark without ANSI did).
    """
    cond = None
    for c, v in sentinels.items():
        ok = ~matches(df, c, v)
        if keep_null:
            ok = F.coalesce(ok, F.lit(True))
        cond = ok if cond is None else cond & ok
    return df.where(cond)


def replace_sentinel(df: DataFrame, column: str, sentinel, replacement) -> DataFrame:
    """Swap a placeholder for a constant; NULL stays NULL."""
    return df.withColumn(column, F.when(matches(df, column, sentinel), F.lit(replacement))
                         .otherwise(F.col(column)))


def replace_with_mode(df: DataFrame, column: str, sentinel) -> DataFrame:
    """Swap a placeholder for the most frequent other value (ties: smallest).
    Where there is no other value the placeholder stays."""
    rest = df.where(~matches(df, column, sentinel) & F.col(column).isNotNull())
    mode = top_k(rest, column, 1).select(column).scalar()
    return df.withColumn(column, F.when(matches(df, column, sentinel), F.coalesce(mode, F.col(column)))
                         .otherwise(F.col(column)))


def with_clock_hours(df: DataFrame, time_col: str, hours: str = "Violation_hours",
                     minutes: str | None = "Violation_mins", policy: str = "as_written") -> DataFrame:
    """Add the hour of day parsed from 12-hour clock text (and the minute text).

    The hour is bound once per row (``with_bound_columns``): bins and
    ``dropna`` above it test the value, not copies of the parser.
    """
    cols = {hours: parse_clock12(time_col, policy)}
    if minutes:
        cols[minutes] = clock_parts(time_col)[1]
    return with_bound_columns(df, cols)


def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a NULL in any (listed) column (``dropna``)."""
    return df.dropna("any", subset=list(subset) if subset else None)
