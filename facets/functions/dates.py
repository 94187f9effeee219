"""Date predicates and date parts.

``in_year`` writes a year restriction as a half-open date range rather than
``year(col) = y``: Catalyst cannot push ``year(...)`` into a Parquet scan, but
it does push the range (``PushedFilters: GreaterThanOrEqual, LessThan``), so
row groups of other years are skipped at scan time.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _bound(dtype: T.DataType, d: dt.date) -> Column:
    # A literal of the column's own type, so no cast lands on the column side
    # and the comparison stays a pushable source filter. Built from text: a
    # Python datetime literal would pass through the driver process's zone.
    text = F.lit(f"{d.isoformat()} 00:00:00")
    if isinstance(dtype, T.TimestampNTZType):
        return text.cast("timestamp_ntz")      # zone-free, like year() on it
    if isinstance(dtype, T.TimestampType):
        return text.cast("timestamp")          # session zone, like year() on it
    return F.lit(d)


def in_year(df: DataFrame, column: str, year: int) -> Column:
    dtype = df.schema[column].dataType
    if not isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        raise TypeError(f"{column} is {dtype.simpleString()}, not a date: load it with its layout (load_csv date_columns)")
    c = F.col(column)
    return (c >= _bound(dtype, dt.date(year, 1, 1))) & (c < _bound(dtype, dt.date(year + 1, 1, 1)))


def with_date_parts(df: DataFrame, column: str, parts: dict[str, str]) -> DataFrame:
    """Add date parts, e.g. ``{"Issue_year": "year", "Issue_month": "month"}``."""
    fns = {"year": F.year, "month": F.month, "day": F.dayofmonth, "quarter": F.quarter,
           "dayofweek": F.dayofweek, "hour": F.hour}
    return df.withColumns({name: fns[part](F.col(column)) for name, part in parts.items()})
