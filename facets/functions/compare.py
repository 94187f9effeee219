"""Comparisons that behave the same with ANSI mode on or off.

The reference compares text columns with numbers (``Plate_ID == 0``). Older
Spark cast the text silently (non-numeric -> NULL -> no match); Spark 4 runs
with ANSI on and raises ``CAST_INVALID_INPUT`` instead. ``matches`` keeps the
old meaning through ``try_cast``, so "0" and "000" equal 0 and "ABC" is no
match, without failing the job.

A failing cast makes and catches an exception for each row, which costs ten
times what a successful one does. ``number_of`` therefore casts only text that
begins like a number (or like Infinity and NaN, which are numbers to Spark).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Fixed value: how text that Spark casts to a number may begin.
NUMBER_START = r"^[\x00-\x20]*[+-]?([.\p{Nd}]|[iI][nN][fF]|[nN][aA][nN])"


def number_of(text: Column, kind: str = "double") -> Column:
    """``try_cast`` of text to a number; NULL without a cast where the text
    cannot be one."""
    return F.when(text.rlike(NUMBER_START), text.try_cast(kind))


def matches(df: DataFrame, column: str, value) -> Column:
    """``column == value`` with numeric-vs-text handled by ``try_cast``."""
    c = F.col(column)
    dtype = df.schema[column].dataType
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if isinstance(dtype, T.StringType):
            return number_of(c) == F.lit(float(value))
        return c == F.lit(value)
    if isinstance(value, str) and isinstance(dtype, T.NumericType):
        return c == F.lit(value).try_cast(dtype)
    return c == F.lit(value)
