"""Bins that the rows of a table describe, however many.

A short list of bins becomes an expression (``bin_lookup``, ``bins_lookup``). A longer one stays
a table and is joined: the number line is cut into cells, once for each width
of a bin rounded up to a power of two. A bin lies in two cells or so of its own
width, a value in one cell of each width, so the two meet in an equi-join on
(width, cell), and the bin's ends decide. Neither bins nor values pass through
the driver, which sees how many bins there are of each width.

The work grows with the pairs of a value and the bins near it. Where values
repeat, count them first (``frequency``) and roll the counts up afterwards: then
the distinct values are joined, and none is hot.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facets.functions.binning import MOST_BINS, bin_lookup, bins_lookup, bins_of_table

#: Bins that become an expression; longer lists are joined.
MOST_LISTED = 10_000

# Widths are powers of two a double can hold; a cell's number has at most 52 bits.
_LEAST, _MOST, _BITS = -1022.0, 1023.0, 50


def _cell(x: Column, width: Column) -> Column:
    """Number of the cell that holds ``x``; never falls as ``x`` grows."""
    finite = F.least(F.greatest(x, F.lit(-sys.float_info.max)), F.lit(sys.float_info.max))
    return F.floor(finite / F.pow(F.lit(2.0), width))


def _holds(x: Column, low_closed: bool, high_closed: bool) -> Column:
    low, high = F.col("_low"), F.col("_high")
    return ((x >= low) if low_closed else (x > low)) & ((x <= high) if high_closed else (x < high))


def _table(bins: DataFrame, label: str, low: str, high: str, order: str) -> DataFrame:
    """(_low, _high, _nth, _bin, _width) of the rows with a label and both ends;
    no width where no value lies between the ends."""
    rows = bins.where(F.col(label).isNotNull() & F.col(low).isNotNull() & F.col(high).isNotNull()).select(
        F.col(low).cast("double").alias("_low"), F.col(high).cast("double").alias("_high"),
        F.struct(F.col(order), F.col(label)).alias("_nth"), F.col(label).cast("string").alias("_bin"))
    lo, hi = F.col("_low"), F.col("_high")
    finest = F.log2(F.greatest(F.abs(lo), F.abs(hi))) - _BITS
    width = F.ceil(F.least(F.greatest(F.log2(hi - lo), finest, F.lit(_LEAST)), F.lit(_MOST)))
    return rows.withColumn("_width", F.when((lo <= hi) & ~F.isnan(hi), width).cast("int"))


def _met(values: DataFrame, x: str, table: DataFrame, widths: list[int], low_closed: bool, high_closed: bool) -> DataFrame:
    """Every row of ``values`` beside each bin that holds its ``x``. Both sides
    are shuffled: files of many short rows look small enough to broadcast, and are not."""
    v = F.col(x)
    asked = values.where(v.isNotNull() & ~F.isnan(v)).withColumn("_width", F.explode(F.array(*map(F.lit, widths)).cast("array<int>")))
    pieces = table.withColumn("_cell", F.explode(F.sequence(_cell(F.col("_low"), F.col("_width")), _cell(F.col("_high"), F.col("_width")))))
    pairs = asked.withColumn("_cell", _cell(v, F.col("_width"))).join(pieces.hint("merge"), ["_width", "_cell"])
    return pairs.where(_holds(v, low_closed, high_closed))


def _widths(table: DataFrame) -> tuple[int, list[int]]:
    """Number of bins, and the widths among them."""
    found = table.groupBy("_width").count().collect()
    return sum(r["count"] for r in found), sorted(r["_width"] for r in found if r["_width"] is not None)


def each_bin(df: DataFrame, c: str, bins: DataFrame, label: str, low: str, high: str, order: str, *, name: str = "bin",
             low_closed: bool = False, high_closed: bool = True, most_listed: int = MOST_LISTED) -> DataFrame:
    """Each row of ``df`` once for every bin that holds its ``c``, with the bin's
    label as ``name`` (bins may overlap); rows that no bin holds are left out."""
    table = _table(bins, label, low, high, order)
    n, widths = _widths(table)
    if n <= min(most_listed, MOST_BINS):
        spec = bins_of_table(bins, label, low, high, order, low_closed=low_closed, high_closed=high_closed)
        return df.withColumn(name, F.explode(bins_lookup(c, spec)))
    met = _met(df.withColumn("_x", F.col(c).cast("double")), "_x", table, widths, low_closed, high_closed)
    return met.withColumnRenamed("_bin", name).drop("_x", "_width", "_cell", "_low", "_high", "_nth")


def first_bin(df: DataFrame, c: str, bins: DataFrame, label: str, low: str, high: str, order: str, *, name: str = "bin",
              low_closed: bool = False, high_closed: bool = True, most_listed: int = MOST_LISTED) -> DataFrame:
    """``df`` with the label of the first bin that holds its ``c`` as ``name``, by
    ``order`` (NULL first), then label; NULL if none does."""
    table = _table(bins, label, low, high, order)
    n, widths = _widths(table)
    if n <= min(most_listed, MOST_BINS):
        spec = bins_of_table(bins, label, low, high, order, low_closed=low_closed, high_closed=high_closed)
        return df.withColumn(name, bin_lookup(c, spec))
    x = F.col(c).cast("double").alias("_x")
    firsts = _met(df.select(x).distinct(), "_x", table, widths, low_closed, high_closed).groupBy("_x").agg(F.min_by("_bin", "_nth").alias(name))
    return df.select("*", x).join(firsts.hint("merge"), "_x", "left").drop("_x")
