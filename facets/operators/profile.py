"""Data-quality profiles.

The reference runs one job per check (11 null counts, 9 zero counts). Here
each profile is a single aggregate - one scan, one partial aggregate per
task, one row to finalise - and is returned in long form (one row per
checked column) through ``unpivot``, which works on that one row only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facets.functions.compare import matches
from facets.operators.rank import frequency


def shape(df: DataFrame) -> DataFrame:
    """Row and column counts as one row (``nrow`` / ``ncol``)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def structure(df: DataFrame) -> DataFrame:
    """(position, column_name, column_type) of every column; no data is read."""
    rows = [(i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, column_type string")


def structure_with_values(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """(position, column_name, column_type, first_values): ``structure`` with
    the texts of each column's first ``n`` values, rows in the order of the
    given columns (NULL first; NULL values show as NULL)."""
    few = first_rows(df, order, n)
    rank = F.struct(*[F.struct(F.col(f"`{c}`").isNotNull().alias("a"), F.col(f"`{c}`").alias("b")) for c in order])
    texts = F.array(*[F.col(f"`{f.name}`").cast("string") for f in df.schema.fields])
    one = few.select(rank.alias("at"), texts.alias("texts")).agg(F.array_sort(F.collect_list(F.struct("at", "texts"))).alias("rows"))
    names = F.array(*[F.struct(F.lit(i + 1).alias("position"), F.lit(f.name).alias("column_name"),
                               F.lit(f.dataType.simpleString()).alias("column_type")) for i, f in enumerate(df.schema.fields)])
    listed = one.select(F.inline(names), F.col("rows"))
    values = F.transform("rows", lambda r: F.get(r["texts"], F.col("position") - 1))
    return listed.select("position", "column_name", "column_type", values.alias("first_values"))


def first_rows(df: DataFrame, order: Sequence[str], n: int = 6) -> DataFrame:
    """The first ``n`` rows in the order of the given columns (NULL first)."""
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in order]).limit(n)


def _long(one_row: DataFrame, columns: list[str], value_name: str) -> DataFrame:
    return one_row.unpivot([], columns, "column_name", value_name)


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULLs per column, all columns in one pass: (column_name, n_null)."""
    cols = list(columns or df.columns)
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return _long(one, cols, "n_null")


def joined_null_profile(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """NULLs per column of ``left`` left-joined with ``right`` on ``key``:
    (column_name, n_null). Both sides are cut to the key and one flag a column
    before the join, so a shuffle carries flags and no values."""
    cols = list(columns)
    of_right = [c for c in cols if c not in left.columns]

    def flags(df: DataFrame, own: list[str]) -> DataFrame:
        return df.select(F.col(key).alias("_key"), *[F.col(c).isNull().alias(c) for c in own])

    joined = flags(left, [c for c in cols if c in left.columns]).join(flags(right, of_right), "_key", "left")
    # a row without a partner has no flags of the right side: its values are NULL
    one = joined.agg(*[F.count_if(F.coalesce(F.col(c), F.lit(True))).alias(c) for c in cols])
    return _long(one, cols, "n_null")


def sentinel_profile(df: DataFrame, sentinels: Mapping[str, object]) -> DataFrame:
    """Rows equal to a placeholder value per column, in one pass:
    (column_name, n_match). Text-vs-number uses ``try_cast`` (ANSI-safe)."""
    cols = list(sentinels)
    one = df.agg(*[F.count_if(F.coalesce(matches(df, c, v), F.lit(False))).alias(c)
                   for c, v in sentinels.items()])
    return _long(one, cols, "n_match")


def check_counts(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Rows satisfying each named predicate, every check from one aggregate:
    (check, n). Null checks, placeholder checks and any other conditional
    count share a single pass (a NULL predicate counts as not satisfied)."""
    names = list(checks)
    one = df.agg(*[F.count_if(F.coalesce(p, F.lit(False))).alias(n) for n, p in checks.items()])
    return one.unpivot([], names, "check", "n")


def year_profile(df: DataFrame, date_col: str, name: str = "year", count: str = "key") -> DataFrame:
    """Rows per calendar year of ``date_col`` (``count='key'`` as the
    reference's ``n(Issue_year)``: an undated group counts 0)."""
    return frequency(df.select(F.year(date_col).alias(name)), name, count, "n")


def uniqueness(df: DataFrame, key: str) -> DataFrame:
    """Exact distinct count of ``key`` against the row count.

    Exact on purpose: ``count(DISTINCT)`` shuffles every distinct key once
    (after a map-side distinct); an approximate count would hide a handful of
    duplicates, which is the thing being checked.
    """
    return (df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(key).alias("n_distinct"))
            .withColumn("is_unique", F.col("n_rows") == F.col("n_distinct")))


def duplicates(df: DataFrame, keys: Sequence[str] | str, name: str = "n") -> DataFrame:
    """Keys seen more than once, with how often."""
    return frequency(df, keys, "rows", name).where(F.col(name) > 1)


def value_range(df: DataFrame, column: str, as_type: str | None = None) -> DataFrame:
    """Smallest and largest value (e.g. date coverage); ``as_type`` is
    applied to these two, not to every row."""
    ends = df.agg(F.min(column).alias("min_value"), F.max(column).alias("max_value"))
    return ends if as_type is None else ends.select(*[F.col(c).cast(as_type).alias(c) for c in ends.columns])


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Exact number of distinct non-NULL values."""
    return df.agg(F.count_distinct(column).alias("n_distinct"))


def null_count(df: DataFrame, column: str) -> DataFrame:
    """Rows where ``column`` is NULL (``count(*) ... WHERE c IS NULL``)."""
    return df.agg(F.count_if(F.col(column).isNull()).alias("n_null"))


def unbinned(df: DataFrame, bin_col: str) -> DataFrame:
    """Rows that fell outside every bin."""
    return df.where(F.col(bin_col).isNull())
