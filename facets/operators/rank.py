"""Frequency and ranking operators.

Every ranking breaks ties on the key, ascending with NULL first, so the k-th
row is deterministic (the reference sorts on the count alone).

Physical shape, which is what makes these hold at scale:

* ``frequency`` is a hash aggregate with a map-side partial count, so a key
  holding a third of all rows costs one partial row per map task, not a hot
  reducer.
* ``top_k`` / ``bottom_k`` are ``orderBy(...).limit(k)``: Spark plans
  ``TakeOrderedAndProject`` (per-partition top-k, then k x partitions rows
  merged), never a full sort.
* ``top_k_per_group`` aggregates first, then ranks with ``row_number``, first
  within hash slices of each group's keys, then over the at most k x slices
  rows that are left of a group.
* ``mode_group`` is a plain aggregate (``min`` of a (-count, group) struct):
  argmax with a deterministic tie-break and partial aggregation, no window.
* Restricting to the top-k keys (or top-n groups) is a left-semi join
  against a broadcast of exactly k rows; beyond ``MOST_BROADCAST`` of them a bit
  filter of bounded size is broadcast instead, ahead of a shuffled join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from facets.operators.bits import bit_words, key_hash, with_bit
from facets.sources.parquet import materialize

Keys = str | Sequence[str]


def as_keys(keys: Keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _count(mode: str, keys: list[str]) -> Column:
    if mode == "rows":
        return F.count(F.lit(1))
    if mode == "key":
        # count(key): non-NULL values of the key only, so a NULL key's group counts 0.
        if len(keys) != 1:
            raise ValueError("count='key' needs exactly one key")
        return F.count(F.col(keys[0]))
    return F.count(F.col(mode))


def frequency(df: DataFrame, keys: Keys, count: str | Mapping[str, str] = "rows", name: str = "n", *,
              by: str | None = None) -> DataFrame:
    """Rows per key. ``count`` is ``"rows"`` (SQL ``count(*)``), ``"key"``
    (``count(key)``) or a column name; a mapping ``{out_name: mode}`` yields
    several counts from the same single aggregate.

    With ``by``, ``df`` is already counted (e.g. a (group, key) count cube)
    and the counts are rolled up by summing ``by`` - same numbers, read from
    a table of a few rows instead of the data."""
    ks = as_keys(keys)
    measures = {name: count} if isinstance(count, str) else dict(count)
    if by is not None:
        def rolled(mode):
            if mode == "rows":
                return F.sum(by)
            if mode == "key" and len(ks) != 1:
                raise ValueError("count='key' needs exactly one key")
            col = ks[0] if mode == "key" else mode
            return F.coalesce(F.sum(F.when(F.col(col).isNotNull(), F.col(by))), F.lit(0).cast("bigint"))
        return df.groupBy(*ks).agg(*[rolled(m).alias(out) for out, m in measures.items()])
    return df.groupBy(*ks).agg(*[_count(m, ks).alias(out) for out, m in measures.items()])


def order_columns(keys: Sequence[str], by: str, descending: bool) -> list[Column]:
    """Listing order: the count, then the keys ascending with NULL first."""
    primary = F.col(by).desc() if descending else F.col(by).asc()
    return [primary] + [F.col(k).asc_nulls_first() for k in keys]


def _measured(df, keys, by, count, name):
    """(df counted by ``keys``, name of its count). A frame counted at a finer
    grain (``by`` names its count but ``keys`` do not cover its grain) must
    be rolled up first: pass it through ``frequency(..., by=...)``."""
    if by is not None:
        return df, by
    return frequency(df, keys, count, name), name


def top_k(df: DataFrame, keys: Keys, k: int, *, by: str | None = None, count: str = "rows",
          name: str = "n") -> DataFrame:
    """The k most frequent keys. With ``by``, ``df`` is already counted and
    ``by`` names the measure."""
    ks = as_keys(keys)
    freq, by = _measured(df, ks, by, count, name)
    return freq.orderBy(*order_columns(ks, by, True)).limit(k)


def bottom_k(df: DataFrame, keys: Keys, k: int, *, by: str | None = None, count: str = "rows",
             name: str = "n") -> DataFrame:
    """The k rarest keys."""
    ks = as_keys(keys)
    freq, by = _measured(df, ks, by, count, name)
    return freq.orderBy(*order_columns(ks, by, False)).limit(k)


def slice_top_k(df: DataFrame, where: Column, keys: Keys, k: int, **kw) -> DataFrame:
    """Top k within one slice (the filter reaches the scan first)."""
    return top_k(df.where(where), keys, k, **kw)


# Slices of each group's keys that are ranked on their own first.
SLICES = 64


def top_k_per_group(df: DataFrame, group: Keys, keys: Keys, k: int, *, by: str | None = None,
                    count: str = "rows", name: str = "n", rank: str = "rank", slices: int = SLICES) -> DataFrame:
    """For every group, its k most frequent keys with their rank (1..k). A
    NULL group or key counts as a value of its own.

    One shape for every k: the keys of a group are first ranked within
    ``slices`` hash slices of the key and cut to k there, so a group that owns
    most keys is ranked by many tasks, and its final ranking sees at most
    k x slices rows. Raise ``slices`` with the number of keys per group."""
    gs, ks = as_keys(group), as_keys(keys)
    freq, by = _measured(df, gs + ks, by, count, name)
    order = order_columns(ks, by, True)
    in_slice = Window.partitionBy(*gs, F.pmod(F.xxhash64(*ks), F.lit(slices))).orderBy(*order)
    few = freq.withColumn("_slice_rank", F.row_number().over(in_slice)).where(F.col("_slice_rank") <= k)
    w = Window.partitionBy(*gs).orderBy(*order)
    return few.drop("_slice_rank").withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


#: Keys of a computed list that are broadcast as they are; longer lists go through a bit filter.
MOST_BROADCAST = 100_000


def _among(df: DataFrame, column: str, few: DataFrame, size: int, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """Rows of ``df`` whose ``column`` is in ``few``, a one-column frame of at
    most ``size`` rows; NULL matches NULL. A short list is broadcast. Of a long
    one a bit filter of bounded size is; the rows that pass it (those wanted,
    and a few others) meet the list in a shuffled join."""
    wanted = few.select(F.col(column).alias("_wanted"))
    same = F.col(column).eqNullSafe(F.col("_wanted"))
    if size <= most_broadcast:
        return df.join(F.broadcast(wanted), same, "left_semi").select(*df.columns)
    near = with_bit(df, key_hash([column]), bit_words(wanted.select(key_hash(["_wanted"]).alias("h")), "h"))
    return near.hint("merge").join(wanted.hint("merge"), same, "left_semi").select(*df.columns)


def _many_top_keys(freq: DataFrame, key: str, k: int, by: str) -> DataFrame:
    """The k most frequent keys where k is large: a histogram of the counts
    (a few hundred rows) tells which counts are in for sure; only keys around
    the cut are sorted."""
    freq = materialize(freq.withColumn("_level", F.floor(F.log2(by) * 16).cast("int")))
    room, cut = k, None
    for r in sorted(freq.groupBy("_level").count().collect(), key=lambda r: -r["_level"]):
        cut = r["_level"]
        if r["count"] >= room:
            break
        room -= r["count"]
    if cut is None:
        return freq.select(key)
    last = freq.where(F.col("_level") == cut).orderBy(*order_columns([key], by, True)).limit(room)
    return freq.where(F.col("_level") > cut).select(key).union(last.select(key))


def top_k_in_top_groups(df: DataFrame, group: str, keys: Keys, n_groups: int, k: int, *,
                        name: str = "n", rank: str = "rank", by: str | None = None) -> DataFrame:
    """Top k keys inside each of the ``n_groups`` largest groups. A NULL group
    is a group like any other: ``n_groups`` groups come back whenever there
    are so many.

    Plan: group sizes are a per-group count (partial aggregate; the shuffle
    carries one row per group per task); the n largest are a
    ``TakeOrderedAndProject`` of n rows, broadcast - a size fixed by
    ``n_groups``, not by the data - into a left-semi join that drops every
    other group's rows at the scan, before the (group, key) aggregate and the
    per-group ranking. Two column-pruned reads, and only the chosen groups'
    rows reach the pair shuffle.
    """
    ks = as_keys(keys)
    if by is not None:  # df is a (group, keys) count cube
        sizes = frequency(df, group, by=by, name=name)
        top_groups = top_k(sizes, group, n_groups, by=name).select(group)
        return top_k_per_group(_among(df, group, top_groups, n_groups), group, ks, k, by=by, rank=rank)
    top_groups = top_k(df, group, n_groups).select(group)
    return top_k_per_group(_among(df, group, top_groups, n_groups), group, ks, k, name=name, rank=rank)


def common_keys(ranked: DataFrame, group: str, key: str, name: str = "n_groups") -> DataFrame:
    """Keys present in every group of a per-group ranking (F10); a NULL group
    or key counts as one.

    The (group, key) pairs are brought down to distinct ones once and landed.
    The number of groups is one value, a scalar subquery over them; a key is
    common if it has as many pairs. Both counts combine on the map side, so
    neither many groups nor many keys meet in one task.
    """
    pairs = materialize(ranked.select(group, key).distinct())
    n_all = pairs.select(group).distinct().agg(F.count(F.lit(1))).scalar()
    return pairs.groupBy(key).agg(F.count(F.lit(1)).alias(name)).where(F.col(name) == n_all)


def restrict_to_top_keys(df: DataFrame, key: str, k: int, count: str = "rows", *, by: str | None = None,
                         most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """Rows whose key is among the k most frequent (a computed ``IN`` list; a
    NULL key counts as a key). A list of more than ``most_broadcast`` keys is not
    broadcast (see ``_among``).

    With ``by``, ``df`` is a count cube and key totals are its sums. For a short
    list the cells of a key (as many as the other columns' domains allow)
    travel with its total, so the cube is computed once and nothing is landed;
    for a long one, or with ``most_broadcast=0``, the cube is landed and its
    cells are filtered where they are."""
    if by is not None and k <= most_broadcast:
        cells = df.groupBy(key).agg(F.sum(by).alias("_n"), F.collect_list(F.struct(*df.columns)).alias("_cells"))
        return cells.orderBy(*order_columns([key], "_n", True)).limit(k).select(F.inline("_cells"))
    if by is not None:
        df = materialize(df)
    totals = frequency(df, key, count, "_n", by=by)
    wanted = top_k(totals, key, k, by="_n").select(key) if k <= most_broadcast else _many_top_keys(totals, key, k, "_n")
    return _among(df, key, wanted, k, most_broadcast)


def ranked(counted: DataFrame, keys: Keys, by: str = "n", rank: str = "rank") -> DataFrame:
    """A whole frequency table in its listing order (count falling, then the
    keys), as a rank column. For tables over bounded domains, such as bins x
    codes: all their rows are ranked in one task."""
    w = Window.orderBy(*order_columns(as_keys(keys), by, True))
    return counted.withColumn(rank, F.row_number().over(w))


def frequencies(df: DataFrame, columns: Sequence[str], name: str = "n") -> DataFrame:
    """Frequency tables of several columns from **one** scan, in long form
    (column_name, value as text, n).

    ``unpivot`` expands each row into one row per column *before* the
    partial aggregate, so the shuffle carries at most one partial row per
    (column, value) per task - five frequency tables for the price of one
    read, where the reference runs five group-bys over five scans.
    """
    cols = list(columns)
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in cols])
    long = texts.unpivot([], cols, "column_name", "value")
    return frequency(long, ["column_name", "value"], "rows", name)


def mode_group(df: DataFrame, key: str, group: str, name: str = "n", *, by: str | None = None) -> DataFrame:
    """For every key, its most common group (ties: smallest group first).
    With ``by``, ``df`` is already a (key, group) count cube."""
    pair = frequency(df, [key, group], "rows", name, by=by)
    best = F.min(F.struct((-F.col(name)).alias("neg"), F.col(group).alias("g")))
    return (pair.groupBy(key).agg(best.alias("_best"))
            .select(key, F.col("_best.g").alias(group), (-F.col("_best.neg")).alias(name)))
