"""Top k over keys of many values, exact, with only candidates shuffled
(F5, F7, F8, F9).

``top_k`` combines counts on the map side, which is all it takes for codes or
states. With a key of many values (plates, makes as typed) every distinct value
of every task would move. Here a first pass counts hash slots instead of keys:
a table of bounded size, whose counts are upper bounds of the counts of the
keys in them. Exact counts of the keys in the fullest slots give a lower bound
of the k-th largest count. A key that can still reach it lies in a slot with at
least that count; only the rows of such slots (found by a broadcast bit filter
of bounded size) are shuffled and counted exactly.

``top_k_per_group_of_many`` does so in each group: slots are those of a (group,
key) pair, so a group that owns most rows is spread over its slots like any
other, and each group has a bound of its own.

The data is read three times, pruned to group and keys. Worth it where distinct
keys are many and the k largest stand out; the answer is the same anyway.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from facets.operators.bits import bit_words, key_hash, with_bit
from facets.operators.rank import Keys, as_keys, frequency, order_columns, top_k
from facets.sources.parquet import materialize

#: Hash slots of all keys, and those whose keys are counted first, for each of the k.
SLOTS, PROBES = 1 << 18, 4
#: Hash slots of a group, and parts in which its ranking meets.
GROUP_SLOTS, MEETS = 1 << 14, 128


def _slot(keys: list[str], slots: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(20), *keys), F.lit(slots)).cast("int")


def _in_slots(df: DataFrame, on: list[str], slots: DataFrame) -> DataFrame:
    """Rows of ``df`` in one of the slots, and perhaps a few others: a bit
    filter of bounded size is broadcast, ``df`` is not shuffled."""
    return with_bit(df, key_hash(on), bit_words(slots.select(key_hash(on).alias("h")), "h"))


def top_k_of_many(df: DataFrame, keys: Keys, k: int, *, name: str = "n", slots: int = SLOTS, probes: int = PROBES) -> DataFrame:
    """The k most frequent keys with their counts, as ``top_k`` (ties: smallest
    key, NULL first)."""
    ks = as_keys(keys)
    rows = df.select(*ks, _slot(ks, slots).alias("_slot"))
    filled = materialize(frequency(rows, "_slot", name="_most"))  # at most `slots` rows
    fullest = top_k(filled, "_slot", max(1, probes * k), by="_most")
    probed = top_k(_in_slots(rows, ["_slot"], fullest), ks, k, name="_n")
    # with fewer than k keys there, the bound is 0 and nothing is left out
    bound = probed.agg(F.when(F.count(F.lit(1)) == k, F.min("_n")).otherwise(0).alias("bound")).scalar()
    reach = filled.where(F.col("_most") >= bound)
    return top_k(_in_slots(rows, ["_slot"], reach), ks, k, name=name)


def slice_top_k_of_many(df: DataFrame, where: Column, keys: Keys, k: int, **options) -> DataFrame:
    """``top_k_of_many`` within one slice (the filter reaches the scan)."""
    return top_k_of_many(df.where(where), keys, k, **options)


def _null_safe(a: DataFrame, b: DataFrame, on: list[str], how: str) -> DataFrame:
    """Join with the group table ``b``; NULL groups match."""
    renamed = b.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(on)], *[c for c in b.columns if c not in on])
    same = None
    for i, c in enumerate(on):
        eq = F.col(c).eqNullSafe(F.col(f"_g{i}"))
        same = eq if same is None else same & eq
    return a.join(renamed, same, how).drop(*[f"_g{i}" for i in range(len(on))])


def top_k_per_group_of_many(df: DataFrame, group: Keys, keys: Keys, k: int, *, name: str = "n", rank: str = "rank",
                            slots: int = GROUP_SLOTS, probes: int = PROBES) -> DataFrame:
    """For every group its k most frequent keys and their rank, as
    ``top_k_per_group``; a NULL group or key counts as a value.

    Slots are counted per (group, slot), at most ``slots`` rows a group. The
    candidates of a group are ranked slot by slot, then in ``MEETS`` parts, then
    together: however many keys a group has, the last step sees k x MEETS.
    """
    gs, ks = as_keys(group), as_keys(keys)
    rows = df.select(*gs, *ks, _slot(ks, slots).alias("_slot"))
    filled = materialize(frequency(rows, [*gs, "_slot"], name="_most"))
    of_group = Window.partitionBy(*gs).orderBy(F.desc("_most"), "_slot")
    fullest = filled.withColumn("_nth", F.row_number().over(of_group)).where(F.col("_nth") <= max(1, probes * k))
    probed = frequency(_in_slots(rows, [*gs, "_slot"], fullest), [*gs, *ks, "_slot"], name="_n")
    kth = _ranked(probed, gs, ks, k, "_n", "_nth").where(F.col("_nth") == k).select(*gs, F.col("_n").alias("_bound"))
    reach = _null_safe(filled, kth, gs, "left").where(F.col("_most") >= F.coalesce("_bound", F.lit(0)))
    exact = frequency(_in_slots(rows, [*gs, "_slot"], reach), [*gs, *ks, "_slot"], name=name)
    return _ranked(exact, gs, ks, k, name, rank).select(*gs, *ks, name, rank)


def _ranked(counted: DataFrame, gs: list[str], ks: list[str], k: int, by: str, rank: str) -> DataFrame:
    """The k first keys of each group, in three steps of fewer tasks each."""
    order = order_columns(ks, by, True)
    for part in (F.col("_slot"), F.col("_slot") % MEETS, None):
        within = Window.partitionBy(*gs, *([] if part is None else [part])).orderBy(*order)
        counted = counted.withColumn(rank, F.row_number().over(within)).where(F.col(rank) <= k)
    return counted


def mode_group_of_many(df: DataFrame, key: str, group: str, name: str = "n", **options) -> DataFrame:
    """For every key its most common group, as ``mode_group``, where groups are
    many: the top 1 of each key."""
    return top_k_per_group_of_many(df, key, group, 1, name=name, rank="_rank", **options).drop("_rank")
