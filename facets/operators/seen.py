"""Keys seen once and keys seen again, without shuffling the keys.

A duplicate check on a key that is nearly unique has to bring equal keys
together, but only their hashes need to travel. Each task sorts the hashes of
its keys, drops what it has seen, and packs the rest for each range of hashes:
a list of those seen and, within it, of those seen more than once. The lists of
a range meet in one task, which merges them and names the hashes that came
twice. Packed, a hash takes 1 to 5 bytes (``hash_bits``), a key with its count
several times that.

The named hashes become a bit filter of bounded size (``facets.operators.bits``)
that is broadcast. Rows without their bit carry a key that occurs once for
sure; the others are counted exactly, and only these are shuffled. So the
answers are exact at any size: where keys repeat a lot, the filter fills up and
the count does all the work, combined on the map side.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facets.functions.packing import pack_sorted, unpack_sorted
from facets.operators.bits import bit_words, key_hash, with_bit, without_bit
from facets.operators.rank import Keys, frequency, order_columns

#: Hashes that a task sorts at once, and that a range holds (about).
FLUSH = 4_000_000
RANGE = 2_000_000


def hash_bits(rows: int) -> int:
    """Bits of a hash, so that few keys share one by chance: one in 64, and no
    more than some millions, which the filter holds."""
    size = math.log2(max(rows, 2))
    return min(64, max(16, math.ceil(size) + 6, math.ceil(2 * size) - 22))


def _range_bits(rows: int, bits: int, partitions: int) -> int:
    ranges = max(2 * partitions, 2 * rows // RANGE, 2)
    return min((ranges - 1).bit_length(), bits - 1)


def _packed(bits: int, high: int):
    """(part, seen, again): for each range of hashes those of a task, packed,
    and which of them (by their place) it saw more than once."""
    rest = bits - high

    def blocks(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        bounds = np.append(np.searchsorted(values, np.arange(1 << high, dtype=np.uint64) << np.uint64(rest)), len(values))
        part, seen, again = [], [], []
        for r in np.flatnonzero(np.diff(bounds)):
            own = slice(bounds[r], bounds[r + 1])
            low = values[own] & np.uint64((1 << rest) - 1)
            part.append(int(r))
            seen.append(pack_sorted(low, rest))
            again.append(pack_sorted(low[counts[own] > 1], rest))
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(seen, pa.binary()), pa.array(again, pa.binary())],
                                         names=["part", "seen", "again"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(np.array(batch.column(0)).view(np.uint64))
            n += batch.num_rows
            if n >= FLUSH:
                yield from blocks(held)
                held, n = [], 0
        if n:
            yield from blocks(held)

    return run


def _repeated(bits: int, high: int):
    """(h): hashes that came more than once, from rows sorted by part."""
    rest = bits - high

    def named(part: int, once: list[np.ndarray], twice: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The distinct hashes of a range so far, and those that repeat."""
        values = np.sort(np.concatenate(once), kind="stable")
        same = values[1:] == values[:-1]
        return values[np.append(True, ~same)] if len(values) else values, np.unique(np.concatenate([*twice, values[1:][same]]))

    def rows(part: int, twice: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array((twice | np.uint64(part << rest)).view(np.int64))], names=["h"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, once, twice, n = None, [], [], 0
        for batch in batches:
            for part, seen, again in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                if part != now:
                    if once:
                        yield rows(now, named(now, once, twice)[1])
                    now, once, twice, n = part, [], [], 0
                once.append(unpack_sorted(seen.as_py(), rest))
                twice.append(unpack_sorted(again.as_py(), rest))
                n += len(once[-1])
                if n >= 2 * RANGE:  # merge what is there, and again when it has doubled
                    merged, repeated = named(now, once, twice)
                    once, twice, n = [merged], [repeated], len(merged) // 2
        if once:
            yield rows(now, named(now, once, twice)[1])

    return run


def repeated_hashes(df: DataFrame, keys: Keys, rows: int | None = None) -> tuple[DataFrame, Column]:
    """(h) of all keys that may occur more than once, no other key's; and the
    expression of a row's h. ``rows`` is about the number of rows; left out,
    it is counted first."""
    ks = [keys] if isinstance(keys, str) else list(keys)
    n = df.count() if rows is None else rows
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = hash_bits(n)
    high = _range_bits(n, bits, partitions)
    h = key_hash(ks, bits)
    sent = df.select(h.alias("h")).mapInArrow(_packed(bits, high), "part int, seen binary, again binary")
    met = sent.repartition(partitions, "part").sortWithinPartitions("part")
    return met.mapInArrow(_repeated(bits, high), "h long"), h


def _split(df: DataFrame, keys: Keys, rows: int | None) -> tuple[DataFrame, DataFrame]:
    """(rows whose key occurs once, rows whose key may repeat)."""
    repeated, h = repeated_hashes(df, keys, rows)
    filter_ = bit_words(repeated, "h")
    return without_bit(df, h, filter_), with_bit(df, h, filter_)


def repeated_keys(df: DataFrame, keys: Keys, name: str = "n", rows: int | None = None) -> DataFrame:
    """Keys that occur more than once, with how often: ``duplicates`` for a key
    that is nearly unique. A NULL key is a key."""
    ks = [keys] if isinstance(keys, str) else list(keys)
    return frequency(_split(df.select(*ks), ks, rows)[1], ks, "rows", name).where(F.col(name) > 1)


def key_uniqueness(df: DataFrame, key: str, rows: int | None = None) -> DataFrame:
    """(n_rows, n_distinct, is_unique) as ``uniqueness`` gives it, for a key
    that is nearly unique: every surplus row shows up in ``repeated_keys``."""
    surplus = (repeated_keys(df.where(F.col(key).isNotNull()), key, "n", rows)
               .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0).cast("long")).alias("surplus")))
    counts = df.agg(F.count(F.lit(1)).alias("n_rows"), F.count(key).alias("n_keys"))
    found = counts.withColumn("n_distinct", F.col("n_keys") - surplus.scalar())
    return found.select("n_rows", "n_distinct", (F.col("n_rows") == F.col("n_distinct")).alias("is_unique"))


def rarest_k(df: DataFrame, keys: Keys, k: int, name: str = "n", rows: int | None = None) -> DataFrame:
    """The k rarest keys (ties: smallest key, NULL first): ``bottom_k`` for keys
    of many values. Keys that occur once for sure are not shuffled; each task
    hands on the k smallest of them."""
    ks: Sequence[str] = [keys] if isinstance(keys, str) else list(keys)
    single, other = _split(df.select(*ks), ks, rows)
    order = order_columns(ks, name, descending=False)
    first = single.select(*ks, F.lit(1).cast("long").alias(name)).orderBy(*order).limit(k)
    return first.union(frequency(other, ks, "rows", name)).orderBy(*order).limit(k)
