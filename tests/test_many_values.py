"""Keys of many values: seen-once filter, threshold top k, long lists, common keys."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from conftest import SF001, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from facets.functions.packing import pack_sorted, unpack_sorted
from facets.operators import (
    bottom_k,
    common_keys,
    duplicates,
    key_uniqueness,
    mode_group,
    mode_group_of_many,
    rarest_k,
    repeated_keys,
    restrict_to_top_keys,
    slice_top_k_of_many,
    top_k,
    top_k_of_many,
    top_k_per_group,
    top_k_per_group_of_many,
    uniqueness,
)
from facets.operators import rank as rank_module
from facets.operators.bits import bit_words, key_hash, with_bit, without_bit
from facets.operators.seen import hash_bits, repeated_hashes


def plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def keyed(spark, n=4000, parts=7):
    """(a, b): nearly unique pairs, some repeated in one task and across tasks, NULLs in both."""
    rng = random.Random(n)
    data = [(rng.randrange(10**9), f"k{i}") for i in range(n)]
    data += [data[rng.randrange(n)] for _ in range(40)] + [data[3]] * 5 + [(None, "x"), (None, "x"), (1, None), (None, None), (None, None)]
    rng.shuffle(data)
    return data, spark.createDataFrame(data, "a long, b string").repartition(parts)


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 64), st.data())
def test_packing_is_exact(bits, data):
    values = np.array(sorted(data.draw(st.sets(st.integers(0, (1 << bits) - 1), max_size=70))), np.uint64)
    assert unpack_sorted(pack_sorted(values, bits), bits).tolist() == values.tolist()


def test_packing_is_small():
    rng = np.random.default_rng(0)
    values = np.unique(rng.integers(0, 1 << 40, 100_000, dtype=np.uint64))
    assert 8 * len(pack_sorted(values, 40)) < (40 - math.log2(len(values)) + 3) * len(values)


def test_hash_bits_leave_few_twins_by_chance():
    for n in (1, 1000, 10**6, 10**9, 10**12):
        bits = hash_bits(n)
        assert bits <= 64 and (bits == 64 or n * n / 2**bits <= max(n / 64, 2**23))
    assert hash_bits(10**6) <= 27


def test_repeated_keys_as_plain_counts(spark):
    data, df = keyed(spark)
    for ks in (["a", "b"], ["a"], ["b"]):
        assert sorted(map(str, rows(repeated_keys(df, ks)))) == sorted(map(str, rows(duplicates(df, ks))))
    want = {k: n for k, n in Counter(data).items() if n > 1}
    assert {(a, b): n for a, b, n in rows(repeated_keys(df, ["a", "b"]))} == want
    assert rows(repeated_keys(df.limit(0), ["a"])) == []


def test_the_named_hashes_are_those_of_repeated_keys(spark):
    _, df = keyed(spark)
    hashes, h = repeated_hashes(df, ["a", "b"])
    named = [r.h for r in hashes.collect()]
    found = Counter(r.h for r in df.select(h.alias("h")).collect())
    assert len(named) == len(set(named)) and set(named) == {k for k, n in found.items() if n > 1}


def test_a_key_that_repeats_everywhere_is_still_exact(spark):
    df = spark.range(0, 20_000, 1, 6).select((F.col("id") % 13).alias("k"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("u"))
    assert sorted(rows(repeated_keys(df, "k"))) == sorted(rows(duplicates(df, "k")))
    assert rows(rarest_k(df, "k", 4)) == rows(bottom_k(df, "k", 4))
    for c in ("k", "u"):
        assert rows(key_uniqueness(df, c)) == rows(uniqueness(df, c))


def test_uniqueness_and_rarest(spark):
    _, df = keyed(spark)
    for c in ("a", "b"):
        assert rows(key_uniqueness(df, c)) == rows(uniqueness(df, c))
    for k in (3, 50):
        assert rows(rarest_k(df, ["a", "b"], k)) == rows(bottom_k(df, ["a", "b"], k))
    few = spark.createDataFrame([("x",), ("x",), (None,), (None,), ("y",), ("y",), ("y",)], "k string")
    assert rows(rarest_k(few, "k", 9)) == rows(bottom_k(few, "k", 9)) == [(None, 2), ("x", 2), ("y", 3)]


def test_only_rows_that_may_repeat_are_shuffled(spark):
    """The filter is broadcast, whatever its size at most WORDS rows, and the
    exact count above it sees the repeated keys' rows only."""
    data, df = keyed(spark, 30_000)
    p = plan(repeated_keys(df, ["a", "b"]))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p and "CartesianProduct" not in p
    hashes, h = repeated_hashes(df, ["a", "b"])
    words = bit_words(hashes, "h")
    passed, total = with_bit(df, h, words).count(), df.count()
    repeats = sum(n for n in Counter(data).values() if n > 1)
    assert repeats <= passed <= repeats + total / 20
    assert passed + without_bit(df, h, words).count() == total


def test_bit_filter_loses_nothing_and_fills_up_gracefully(spark):
    df = spark.range(3000).select("id", F.col("id").cast("string").alias("t"))
    some = df.where("id % 7 = 0")
    for words in (1 << 20, 1):
        f = bit_words(some.select(key_hash(["t"]).alias("h")), "h", words)
        assert f.count() <= words
        kept = {r.id for r in with_bit(df, key_hash(["t"]), f, words).collect()}
        assert {r.id for r in some.collect()} <= kept
    assert len(kept) > 2900  # 429 hashes in 64 bits


# --- threshold top k ----------------------------------------------------------------------------

def skewed(spark, n=30_000, keys=9000):
    rng = random.Random(7)
    data = [(rng.choice(["x", "x", "x", "x", "y", None]), int(rng.paretovariate(0.6)) % keys if rng.random() < 0.97 else None) for _ in range(n)]
    return spark.createDataFrame(data, "g string, k long").repartition(5)


@pytest.mark.parametrize("slots", [50, 1 << 18])
def test_top_k_of_many_is_exact_for_any_number_of_slots(spark, slots):
    df = skewed(spark)
    for k in (1, 40):
        assert rows(top_k_of_many(df, "k", k, slots=slots)) == rows(top_k(df, "k", k))
    assert rows(top_k_of_many(df, ["g", "k"], 9, slots=slots)) == rows(top_k(df, ["g", "k"], 9))
    assert rows(slice_top_k_of_many(df, F.col("g") == "y", "k", 6, slots=slots)) == rows(top_k(df.where("g = 'y'"), "k", 6))


def test_top_k_of_many_with_few_keys(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    assert rows(top_k_of_many(df, "k", 10)) == rows(top_k(df, "k", 10))
    assert rows(top_k_of_many(df.limit(0), "k", 3)) == []


def test_top_k_of_many_counts_candidates_only(spark):
    """Keys that cannot reach the k-th count do not get past the bit filter."""
    df = spark.range(0, 200_000, 1, 8).select(F.when(F.col("id") % 4 == 0, F.col("id") % 5).otherwise(F.col("id")).alias("k"))
    top = top_k_of_many(df, "k", 5)
    assert rows(top) == rows(top_k(df, "k", 5))
    p = top._jdf.queryExecution().executedPlan()
    written = []

    def walk(node):
        metrics = node.metrics()
        if "ShuffleExchange" in node.nodeName() or node.nodeName() == "Exchange":
            written.append(metrics.apply("shuffleRecordsWritten").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            walk(node.executedPlan())
        if node.nodeName().endswith("QueryStage"):
            walk(node.plan())

    walk(p)
    assert written and max(written) < 50_000  # 150,005 keys in all


@pytest.mark.parametrize("slots", [64, 1 << 14])
def test_per_group_top_k_of_many(spark, slots):
    df = skewed(spark)
    for k in (5, 300):
        assert sorted(map(str, rows(top_k_per_group_of_many(df, "g", "k", k, slots=slots)))) == sorted(map(str, rows(top_k_per_group(df, "g", "k", k))))
    assert sorted(map(str, rows(mode_group_of_many(df, "g", "k", slots=slots)))) == sorted(map(str, rows(
        top_k_per_group(df, "g", "k", 1).drop("rank"))))
    known = df.where("k is not null")
    assert sorted(map(str, rows(mode_group_of_many(known, "g", "k")))) == sorted(map(str, rows(mode_group(known, "g", "k"))))
    assert rows(top_k_per_group_of_many(df.limit(0), "g", "k", 2)) == []


def test_no_task_of_a_hot_group_ranks_most_keys(spark):
    """One group owns 95 % of 60,000 keys; each step of its ranking is spread."""
    from pyspark.sql import Window

    df = spark.range(0, 60_000, 1, 8).select(F.when(F.col("id") % 20 == 0, "cold").otherwise("hot").alias("g"), F.col("id").alias("k"))
    from facets.operators.threshold import MEETS, _slot

    steps = df.withColumn("_slot", _slot(["k"], 1 << 14))
    per_slot = steps.groupBy("g", "_slot").count().agg(F.max("count")).first()[0]
    met = steps.withColumn("r", F.row_number().over(Window.partitionBy("g", "_slot").orderBy("k"))).where("r <= 2")
    per_part = met.groupBy("g", F.col("_slot") % MEETS).count().agg(F.max("count"), F.avg("count")).first()
    assert per_slot < 30 and per_part[0] < 2 * 57_000 / MEETS
    assert len(rows(top_k_per_group_of_many(df, "g", "k", 2))) == 4


# --- long lists, common keys ------------------------------------------------------------------------

def test_long_lists_are_not_broadcast(spark):
    df = spark.range(0, 30_000, 1, 6).select((F.col("id") % 9001).alias("k"), F.col("id").alias("v")).union(
        spark.createDataFrame([(None, i) for i in range(9)], "k long, v long"))
    for k in (500, 1_000_000):
        short = restrict_to_top_keys(df, "k", k, most_broadcast=10**9)
        long = restrict_to_top_keys(df, "k", k, most_broadcast=0)
        assert sorted(map(str, rows(short))) == sorted(map(str, rows(long)))
    p = plan(restrict_to_top_keys(df, "k", 4000, most_broadcast=100))
    assert "SortMergeJoin" in p and "LeftSemi" in p
    assert rank_module.MOST_BROADCAST == 100_000
    cube = df.groupBy("k", (F.col("v") % 2).alias("odd")).agg(F.count(F.lit(1)).alias("n"))
    assert sorted(map(str, rows(restrict_to_top_keys(cube, "k", 20, by="n", most_broadcast=1)))) == sorted(
        map(str, rows(restrict_to_top_keys(cube, "k", 20, by="n"))))


def test_common_keys_of_many_groups(spark):
    """Every group has key 1, NULL included; key 2 is missing in one group of 20,000."""
    n = 20_000
    g = F.when(F.col("id") > 0, F.col("id"))
    base = spark.range(0, n, 1, 6)
    ranked = base.select(g.alias("g"), F.lit(1).alias("k")).union(base.where("id <> 77").select(g, F.lit(2))).union(base.select(g, F.lit(None).cast("int")))
    both = common_keys(ranked.union(ranked.limit(100)), "g", "k")
    assert sorted(map(str, rows(both))) == ["(1, 20000)", "(None, 20000)"]
    assert "Exchange SinglePartition" not in plan(ranked.groupBy("k").count())
    assert "Window" not in plan(both)


def test_supplied_queries_use_the_filter(spark):
    from facets.plans.supplied import QUERIES

    for name in ("duplicates_of_many", "topk_of_many"):
        p = plan(QUERIES[name](spark, SF001))
        assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p, name
