"""Bins from a table longer than an expression may list."""

import math
import random
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from facets.functions.binning import MOST_BINS
from facets.operators import each_bin, first_bin
from facets.plans.supplied import QUERIES

ENDS = [-math.inf, -1e300, -70.25, -8.0, -1.0, -5e-324, -0.0, 5e-324, 0.1, 0.3, 1.0, 2.0, 7.0, 64.0, 1e5, 1e16, 1.7e308, math.inf]
VALUES = [None, math.nan, *ENDS, *ENDS, 1e16 + 2, 3.5, 0.2, 99999.99, -70.0, 1e-300]


def holds(b, x, low_closed, high_closed):
    if x is None or math.isnan(x) or None in b[1:4]:
        return False
    return (x >= b[2] if low_closed else x > b[2]) and (x <= b[3] if high_closed else x < b[3])


def odd_bins(spark, seed):
    """(order, label, low, high): nulls, repeats, equal, infinite and turned ends."""
    rng = random.Random(seed)
    some = [(rng.choice([None, 1, 2, 3]), rng.choice([None, "a", "b", "c,d"]), rng.choice([None, *ENDS]), rng.choice([None, *ENDS])) for _ in range(60)]
    some += [(5, "point", x, x) for x in ENDS] + [(6, f"n{i}", i * 0.1, i * 0.1 + 0.25) for i in range(30)]
    some += some[:10]
    return some, spark.createDataFrame(some, "nr int, label string, low double, high double")


@pytest.mark.parametrize("low_closed, high_closed", [(False, True), (True, True), (True, False)])
def test_each_bin_joined_or_listed(spark, low_closed, high_closed):
    some, bins = odd_bins(spark, 1)
    df = spark.createDataFrame(list(enumerate(VALUES)), "k int, x double")
    want = Counter((k, x, b[1]) for k, x in enumerate(VALUES) for b in some if holds(b, x, low_closed, high_closed))
    for most in (0, 10_000):
        out = each_bin(df, "x", bins, "label", "low", "high", "nr", name="bin", low_closed=low_closed, high_closed=high_closed, most_listed=most)
        assert out.columns == ["k", "x", "bin"] and Counter(rows(out)) == want


@pytest.mark.parametrize("low_closed, high_closed", [(False, True), (True, True), (False, False)])
def test_first_bin_joined_or_listed(spark, low_closed, high_closed):
    some, bins = odd_bins(spark, 2)
    df = spark.createDataFrame(list(enumerate([*VALUES, None, 3.5])), "k int, x double")
    ordered = sorted((b for b in some if b[1] is not None), key=lambda b: (b[0] is not None, b[0] or 0, b[1]))
    want = [(k, x, next((b[1] for b in ordered if holds(b, x, low_closed, high_closed)), None)) for k, x in rows(df)]
    for most in (0, 10_000):
        out = first_bin(df, "x", bins, "label", "low", "high", "nr", low_closed=low_closed, high_closed=high_closed, most_listed=most)
        assert out.columns == ["k", "x", "bin"] and list(map(str, rows(out.orderBy("k")))) == list(map(str, want))


def test_first_bin_without_bins_or_values(spark):
    bins = spark.createDataFrame([(1, "a", 5.0, 2.0)], "nr int, label string, low double, high double")
    df = spark.createDataFrame([(1.0,), (3.0,), (3.0,)], "x double")
    for most in (0, 10):
        for b in (bins, bins.limit(0)):
            assert sorted(rows(first_bin(df, "x", b, "label", "low", "high", "nr", most_listed=most))) == [(1.0, None), (3.0, None), (3.0, None)]
        assert rows(first_bin(df.limit(0), "x", bins, "label", "low", "high", "nr", most_listed=most)) == []


def test_each_bin_without_bins_or_values(spark):
    bins = spark.createDataFrame([(1, "a", 5.0, 2.0)], "nr int, label string, low double, high double")
    df = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    for most in (0, 10):
        assert rows(each_bin(df, "x", bins, "label", "low", "high", "nr", most_listed=most)) == []
        assert rows(each_bin(df, "x", bins.limit(0), "label", "low", "high", "nr", most_listed=most)) == []
        assert rows(each_bin(df.limit(0), "x", bins, "label", "low", "high", "nr", most_listed=most)) == []


@pytest.fixture(scope="module")
def many_customers(spark, tmp_path_factory):
    """More customers, so more bins, than a lookup may hold; their names come twice."""
    at = str(tmp_path_factory.mktemp("many"))
    n = MOST_BINS + 5_000
    (spark.range(n).select(F.col("id").alias("c_custkey"), F.concat(F.lit("c"), F.col("id") % (n - 7)).alias("c_name"))
     .write.parquet(f"{at}/customer.parquet"))
    prices = [None, math.nan, -1.0, 0.0, 50.0, 60.0, 75.0, 75.5, 100.0, 100.0, 120.0, 50.0 * n + 25, 50.0 * n + 26, 1e9]
    spark.createDataFrame([(p,) for p in prices], "l_extendedprice double").write.parquet(f"{at}/lineitem.parquet")
    return at, n, prices


def test_overlapping_bin_counts_of_more_bins_than_a_lookup_holds(spark, many_customers):
    at, n, prices = many_customers
    real = [p for p in prices if p is not None and not math.isnan(p)]
    near = {k for p in real for k in range(int(p // 50) - 2, int(p // 50) + 2) if 0 <= k < n}
    want = Counter(f"c{k % (n - 7)}" for p in real for k in near if k * 50 < p <= k * 50 + 75)
    assert dict(rows(QUERIES["overlapping_bin_counts"](spark, at))) == want


def test_table_bin_counts_of_more_bins_than_a_lookup_holds(spark, many_customers):
    at, n, prices = many_customers
    want = Counter()
    for p in prices:
        near = range(int(p // 50) - 2, int(p // 50) + 2) if p is not None and not math.isnan(p) else ()
        want[next((f"c{k % (n - 7)}" for k in near if 0 <= k < n and k * 50 < p <= k * 50 + 75), None)] += 1
    assert dict(rows(QUERIES["table_bin_counts"](spark, at))) == want
