"""Ranking family: ties, NULL keys, per-group top-k, argmax, restriction."""

from conftest import rows
from pyspark.sql import functions as F

from facets.operators import (
    bottom_k,
    common_keys,
    frequencies,
    frequency,
    mode_group,
    restrict_to_top_keys,
    top_k,
    top_k_in_top_groups,
    top_k_per_group,
)


def _df(spark):
    data = [("a", "x"), ("a", "x"), ("a", "y"), ("b", "x"), ("b", "y"), ("b", "y"), ("c", None),
            (None, "x"), (None, "y")]
    return spark.createDataFrame(data, "k string, g string")


def test_count_rows_vs_key(spark):
    df = _df(spark)
    by_rows = dict(rows(frequency(df, "k")))
    by_key = dict(rows(frequency(df, "k", count="key")))
    assert by_rows[None] == 2 and by_key[None] == 0          # S1
    both = {r[0]: (r[1], r[2]) for r in rows(frequency(df, "k", {"nk": "key", "nr": "rows"}))}
    assert both[None] == (0, 2) and both["a"] == (3, 3)


def test_top_and_bottom_ties_break_on_key(spark):
    df = _df(spark)
    assert rows(top_k(df, "k", 2)) == [("a", 3), ("b", 3)]
    assert rows(bottom_k(df, "k", 2)) == [("c", 1), (None, 2)]
    assert rows(top_k(df, "g", 1)) == [("x", 4)]


def test_top_k_per_group_equals_slice_then_top_k(spark):
    df = _df(spark).where(F.col("k").isNotNull())
    per = top_k_per_group(df, "k", "g", 1)
    got = {r["k"]: (r["g"], r["n"], r["rank"]) for r in per.collect()}
    for k in ("a", "b", "c"):
        (g, n), = rows(top_k(df.where(F.col("k") == k), "g", 1))
        assert got[k] == (g, n, 1)


def test_top_k_in_top_groups_and_common_keys(spark):
    data = [(s, c) for s, c, n in [(1, 10, 5), (1, 11, 3), (1, 12, 1), (2, 10, 4), (2, 12, 2), (3, 10, 1),
                                   (3, 11, 1), (4, 13, 1)] for _ in range(n)]
    df = spark.createDataFrame(data, "s long, c int")
    r = top_k_in_top_groups(df, "s", "c", 2, 2)
    assert sorted(rows(r)) == [(1, 10, 5, 1), (1, 11, 3, 2), (2, 10, 4, 1), (2, 12, 2, 2)]
    assert rows(common_keys(r, "s", "c")) == [(10, 2)]


def test_mode_group_tie_takes_smallest_group(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "z"), (2, "z"), (2, "a")], "k int, g string")
    assert sorted(rows(mode_group(df, "k", "g"))) == [(1, "a", 1), (2, "z", 2)]


def test_restrict_to_top_keys(spark):
    df = _df(spark)
    kept = restrict_to_top_keys(df, "k", 2)
    assert sorted(r[0] for r in rows(kept, "k")) == ["a"] * 3 + ["b"] * 3


def test_frequencies_one_scan_matches_separate(spark):
    df = _df(spark)
    long = {(c, v): n for c, v, n in rows(frequencies(df, ["k", "g"]))}
    for c in ("k", "g"):
        for v, n in rows(frequency(df, c)):
            assert long[(c, v)] == n


def test_partitioning_does_not_change_results(spark):
    df = _df(spark)
    a = sorted(map(str, rows(top_k_per_group(df, "k", "g", 2))))
    b = sorted(map(str, rows(top_k_per_group(df.repartition(7), "k", "g", 2))))
    assert a == b


def test_top_k_per_group_has_one_shape(spark):
    df = spark.createDataFrame([(g, c) for g, c, n in [(1, 10, 5), (1, 11, 3), (1, 12, 3), (1, 13, 1), (2, 10, 2),
                                                       (2, 14, 2)] for _ in range(n)], "g int, c int")
    for k in (3, 5000):
        for slices in (1, 64):
            got = top_k_per_group(df, "g", "c", k, slices=slices)
            assert "xxhash64" in got._jdf.queryExecution().optimizedPlan().toString()
            first = [r for r in rows(got.orderBy("g", "rank")) if r[3] <= 3]
            assert first == [(1, 10, 5, 1), (1, 11, 3, 2), (1, 12, 3, 3), (2, 10, 2, 1), (2, 14, 2, 2)]


def test_null_groups_and_keys_count(spark):
    df = spark.createDataFrame([(None, "a")] * 3 + [(None, None)] * 2 + [("x", "a")] * 3 + [("y", None)] * 2, "g string, c string")
    top = top_k_in_top_groups(df, "g", "c", 2, 2)
    assert sorted(rows(top), key=str) == [("x", "a", 3, 1), (None, "a", 3, 1), (None, None, 2, 2)]
    assert rows(common_keys(top, "g", "c")) == [("a", 2)]
    assert restrict_to_top_keys(df, "g", 2).count() == 8
    cube = frequency(df, ["g", "c"])
    assert sorted(rows(top_k_in_top_groups(cube, "g", "c", 2, 2, by="n")), key=str) == sorted(rows(top), key=str)


def test_cube_answers_equal_direct_answers(spark):
    from conftest import SF001

    from facets.operators import priced_top_k, total_of_top_k
    from facets.plans.supplied import binned_events

    b = binned_events(spark, SF001)
    cube = frequency(b, ["time_bin", "event_type"])

    def same(x, y):
        assert sorted(map(str, rows(x))) == sorted(map(str, rows(y)))

    same(frequency(b, "time_bin", count="event_type"), frequency(cube, "time_bin", count="event_type", by="n"))
    same(frequency(b, "event_type", count="key"), frequency(cube, "event_type", count="key", by="n"))
    same(top_k_per_group(b, "time_bin", "event_type", 2), top_k_per_group(cube, "time_bin", "event_type", 2, by="n"))
    same(top_k_in_top_groups(b, "time_bin", "event_type", 2, 2),
         top_k_in_top_groups(cube, "time_bin", "event_type", 2, 2, by="n"))
    same(frequency(restrict_to_top_keys(b, "event_type", 3), ["time_bin", "event_type"]),
         restrict_to_top_keys(cube, "event_type", 3, by="n"))
    same(mode_group(b, "event_type", "time_bin"), mode_group(cube, "event_type", "time_bin", by="n"))
    rates = {"click": 115, "view": 50}
    same(priced_top_k(b, "event_type", 3, rates), priced_top_k(cube, "event_type", 3, rates, by="n"))
    same(total_of_top_k(b, "event_type", 3), total_of_top_k(cube, "event_type", 3, by="n"))
