"""Property tests."""

from conftest import SF001, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from facets.functions import REFERENCE_BINS, bin_column, parse_clock12
from facets.operators import frequency, top_k, top_k_per_group
from facets.sources import read_table


def reference_hour(text):
    """The reference's arithmetic in plain Python (chars 1-2 as a number,
    +12 when chars 5-6 are exactly "P", 24 -> 0, outside 0..23 -> missing)."""
    if text is None:
        return None
    try:
        h = float(text[0:2])
    except ValueError:
        return None
    h += 12.0 if text[4:6] == "P" else 0.0
    if h == 24:
        h = 0.0
    return h if 0 <= h <= 23 else None


@settings(max_examples=30, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="0123456789AP.+-", max_size=7)), min_size=1, max_size=40))
def test_as_written_clock_matches_model(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(parse_clock12("t")).collect()]
    assert got == [reference_hour(t) for t in texts]


def test_population_invariants(spark):
    ev = read_table(spark, SF001, "events")
    b = ev.select(F.hour("ts").alias("h"), "event_type", bin_column(F.hour("ts"), REFERENCE_BINS).alias("bin"))
    total = ev.count()
    bins = rows(frequency(b.where(F.col("bin").isNotNull()), "bin"))
    assert sum(n for _, n in bins) == b.where(F.col("bin").isNotNull()).count() <= total
    nulls = b.where(F.col("bin").isNull()).count()
    assert nulls + sum(n for _, n in bins) == total
    top = rows(top_k(ev, "event_type", 3))
    assert sum(n for _, n in top) <= total
    per = rows(top_k_per_group(b, "bin", "event_type", 2))
    for bin_, et, n, rank in per:
        sliced = rows(top_k(b.where(F.col("bin") == bin_), "event_type", 2))
        assert sliced[rank - 1] == (et, n)
    shuffled = rows(top_k_per_group(b.repartition(5, "event_type"), "bin", "event_type", 2))
    assert sorted(map(str, per)) == sorted(map(str, shuffled))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(-5, 30), min_size=2, max_size=7, unique=True),
       st.lists(st.sampled_from([x / 2 for x in range(-12, 64)]), min_size=1, max_size=30),
       st.booleans())
def test_bin_spec_spark_duckdb_python_agree(spark, edges, values, first_closed):
    import duckdb

    from facets.functions import Bin, bin_case_sql

    edges = sorted(edges)
    spec = tuple(Bin(f"b{i}", lo, hi, low_closed=(first_closed and i == 0))
                 for i, (lo, hi) in enumerate(zip(edges, edges[1:])))

    def py(v):
        for b in spec:
            lo_ok = v >= b.low if b.low_closed else v > b.low
            hi_ok = v <= b.high if b.high_closed else v < b.high
            if lo_ok and hi_ok:
                return b.label
        return None

    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = [r[0] for r in df.select(bin_column("v", spec)).collect()]
    con = duckdb.connect()
    duck = [r[0] for r in con.execute(
        f"SELECT {bin_case_sql('v', spec)} FROM (SELECT unnest(?::DOUBLE[]) AS v)", [values]).fetchall()]
    assert got == duck == [py(v) for v in values]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="0123456789AP.", max_size=6)), min_size=1, max_size=40),
       st.sampled_from(["as_written", "standard"]))
def test_clock_sql_twin_agrees_with_spark(spark, texts, policy):
    import duckdb

    from facets.functions import clock12_sql

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(parse_clock12("t", policy)).collect()]
    con = duckdb.connect()
    duck = [r[0] for r in con.execute(
        f"SELECT {clock12_sql('t', policy)} FROM (SELECT unnest(?::VARCHAR[]) AS t)", [texts]).fetchall()]
    assert got == duck
