"""Bins by halving, CSV files with faults, file statistics, structure with values, number guard."""

import math
import os
import random

import pytest
from conftest import SF001, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from facets.functions import REFERENCE_BINS, SEASONS, Bin, bin_column, bin_lookup, bins_lookup, bins_of_table, number_of
from facets.functions.binning import _regions
from facets.operators import structure_with_values
from facets.sources import FAILED_CASTS, file_statistics, load_checked_csv, record_faults


def holds(b, x):
    return (x >= b.low if b.low_closed else x > b.low) and (x <= b.high if b.high_closed else x < b.high)


bins = st.builds(lambda lo, width, a, b, name: Bin(name, lo, lo + width, a, b),
                 st.integers(-6, 6), st.integers(0, 5), st.booleans(), st.booleans(), st.text(alphabet="aé,;|\x01\\ ", max_size=3))


@settings(max_examples=300, deadline=None)
@given(st.lists(bins, max_size=7))
def test_regions_hold_what_the_bins_hold(spec):
    ends, held = _regions(spec)
    for i in range(2 * len(ends) + 1):
        x = ends[i // 2] if i % 2 else (ends[i // 2] - 0.25 if i < 2 * len(ends) else (ends[-1] + 1 if ends else 0.0))
        if i % 2 == 0 and 0 < i < 2 * len(ends):
            x = (ends[i // 2 - 1] + ends[i // 2]) / 2
        assert held[i] == [n for n, b in enumerate(spec) if holds(b, x)]


def test_lookup_agrees_with_the_case_chain(spark):
    rng = random.Random(3)
    specs = [REFERENCE_BINS, SEASONS, ()]
    for _ in range(3):
        specs.append(tuple(Bin(rng.choice(["a", "b,c", "d;e", "é\\"]), lo := rng.randrange(-5, 9), lo + rng.randrange(4), rng.random() < 0.5, rng.random() < 0.5)
                           for _ in range(rng.randrange(1, 12))))
    values = [None, math.nan, math.inf, -math.inf, -0.0, 1e300, *[x / 2 for x in range(-14, 60)]]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for spec in specs:
        want = [(None if x is None or math.isnan(x) else next((b.label for b in spec if holds(b, x)), None),
                 None if x is None else [] if math.isnan(x) else [b.label for b in spec if holds(b, x)]) for x in values]
        got = rows(df.select(bin_lookup("x", spec).alias("first"), bins_lookup("x", spec).alias("all")))
        assert got == want
        if spec:
            plain = rows(df.where("not isnan(x)").select(bin_column("x", spec)))
            assert plain == rows(df.where("not isnan(x)").select(bin_lookup("x", spec)))


def test_a_thousand_bins_are_one_expression(spark):
    """No join, and a plan whose size does not grow like a CASE chain's."""
    table = spark.range(1000).select(F.col("id").alias("nr"), F.concat(F.lit("b"), "id").alias("label"), (F.col("id") * 3).alias("low"),
                                     (F.col("id") * 3 + 2).alias("high"))
    spec = bins_of_table(table.union(table.limit(1).selectExpr("nr", "cast(null as string)", "low", "high")), "label", "low", "high", "nr")
    assert len(spec) == 1000
    df = spark.range(0, 3100).select(F.col("id").cast("int").alias("x"))
    out = df.select("x", bin_lookup("x", spec).alias("bin"))
    assert all(r.bin == (f"b{r.x // 3}" if r.x % 3 and r.x < 3000 else None) for r in out.collect())
    p = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in p and "CASE" in p and p.count("CASE") < 12


# --- CSV -----------------------------------------------------------------------------------------

SCHEMA = "k bigint, d date, t string, x double"
FAULTY = '''k,d,t,x
1,2020-01-02,plain,1.5
2,2020-01-03,"two
lines",2
3,2020-01-04,"a ""quoted"", word",3
4,2020-01-05,short
5,2020-01-06,long,5,extra,more
six,2020-01-07,bad number,6
7,07/01/2020,bad date,7
8,2020-13-01,both,eight
,,,
"9","2020-01-09","ends in blank ",9
10,2020-01-10,Infinity,Infinity
'''


def test_every_record_is_accounted_for(spark, tmp_path):
    path = tmp_path / "f.csv"
    path.write_text(FAULTY)
    df = load_checked_csv(spark, str(path), SCHEMA, date_columns=("d",))
    found = {r.t: r for r in df.collect()}
    assert df.count() == 11
    assert found["two\nlines"].k == 2 and found['a "quoted", word'].x == 3.0 and found["Infinity"].x == math.inf
    assert found["short"]._bad_record == "4,2020-01-05,short" and found["short"].k == 4
    assert found["long"]._bad_record == "5,2020-01-06,long,5,extra,more" and found["long"].x == 5.0
    assert found["bad number"][FAILED_CASTS] == ["k"] and found["bad date"][FAILED_CASTS] == ["d"]
    assert found["both"][FAILED_CASTS] == ["d", "x"] and found[None][FAILED_CASTS] == [] and found[None]._bad_record is None
    assert dict(rows(record_faults(df))) == {"none": 6, "fields": 2, "cast:k": 1, "cast:d": 1, "cast:d,x": 1}
    # the same counts when only they are asked for: no field is pruned away before records are checked
    assert df.where("_bad_record is not null").count() == 2


def test_files_with_another_header_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,d,t,x\n1,2020-01-01,a,1\n")
    (tmp_path / "b.csv").write_text("k,t,d,x\n1,a,2020-01-01,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        load_checked_csv(spark, str(tmp_path), SCHEMA, date_columns=("d",)).collect()


def test_empty_file_and_extra_columns(spark, tmp_path):
    path = tmp_path / "e.csv"
    path.write_text("z,k,d,t,x,y\n")
    assert load_checked_csv(spark, str(path), SCHEMA, date_columns=("d",)).count() == 0
    path.write_text("z,k,d,t,x,y\n0,1,2020-01-01,a,2,\n")
    one = load_checked_csv(spark, str(path), SCHEMA, date_columns=("d",), multi_line=False)
    assert one.columns == ["k", "d", "t", "x", "_failed_casts", "_bad_record"] and one.first().x == 2.0


# --- file statistics ---------------------------------------------------------------------------------

def test_statistics_come_from_the_footers(spark):
    path = os.path.join(SF001, "lineitem.parquet")
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    df = file_statistics(spark, path, ["l_orderkey", "l_linenumber", "l_quantity"])
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)" in p and "MIN(l_orderkey)" in p
    li = spark.read.parquet(path)
    for r in df.collect():
        want = li.agg(F.count(F.lit(1)), F.count_if(F.col(r.column_name).isNull()), F.min(r.column_name).cast("string"), F.max(r.column_name).cast("string"))
        assert tuple(r)[1:] == tuple(want.first())
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before


def test_a_filter_takes_the_ordinary_plan(spark):
    path = os.path.join(SF001, "orders.parquet")
    df = file_statistics(spark, path, ["o_orderkey", "o_orderstatus"], where="o_custkey > 20")
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "COUNT(" not in p.split("PushedAggregation")[-1][:40]
    o = spark.read.parquet(path).where("o_custkey > 20")
    got = {r.column_name: tuple(r)[1:] for r in df.collect()}
    for c in ("o_orderkey", "o_orderstatus"):
        assert got[c] == tuple(o.agg(F.count(F.lit(1)), F.count_if(F.col(c).isNull()), F.min(c).cast("string"), F.max(c).cast("string")).first())


# --- structure, numbers -------------------------------------------------------------------------------

def test_structure_with_values(spark):
    df = spark.createDataFrame([(2, "b", None), (None, "n", 1.5), (1, None, 2.5), (3, "c", 0.0)], "k int, `odd name` string, x double")
    assert rows(structure_with_values(df, ["k"], 3)) == [
        (1, "k", "int", [None, "1", "2"]), (2, "odd name", "string", ["n", None, "b"]), (3, "x", "double", ["1.5", "2.5", None])]
    assert [r.first_values for r in structure_with_values(df.limit(0), ["k"]).collect()] in ([[], [], []], [])


NUMBERS = ["0", " 12 ", "+1.5", "-.5e3", ".", "-", "", "abc", "1e", "Infinity", "-inf", "+INF", "NaN", "nan", "1d", "2f", "0x1p3", "١", "\t7\n", "1,000", "12abc",
           "infinit", "e5", "--1", "9" * 400, None]


def test_guard_changes_no_cast(spark):
    df = spark.createDataFrame([(t,) for t in NUMBERS], "t string")
    for kind in ("double", "int", "bigint", "decimal(10,2)"):
        got = rows(df.select(number_of(F.col("t"), kind).cast("string"), F.col("t").try_cast(kind).cast("string")))
        assert all(a == b for a, b in got), [(t, g) for t, g in zip(NUMBERS, got, strict=True) if g[0] != g[1]]


@settings(max_examples=20, deadline=None)
@given(texts=st.lists(st.text(alphabet="0123456789+-.eEinfINFaNdDx \t  ", max_size=6), min_size=30, max_size=60))
def test_guard_changes_no_cast_of_random_text(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert df.where(~number_of(F.col("t")).eqNullSafe(F.col("t").try_cast("double"))).count() == 0
