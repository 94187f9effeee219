"""Profiles (H1-H9), cleaning (G4-G6) and revenue (G1)."""

from conftest import as_dict, rows

from facets.operators import (
    drop_sentinels,
    duplicates,
    first_rows,
    null_profile,
    priced_top_k,
    replace_sentinel,
    replace_with_mode,
    sentinel_profile,
    shape,
    structure,
    uniqueness,
)


def test_profiles(spark):
    df = spark.createDataFrame([(1, "0", None), (2, "x", 5), (2, None, 0)], "id long, p string, z int")
    assert rows(shape(df)) == [(3, 3)]
    assert as_dict(null_profile(df), "column_name", "n_null") == {"id": 0, "p": 1, "z": 1}
    assert as_dict(sentinel_profile(df, {"p": 0, "z": 0}), "column_name", "n_match") == {"p": 1, "z": 1}
    assert rows(uniqueness(df, "id")) == [(3, 2, False)]
    assert rows(duplicates(df, "id")) == [(2, 2)]
    assert rows(structure(df)) == [(1, "id", "bigint"), (2, "p", "string"), (3, "z", "int")]
    assert rows(first_rows(df, ["z", "id"], 2)) == [(1, "0", None), (2, None, 0)]


def test_drop_sentinels_drops_null_unless_kept(spark):
    df = spark.createDataFrame([(1,), (0,), (None,)], "v int")
    assert drop_sentinels(df, {"v": 0}).count() == 1
    assert drop_sentinels(df, {"v": 0}, keep_null=True).count() == 2


def test_replace_sentinel_and_mode(spark):
    df = spark.createDataFrame([("99",), ("NY",), ("NJ",), ("NJ",), (None,)], "s string")
    assert sorted(map(str, (r[0] for r in rows(replace_sentinel(df, "s", "99", "NY"))))) == \
        ["NJ", "NJ", "NY", "NY", "None"]
    assert sorted(map(str, (r[0] for r in rows(replace_with_mode(df, "s", "99"))))) == \
        ["NJ", "NJ", "NJ", "NY", "None"]


def test_priced_top_k_dict_and_table_agree(spark):
    df = spark.createDataFrame([(c,) for c, n in [(21, 5), (38, 4), (14, 3), (7, 1)] for _ in range(n)], "code int")
    rates = {21: 55, 38: 50, 14: 115}
    a = rows(priced_top_k(df, "code", 3, rates))
    table = spark.createDataFrame(list(rates.items()), "code int, fine int")
    b = rows(priced_top_k(df, "code", 3, table).select("code", "n", "fine", "total_fines"))
    assert sorted(a) == sorted(b) == [(14, 3, 115, 345), (21, 5, 55, 275), (38, 4, 50, 200)]
    partial = {21: 55}
    left = {r[0]: r[3] for r in rows(priced_top_k(df, "code", 3, partial))}
    assert left == {21: 275, 38: None, 14: None}
    assert rows(priced_top_k(df, "code", 3, partial, how="inner"))[0][0] == 21


def test_check_counts_one_aggregate(spark):
    from pyspark.sql import functions as F

    from facets.operators import check_counts

    df = spark.createDataFrame([(1, "0"), (None, "x"), (0, None)], "a int, b string")
    out = check_counts(df, {"a null": F.col("a").isNull(), "a zero": F.col("a") == 0,
                            "b numeric": F.col("b").try_cast("int").isNotNull()})
    assert as_dict(out, "check", "n") == {"a null": 1, "a zero": 1, "b numeric": 1}
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Scan ExistingRDD") + plan.count("LocalTableScan") <= 1   # one pass over the input


def test_two_rates_for_one_key_raise(spark):
    import pytest

    df = spark.createDataFrame([(1,), (1,), (2,)], "code int")
    twice = spark.createDataFrame([(1, 5), (1, 6), (2, 7)], "code int, fine int")
    with pytest.raises(Exception, match="more than one rate"):
        priced_top_k(df, "code", 2, twice).collect()


def test_mode_of_nothing_keeps_the_placeholder(spark):
    df = spark.createDataFrame([("99",), ("99",), (None,)], "s string")
    assert sorted(rows(replace_with_mode(df, "s", "99")), key=str) == [("99",), ("99",), (None,)]


def test_normalize_names_refuses_collisions(spark):
    import pytest

    from facets.sources import normalize_names

    assert normalize_names(spark.createDataFrame([(1, 2)], "`A B` int, c int")).columns == ["A_B", "c"]
    with pytest.raises(ValueError, match="both be named"):
        normalize_names(spark.createDataFrame([(1, 2)], "`A B` int, A_B int"))


def test_failed_casts_are_counted(spark, tmp_path):
    from facets.sources import FAILED_CASTS, load_csv

    path = str(tmp_path / "x.csv")
    with open(path, "w") as f:
        f.write("a,b,d\n1,x,2017-01-02\noops,y,13/45/2017\n,z,\n3,w,bad\n")
    df = load_csv(spark, path, "a int, b string, d date", date_columns=("d",), flag_failed=True)
    assert sorted((r.b, tuple(r[FAILED_CASTS])) for r in df.collect()) == [("w", ("d",)), ("x", ()), ("y", ("a", "d")), ("z", ())]


def test_year_filter_refuses_text_dates(spark):
    import pytest

    from facets.operators import keep_year

    with pytest.raises(TypeError, match="not a date"):
        keep_year(spark.createDataFrame([("01/02/2017",)], "d string"), "d", 2017)
