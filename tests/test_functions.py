"""Column functions: clock parsing (S7, S8), bins (S9), ANSI-safe compare."""

from conftest import rows
from pyspark.sql import functions as F

from facets.functions import (
    EQUAL_4H_BINS,
    REFERENCE_BINS,
    SEASONS,
    bin_column,
    in_year,
    matches,
    parse_clock12,
)

CASES = [  # text, as_written, standard
    ("0143A", 1.0, 1), ("0930P", 21.0, 21), ("1230P", 0.0, 12), ("1215A", 12.0, 0),
    ("1530A", 15.0, None), ("1530P", None, None), ("0A43", None, None), ("0500P", 17.0, 17),
    ("0645A", 6.0, 6), (None, None, None), ("1200P", 0.0, 12), ("1200A", 12.0, 0), ("0099A", 0.0, None),
    ("07", 7.0, None), ("0700X", 7.0, None),
]


def test_clock_policies(spark):
    df = spark.createDataFrame([(t,) for t, _, _ in CASES], "t string")
    got = rows(df.select("t", parse_clock12("t", "as_written"), parse_clock12("t", "standard")))
    assert got == CASES


def test_reference_bins_edges(spark):
    hours = [0, 4, 4.5, 5, 6, 7, 11, 12, 16, 17, 20, 21, 23, 24, -1]
    df = spark.createDataFrame([(float(h),) for h in hours], "h double")
    got = [r[0] for r in rows(df.select(bin_column("h", REFERENCE_BINS)))]
    assert got == ["Midnight", "Midnight", "Early Morning", "Early Morning", "Early Morning", "Morning",
                   "Morning", "Afternoon", "Afternoon", "Evening", "Evening", "Night", "Night", None, None]


def test_seasons_and_equal_bins(spark):
    df = spark.range(0, 14).select(F.col("id").cast("int").alias("m"))
    got = [r[0] for r in rows(df.select(bin_column("m", SEASONS)))]
    assert got == [None, "Winter", "Winter", "Winter", "Summer", "Summer", "Summer", "Rainy", "Rainy",
                   "Rainy", "Rainy", "Winter", "Winter", None]
    assert [b.label for b in EQUAL_4H_BINS] == ["00-04", "04-08", "08-12", "12-16", "16-20", "20-24"]
    h = spark.range(0, 24).select(F.col("id").cast("int").alias("h"))
    counts = dict(rows(h.groupBy(bin_column("h", EQUAL_4H_BINS).alias("b")).count()))
    assert set(counts.values()) == {4} and len(counts) == 6


def test_matches_is_ansi_safe(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    df = spark.createDataFrame([("0",), ("000",), ("ABC",), (None,), ("0.0",)], "p string")
    assert df.where(matches(df, "p", 0)).count() == 3


def test_in_year_pushes_down(spark, tmp_path):
    import datetime as dt
    df = spark.createDataFrame([(dt.date(2017, 1, 1),), (dt.date(2016, 12, 31),), (dt.date(2018, 1, 1),)], "d date")
    p = str(tmp_path / "d")
    df.write.parquet(p)
    back = spark.read.parquet(p)
    q = back.where(in_year(back, "d", 2017))
    assert q.count() == 1
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(d), GreaterThanOrEqual(d,2017-01-01), LessThan(d,2018-01-01)]" in plan


def test_with_bound_columns_keeps_order_and_replaces(spark):
    from facets.operators import with_bound_columns

    df = spark.createDataFrame([(1, "0143A"), (2, "x")], "id int, t string")
    out = with_bound_columns(df, {"t": F.upper("t"), "h": parse_clock12("t")})
    assert out.columns == ["id", "t", "h"]
    assert rows(out) == [(1, "0143A", 1.0), (2, "X", None)]
    # filters on bound columns stay above the generator; others reach the source
    q = out.where(F.col("h").isNotNull() & (F.col("id") > 0))
    plan = q._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter isnotnull(h") < plan.index("Generate")
    assert rows(q) == [(1, "0143A", 1.0)]
