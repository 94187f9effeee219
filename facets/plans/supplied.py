"""The reference's questions, asked of the supplied tables.

The test data holds no citations table, so each operator runs on an analogue
column (see FIXTURES.md section 2): a precinct is ``l_suppkey`` (it contains
the sentinel 0), a violation code is ``l_linenumber`` / ``event_type`` /
``o_orderpriority``, an issue date is ``o_orderdate``, a violation time is
``events.ts`` written as ``hhmmA`` text. Every query reads whole tables.

Each entry pairs the Spark plan with ANSI SQL that DuckDB runs on the same
Parquet files; output column names and types agree by construction.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from facets.functions import (
    EQUAL_4H_BINS,
    REFERENCE_BINS,
    SEASONS,
    bin_case_sql,
    bin_column,
    clock12_sql,
    parse_clock12,
    with_date_parts,
)
from facets.operators import (
    bottom_k,
    chart_rows,
    common_keys,
    distinct_values,
    drop_incomplete,
    drop_sentinels,
    duplicates,
    first_rows,
    frequencies,
    frequency,
    joined_null_profile,
    keep_year,
    mode_group,
    null_count,
    priced_top_k,
    ranked,
    replace_sentinel,
    replace_with_mode,
    restrict_to_top_keys,
    sentinel_profile,
    shape,
    slice_top_k,
    structure,
    top_k,
    top_k_in_top_groups,
    top_k_per_group,
    total_of_top_k,
    unbinned,
    uniqueness,
    value_range,
    with_bound_columns,
    with_clock_hours,
    year_profile,
)
from facets.sources import (
    load_csv,
    materialize,
    normalize_names,
    read_table,
    register_view,
    rename_prefix,
    shared_dir,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


# The rate table of the revenue question (per event type).
RATES = {"signup": 55, "error": 50, "click": 115}

# The sentinel columns checked on lineitem.
ZERO_CHECKED = ("l_suppkey", "l_partkey", "l_discount", "l_tax", "l_linenumber")


def _count_filter_union(table: str, cols, pred: str, value_name: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, CAST(count(*) FILTER (WHERE {pred.format(c=c)}) AS BIGINT) AS {value_name} "
        f"FROM {table}" for c in cols)


def clock_text(ts: Column | str) -> Column:
    """A timestamp written the citations' way: ``hhmm`` + one of A/P.

    Built from ``hour``/``minute`` (time-zone free on ``timestamp_ntz``)
    rather than ``date_format``, which would pass through the session zone.
    """
    ts = F.col(ts) if isinstance(ts, str) else ts
    h = F.hour(ts)
    h12 = ((h + 11) % 12) + 1
    return F.concat(F.lpad(h12.cast("string"), 2, "0"), F.lpad(F.minute(ts).cast("string"), 2, "0"),
                    F.when(h < 12, F.lit("A")).otherwise(F.lit("P")))


CLOCK_TEXT_SQL = "substr(strftime(ts, '%I%M%p'), 1, 5)"


def binned_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(hour, event_type, time_bin) with incomplete rows dropped."""
    ev = read_table(spark, sf_dir, "events")
    # the hour is computed once a row; bins and dropna above read the value
    ev = with_bound_columns(ev.select("ts", "event_type"), {"hour": F.hour("ts")})
    b = with_bound_columns(ev.select("hour", "event_type"), {"time_bin": bin_column("hour", REFERENCE_BINS)})
    return drop_incomplete(b.select("hour", "event_type", "time_bin"))


BINNED_EVENTS_SQL = f"""
b AS (SELECT hour(ts) AS hour, event_type, {bin_case_sql('hour(ts)', REFERENCE_BINS)} AS time_bin FROM events),
c AS (SELECT * FROM b WHERE hour IS NOT NULL AND event_type IS NOT NULL AND time_bin IS NOT NULL)"""


def seasoned_orders(spark: SparkSession, sf_dir: str, spec=SEASONS) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    month = F.month("o_orderdate")
    return o.select("o_orderkey", month.alias("o_month"), "o_orderpriority",
                    bin_column(month, spec).alias("season"))


SEASONED_ORDERS_SQL = f"""
s AS (SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS o_month, o_orderpriority,
      {bin_case_sql('month(o_orderdate)', SEASONS)} AS season FROM orders)"""


def nonzero_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_sentinels(read_table(spark, sf_dir, "lineitem"), {"l_suppkey": 0})


# --- A: sources, shape -------------------------------------------------------

@query("row_count", "SELECT count(*) AS n_rows, CAST(11 AS INTEGER) AS n_cols FROM lineitem")
def q_row_count(spark, sf_dir):
    return shape(read_table(spark, sf_dir, "lineitem"))


@query("rename", "SELECT r_regionkey AS region_regionkey, r_name AS region_name FROM region")
def q_rename(spark, sf_dir):
    return rename_prefix(read_table(spark, sf_dir, "region"), "r_", "region_")


# --- H: profiles ----------------------------------------------------------------

@query("year_profile", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS o_year, count(year(o_orderdate)) AS n
FROM orders GROUP BY 1""")
def q_year_profile(spark, sf_dir):
    return year_profile(read_table(spark, sf_dir, "orders"), "o_orderdate", name="o_year")


@query("year_filter", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS o_year, count(year(o_orderdate)) AS n
FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'
GROUP BY 1""")
def q_year_filter(spark, sf_dir):
    o = keep_year(read_table(spark, sf_dir, "orders"), "o_orderdate", 1998)
    return year_profile(o, "o_orderdate", name="o_year")


_NULL_COLS = ("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic")


@query("null_profile", "WITH j AS (SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic "
       "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)\n"
       + _count_filter_union("j", _NULL_COLS, "{c} IS NULL", "n_null"))
def q_null_profile(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    labels = read_table(spark, sf_dir, "labels")
    # Join strategy is Catalyst's: labels grows with the data, so no forced broadcast.
    return joined_null_profile(docs, labels, "doc_id", _NULL_COLS)


@query("zero_profile", _count_filter_union("lineitem", ZERO_CHECKED, "{c} = 0", "n_match"))
def q_zero_profile(spark, sf_dir):
    return sentinel_profile(read_table(spark, sf_dir, "lineitem"), {c: 0 for c in ZERO_CHECKED})


@query("placeholder_count", _count_filter_union("orders", ["o_orderpriority"],
                                                "{c} = '4-NOT SPECIFIED'", "n_match"))
def q_placeholder_count(spark, sf_dir):
    return sentinel_profile(read_table(spark, sf_dir, "orders"), {"o_orderpriority": "4-NOT SPECIFIED"})


@query("distinct_vs_total", """
SELECT count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_distinct,
       count(*) = count(DISTINCT o_orderkey) AS is_unique FROM orders""")
def q_distinct_vs_total(spark, sf_dir):
    return uniqueness(read_table(spark, sf_dir, "orders"), "o_orderkey")


@query("duplicates", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def q_duplicates(spark, sf_dir):
    return duplicates(read_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("date_range", """
SELECT CAST(min(o_orderdate) AS DATE) AS min_value, CAST(max(o_orderdate) AS DATE) AS max_value FROM orders""")
def q_date_range(spark, sf_dir):
    """Date coverage, as dates."""
    return value_range(read_table(spark, sf_dir, "orders"), "o_orderdate", as_type="date")


@query("distinct_values", "SELECT count(DISTINCT p_type) AS n_distinct FROM part")
def q_distinct_values(spark, sf_dir):
    return distinct_values(read_table(spark, sf_dir, "part"), "p_type")


@query("time_null_check", "SELECT count(*) FILTER (WHERE ts IS NULL) AS n_null FROM events")
def q_time_null_check(spark, sf_dir):
    return null_count(read_table(spark, sf_dir, "events"), "ts")


@query("date_parts", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS o_year,
       CAST(month(o_orderdate) AS INTEGER) AS o_month FROM orders""")
def q_date_parts(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return with_date_parts(o, "o_orderdate", {"o_year": "year", "o_month": "month"}).drop("o_orderdate")


# --- G/C: cleaning ---------------------------------------------------------------

@query("sentinel_filter", """
SELECT l_suppkey, count(*) AS n FROM lineitem
WHERE l_suppkey <> 0 AND l_partkey <> 0 AND l_discount <> 0 GROUP BY l_suppkey""")
def q_sentinel_filter(spark, sf_dir):
    li = drop_sentinels(read_table(spark, sf_dir, "lineitem"), {"l_suppkey": 0, "l_partkey": 0, "l_discount": 0})
    return frequency(li, "l_suppkey")


@query("count_key_nullgroup", """
SELECT NULLIF(o_orderstatus, 'P') AS o_orderstatus, count(NULLIF(o_orderstatus, 'P')) AS n_key,
       count(*) AS n_rows FROM orders GROUP BY 1""")
def q_count_key_nullgroup(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select(F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"))
    return frequency(o, "o_orderstatus", {"n_key": "key", "n_rows": "rows"})


@query("sentinel_to_mode", """
WITH m AS (SELECT o_orderpriority AS v FROM orders
           WHERE o_orderpriority <> '4-NOT SPECIFIED' AND o_orderpriority IS NOT NULL
           GROUP BY o_orderpriority ORDER BY count(*) DESC, o_orderpriority ASC NULLS FIRST LIMIT 1)
SELECT CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN (SELECT v FROM m) ELSE o_orderpriority END
       AS o_orderpriority, count(*) AS n
FROM orders GROUP BY 1""")
def q_sentinel_to_mode(spark, sf_dir):
    o = replace_with_mode(read_table(spark, sf_dir, "orders"), "o_orderpriority", "4-NOT SPECIFIED")
    return frequency(o, "o_orderpriority")


@query("clean_topk", """
SELECT l_linenumber, count(*) AS n FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1995-01-01' AND l_shipdate < TIMESTAMP '1996-01-01'
  AND l_suppkey <> 0 AND l_partkey <> 0
GROUP BY l_linenumber ORDER BY n DESC, l_linenumber ASC NULLS FIRST LIMIT 5""")
def q_clean_topk(spark, sf_dir):
    li = keep_year(read_table(spark, sf_dir, "lineitem"), "l_shipdate", 1995)
    li = drop_sentinels(li, {"l_suppkey": 0, "l_partkey": 0})
    return top_k(li, "l_linenumber", 5)


# --- D11: clock text -------------------------------------------------------------

@query("clock12_hours", f"""
WITH c AS (SELECT {CLOCK_TEXT_SQL} AS t FROM events)
SELECT {clock12_sql('t', 'as_written')} AS hour, count(*) AS n FROM c GROUP BY 1""")
def q_clock12_hours(spark, sf_dir):
    t = read_table(spark, sf_dir, "events").select(clock_text("ts").alias("t"))
    return frequency(t.select(parse_clock12("t", "as_written").alias("hour")), "hour")


@query("clock12_standard", f"""
WITH c AS (SELECT {CLOCK_TEXT_SQL} AS t FROM events)
SELECT {clock12_sql('t', 'standard')} AS hour, count(*) AS n FROM c GROUP BY 1""")
def q_clock12_standard(spark, sf_dir):
    t = read_table(spark, sf_dir, "events").select(clock_text("ts").alias("t"))
    return frequency(t.select(parse_clock12("t", "standard").alias("hour")), "hour")


@query("clock_bin_counts", f"""
WITH c AS (SELECT {CLOCK_TEXT_SQL} AS t, event_type FROM events),
h AS (SELECT {clock12_sql('t', 'as_written')} AS hour, event_type FROM c),
b AS (SELECT hour, event_type, {bin_case_sql('hour', REFERENCE_BINS)} AS time_bin FROM h)
SELECT time_bin, count(event_type) AS n FROM b
WHERE hour IS NOT NULL AND event_type IS NOT NULL AND time_bin IS NOT NULL GROUP BY time_bin""")
def q_clock_bin_counts(spark, sf_dir):
    """The reference's own chain: clock text -> hour (as written) -> bins -> dropna -> counts."""
    ev = read_table(spark, sf_dir, "events").select(clock_text("ts").alias("t"), "event_type")
    h = with_clock_hours(ev, "t", "hour", None, "as_written").select("hour", "event_type")
    b = drop_incomplete(h.withColumn("time_bin", bin_column("hour", REFERENCE_BINS)))
    return frequency(b, "time_bin", count="event_type")


# --- F: ranking ---------------------------------------------------------------------

@query("topk", """
SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand
ORDER BY n DESC, p_brand ASC NULLS FIRST LIMIT 5""")
def q_topk(spark, sf_dir):
    return top_k(read_table(spark, sf_dir, "part"), "p_brand", 5)


@query("bottomk", """
SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand
ORDER BY n ASC, p_brand ASC NULLS FIRST LIMIT 5""")
def q_bottomk(spark, sf_dir):
    return bottom_k(read_table(spark, sf_dir, "part"), "p_brand", 5)


@query("slice_topk", """
SELECT l_linenumber, count(*) AS n FROM lineitem WHERE l_suppkey = 19 GROUP BY l_linenumber
ORDER BY n DESC, l_linenumber ASC NULLS FIRST LIMIT 6""")
def q_slice_topk(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return slice_top_k(li, F.col("l_suppkey") == 19, "l_linenumber", 6)


_TOP_GROUPS_SQL = """
WITH li AS (SELECT l_suppkey, l_linenumber FROM lineitem WHERE l_suppkey <> 0),
g AS (SELECT l_suppkey FROM li GROUP BY l_suppkey ORDER BY count(*) DESC, l_suppkey ASC NULLS FIRST LIMIT 3),
p AS (SELECT l_suppkey, l_linenumber, count(*) AS n FROM li WHERE l_suppkey IN (SELECT l_suppkey FROM g)
      GROUP BY l_suppkey, l_linenumber),
r AS (SELECT l_suppkey, l_linenumber, n, CAST(row_number() OVER (PARTITION BY l_suppkey
      ORDER BY n DESC, l_linenumber ASC NULLS FIRST) AS INTEGER) AS "rank" FROM p)"""


@query("topk_in_top_groups", _TOP_GROUPS_SQL + '\nSELECT * FROM r WHERE "rank" <= 6')
def q_topk_in_top_groups(spark, sf_dir):
    return top_k_in_top_groups(nonzero_lineitem(spark, sf_dir), "l_suppkey", "l_linenumber", 3, 6)


@query("common_keys", _TOP_GROUPS_SQL + """,
t AS (SELECT * FROM r WHERE "rank" <= 5)
SELECT l_linenumber, count(DISTINCT l_suppkey) AS n_groups FROM t GROUP BY l_linenumber
HAVING count(DISTINCT l_suppkey) = (SELECT count(DISTINCT l_suppkey) FROM t)""")
def q_common_keys(spark, sf_dir):
    ranked = top_k_in_top_groups(nonzero_lineitem(spark, sf_dir), "l_suppkey", "l_linenumber", 3, 5)
    return common_keys(ranked, "l_suppkey", "l_linenumber")


@query("bin_counts", f"WITH {BINNED_EVENTS_SQL}\nSELECT time_bin, count(event_type) AS n FROM c GROUP BY time_bin")
def q_bin_counts(spark, sf_dir):
    return frequency(binned_events(spark, sf_dir), "time_bin", count="event_type")


@query("bin_counts_equal", f"""
WITH b AS (SELECT {bin_case_sql('hour(ts)', EQUAL_4H_BINS)} AS time_bin, event_type FROM events)
SELECT time_bin, count(event_type) AS n FROM b WHERE time_bin IS NOT NULL GROUP BY time_bin""")
def q_bin_counts_equal(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    b = ev.select(bin_column(F.hour("ts"), EQUAL_4H_BINS).alias("time_bin"), "event_type")
    return frequency(drop_incomplete(b, ["time_bin"]), "time_bin", count="event_type")


_PER_BIN_TOP_SQL = f"""
WITH {BINNED_EVENTS_SQL},
p AS (SELECT time_bin, event_type, count(*) AS n FROM c GROUP BY time_bin, event_type),
r AS (SELECT time_bin, event_type, n, CAST(row_number() OVER (PARTITION BY time_bin
      ORDER BY n DESC, event_type ASC NULLS FIRST) AS INTEGER) AS "rank" FROM p)
SELECT * FROM r WHERE "rank" <= 3"""


@query("per_bin_top_codes", _PER_BIN_TOP_SQL)
def q_per_bin_top_codes(spark, sf_dir):
    return top_k_per_group(binned_events(spark, sf_dir), "time_bin", "event_type", 3)


@query("bins_of_top_codes", f"""
WITH {BINNED_EVENTS_SQL},
t AS (SELECT event_type FROM c GROUP BY event_type ORDER BY count(*) DESC, event_type ASC NULLS FIRST LIMIT 3)
SELECT event_type, time_bin, count(*) AS n FROM c WHERE event_type IN (SELECT event_type FROM t)
GROUP BY event_type, time_bin""")
def q_bins_of_top_codes(spark, sf_dir):
    """From one (type, bin) cube, read once: its totals pick the types. For a
    key with a very large domain, restrict the rows first instead."""
    cube = frequency(binned_events(spark, sf_dir), ["event_type", "time_bin"])
    return restrict_to_top_keys(cube, "event_type", 3, by="n")


@query("mode_group", f"""
WITH {BINNED_EVENTS_SQL},
p AS (SELECT event_type, time_bin, count(*) AS n FROM c GROUP BY event_type, time_bin),
r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY n DESC, time_bin ASC NULLS FIRST) AS rn FROM p)
SELECT event_type, time_bin, n FROM r WHERE rn = 1""")
def q_mode_group(spark, sf_dir):
    return mode_group(binned_events(spark, sf_dir), "event_type", "time_bin")


@query("in_list", f"""
WITH {BINNED_EVENTS_SQL}
SELECT event_type, time_bin, count(*) AS n FROM c WHERE event_type IN ('click', 'view')
GROUP BY event_type, time_bin""")
def q_in_list(spark, sf_dir):
    b = binned_events(spark, sf_dir)
    return frequency(b.where(F.col("event_type").isin("click", "view")), ["event_type", "time_bin"])


@query("unbinned_audit", f"""
SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS o_month,
       {bin_case_sql('month(o_orderdate)', SEASONS[:3])} AS season
FROM orders WHERE ({bin_case_sql('month(o_orderdate)', SEASONS[:3])}) IS NULL""")
def q_unbinned_audit(spark, sf_dir):
    s = seasoned_orders(spark, sf_dir, SEASONS[:3]).select("o_orderkey", "o_month", "season")
    return unbinned(s, "season")


@query("season_counts", f"WITH {SEASONED_ORDERS_SQL}\nSELECT season, count(o_orderpriority) AS n FROM s GROUP BY season")
def q_season_counts(spark, sf_dir):
    return frequency(seasoned_orders(spark, sf_dir), "season", count="o_orderpriority")


_PER_SEASON_TOP_SQL = f"""
WITH {SEASONED_ORDERS_SQL},
p AS (SELECT season, o_orderpriority, count(*) AS n FROM s GROUP BY season, o_orderpriority),
r AS (SELECT season, o_orderpriority, n, CAST(row_number() OVER (PARTITION BY season
      ORDER BY n DESC, o_orderpriority ASC NULLS FIRST) AS INTEGER) AS "rank" FROM p)
SELECT * FROM r WHERE "rank" <= 3"""


@query("per_season_top_codes", _PER_SEASON_TOP_SQL)
def q_per_season_top_codes(spark, sf_dir):
    return top_k_per_group(seasoned_orders(spark, sf_dir), "season", "o_orderpriority", 3)


# --- G1 / E7 / A12: estimates and chart feed ---------------------------------------------

_RATES_SQL = ", ".join(f"('{k}', {v})" for k, v in RATES.items())
_TOP_EVENTS_SQL = """
t AS (SELECT event_type, count(*) AS n FROM events GROUP BY event_type
      ORDER BY n DESC, event_type ASC NULLS FIRST LIMIT 3)"""


@query("revenue", f"""
WITH {_TOP_EVENTS_SQL},
r AS (SELECT * FROM (VALUES {_RATES_SQL}) v(event_type, fine))
SELECT t.event_type, t.n, r.fine, t.n * r.fine AS total_fines FROM t LEFT JOIN r ON t.event_type = r.event_type""")
def q_revenue(spark, sf_dir):
    return priced_top_k(read_table(spark, sf_dir, "events"), "event_type", 3, RATES)


@query("sum_topk", f"WITH {_TOP_EVENTS_SQL}\nSELECT CAST(sum(n) AS BIGINT) AS total FROM t")
def q_sum_topk(spark, sf_dir):
    return total_of_top_k(read_table(spark, sf_dir, "events"), "event_type", 3)


@query("chart_rows", """
WITH t AS (SELECT p_size, count(*) AS n FROM part GROUP BY p_size ORDER BY n DESC, p_size ASC NULLS FIRST LIMIT 6)
SELECT CAST(p_size AS VARCHAR) AS category, n AS value,
       CAST(row_number() OVER (ORDER BY n DESC, p_size ASC NULLS FIRST) AS INTEGER) AS "rank" FROM t""")
def q_chart_rows(spark, sf_dir):
    return chart_rows(read_table(spark, sf_dir, "part"), "p_size", 6)


# --- A2-A4: SQL text over views defined by other queries -----------------------------------

@query("bin_counts_sql", f"WITH {BINNED_EVENTS_SQL}\nSELECT time_bin, count(event_type) AS n FROM c GROUP BY time_bin")
def q_bin_counts_sql(spark, sf_dir):
    """``bin_counts`` the reference's way: SQL text over temp views, a view
    re-registered after ``dropna``. Views are plans, so Catalyst still sees
    one query from scan to aggregate."""
    tag = uuid.uuid4().hex[:12]  # per-call view names: concurrent callers cannot swap views
    register_view(read_table(spark, sf_dir, "events"), f"facets_events_{tag}")
    bins = spark.sql(f"SELECT hour(ts) AS hour, event_type, {bin_case_sql('hour(ts)', REFERENCE_BINS)} "
                     f"AS time_bin FROM facets_events_{tag}")
    register_view(drop_incomplete(bins), f"facets_time_bins_{tag}")
    return spark.sql(f"SELECT time_bin, count(event_type) AS n FROM facets_time_bins_{tag} GROUP BY time_bin")


# --- one scan, several frequency tables ------------------------------

_MULTI_COLS = ("p_brand", "p_type", "p_size")
_MULTI_SQL = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM part GROUP BY {c}"
    for c in _MULTI_COLS)


@query("multi_topk", f"""
WITH f AS ({_MULTI_SQL}),
r AS (SELECT column_name, value, n, CAST(row_number() OVER (PARTITION BY column_name
      ORDER BY n DESC, value ASC NULLS FIRST) AS INTEGER) AS "rank" FROM f)
SELECT * FROM r WHERE "rank" <= 3""")
def q_multi_topk(spark, sf_dir):
    """Top 3 of three columns from a single read of ``part``."""
    long = frequencies(read_table(spark, sf_dir, "part"), _MULTI_COLS)
    return top_k_per_group(long, "column_name", "value", 3, by="n")


# --- A1: CSV source ----------------------------------------------------------------------

@query("csv_source", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS o_year, o_orderpriority, count(*) AS n
FROM orders GROUP BY 1, 2""")
def q_csv_source(spark, sf_dir):
    """Headed CSV read with a declared schema and ``MM/dd/yyyy`` dates.

    The CSV is written by Spark from the whole ``orders`` table into a fresh
    folder under the shared ``spark.checkpoint.dir``, then read back through
    ``load_csv``: no inference pass, dates parsed by layout."""
    path = os.path.join(shared_dir(spark), f"facets-csv-{uuid.uuid4().hex}", "orders")
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format(F.to_date("o_orderdate"), "MM/dd/yyyy").alias("o_orderdate"), "o_orderpriority")
    o.write.option("header", True).csv(path)
    df = load_csv(spark, path, "o_orderkey bigint, o_orderdate date, o_orderpriority string",
                  date_columns=("o_orderdate",), date_formats=("MM/dd/yyyy", "yyyy-MM-dd"))
    return frequency(df.select(F.year("o_orderdate").alias("o_year"), "o_orderpriority"), ["o_year", "o_orderpriority"])


# --- Structured Streaming ------------------------------------------------------------------

@query("stream_per_bin_top_codes", _PER_BIN_TOP_SQL)
def q_stream_per_bin_top_codes(spark, sf_dir):
    """``per_bin_top_codes`` computed by a streaming query: ``events`` read as a
    file stream, a running (bin, type) count cube as the state (bounded by
    bins x types), the ranking published by ``foreachBatch`` into the shared
    folder (fresh per call, checkpoint included) and read back."""
    from facets.streaming import published, start_publishing, table_stream

    out = os.path.join(shared_dir(spark), f"facets-stream-{uuid.uuid4().hex}")
    ev = table_stream(spark, sf_dir, "events")
    hour = F.hour("ts")
    b = drop_incomplete(ev.select(hour.alias("hour"), "event_type", bin_column(hour, REFERENCE_BINS).alias("time_bin")))
    cube = frequency(b, ["time_bin", "event_type"])
    answers = lambda c: {"per_bin_top_codes": top_k_per_group(c, "time_bin", "event_type", 3, by="n")}
    start_publishing(cube, out, answers, checkpoint=os.path.join(out, "_checkpoint")).awaitTermination()
    return published(spark, out, "per_bin_top_codes")


# --- count cubes and key counts -------------------------------------------------------------

@query("cube_answers", f"""
WITH {SEASONED_ORDERS_SQL},
p AS (SELECT season, o_orderpriority, count(*) AS n FROM s GROUP BY season, o_orderpriority),
r AS (SELECT *, row_number() OVER (PARTITION BY season ORDER BY n DESC, o_orderpriority ASC NULLS FIRST) AS k FROM p),
t AS (SELECT o_orderpriority, sum(n) AS n FROM p GROUP BY 1 ORDER BY n DESC, o_orderpriority ASC NULLS FIRST LIMIT 3),
m AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY n DESC, season ASC NULLS FIRST) AS k FROM p)
SELECT 'top of season' AS question, season, o_orderpriority, n FROM r WHERE k <= 3
UNION ALL SELECT 'season total', season, NULL, CAST(sum(n) AS BIGINT) FROM p GROUP BY season
UNION ALL SELECT 'top priority', NULL, o_orderpriority, CAST(n AS BIGINT) FROM t
UNION ALL SELECT 'main season', season, o_orderpriority, n FROM m WHERE k = 1""")
def q_cube_answers(spark, sf_dir):
    """Four questions answered from one (season, priority) count cube, counted
    and checkpointed once (the report's way of working)."""
    cube = materialize(frequency(seasoned_orders(spark, sf_dir), ["season", "o_orderpriority"]))
    none = F.lit(None).cast("string")
    parts = {
        "top of season": top_k_per_group(cube, "season", "o_orderpriority", 3, by="n"),
        "season total": frequency(cube, "season", by="n").withColumn("o_orderpriority", none),
        "top priority": top_k(frequency(cube, "o_orderpriority", by="n"), "o_orderpriority", 3, by="n").withColumn("season", none),
        "main season": mode_group(cube, "o_orderpriority", "season", by="n"),
    }
    out = [df.select(F.lit(name).alias("question"), "season", "o_orderpriority", "n") for name, df in parts.items()]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


@query("topk_key_count", """
SELECT NULLIF(o_orderstatus, 'P') AS o_orderstatus, count(NULLIF(o_orderstatus, 'P')) AS n FROM orders
GROUP BY 1 ORDER BY n DESC, o_orderstatus ASC NULLS FIRST LIMIT 3""")
def q_topk_key_count(spark, sf_dir):
    """Top k counted as ``count(key)``: the NULL key's group counts 0 and ranks last."""
    o = read_table(spark, sf_dir, "orders").select(F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"))
    return top_k(o, "o_orderstatus", 3, count="key")


# --- NULL groups and keys ---------------------------------------------------------------------

def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(quality, lang); quality is NULL for every document without a label."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang")
    return docs.join(read_table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left").select("quality", "lang")


LABELLED_SQL = "d AS (SELECT l.quality, x.lang FROM documents x LEFT JOIN labels l ON x.doc_id = l.doc_id)"


@query("top_groups_null", f"""
WITH {LABELLED_SQL},
g AS (SELECT quality FROM d GROUP BY quality ORDER BY count(*) DESC, quality ASC NULLS FIRST LIMIT 2),
p AS (SELECT quality, lang, count(*) AS n FROM d
      WHERE EXISTS (SELECT 1 FROM g WHERE g.quality IS NOT DISTINCT FROM d.quality) GROUP BY quality, lang),
r AS (SELECT quality, lang, n, CAST(row_number() OVER (PARTITION BY quality ORDER BY n DESC, lang ASC NULLS FIRST)
      AS INTEGER) AS "rank" FROM p)
SELECT * FROM r WHERE "rank" <= 3""")
def q_top_groups_null(spark, sf_dir):
    """The largest group is the NULL one."""
    return top_k_in_top_groups(labelled_documents(spark, sf_dir), "quality", "lang", 2, 3)


@query("restrict_null_key", f"""
WITH {LABELLED_SQL},
t AS (SELECT quality FROM d GROUP BY quality ORDER BY count(*) DESC, quality ASC NULLS FIRST LIMIT 2)
SELECT quality, lang, count(*) AS n FROM d
WHERE EXISTS (SELECT 1 FROM t WHERE t.quality IS NOT DISTINCT FROM d.quality) GROUP BY quality, lang""")
def q_restrict_null_key(spark, sf_dir):
    return frequency(restrict_to_top_keys(labelled_documents(spark, sf_dir), "quality", 2), ["quality", "lang"])


@query("common_keys_null", f"""
WITH {LABELLED_SQL},
p AS (SELECT quality, lang, count(*) AS n FROM d GROUP BY quality, lang),
r AS (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY n DESC, lang ASC NULLS FIRST) AS k FROM p),
t AS (SELECT * FROM r WHERE k <= 3)
SELECT lang, count(*) AS n_groups FROM t GROUP BY lang
HAVING count(*) = (SELECT count(*) FROM (SELECT DISTINCT quality FROM t))""")
def q_common_keys_null(spark, sf_dir):
    return common_keys(top_k_per_group(labelled_documents(spark, sf_dir), "quality", "lang", 3), "quality", "lang")


@query("many_per_group", """
WITH p AS (SELECT event_type, event_id, count(*) AS n FROM events GROUP BY 1, 2),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY event_type ORDER BY n DESC, event_id ASC NULLS FIRST) AS INTEGER)
      AS "rank" FROM p)
SELECT * FROM r WHERE "rank" <= 1500""")
def q_many_per_group(spark, sf_dir):
    """A k that is larger than what Spark limits inside a group by itself."""
    return top_k_per_group(read_table(spark, sf_dir, "events"), "event_type", "event_id", 1500)


# --- dirty clock text -----------------------------------------------------------------------------

def dirty_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, event_type, t): clock text with hours up to 30, minutes up to
    74, suffixes A, P, X or none, and some NULLs, all told by ``event_id``."""
    i = F.col("event_id")
    suffix = F.when(i % 4 == 0, "A").when(i % 4 == 1, "P").when(i % 4 == 2, "X").otherwise("")
    text = F.concat(F.lpad((i % 31).cast("string"), 2, "0"), F.lpad((i % 75).cast("string"), 2, "0"), suffix)
    return read_table(spark, sf_dir, "events").select("event_id", "event_type", F.when(i % 97 != 0, text).alias("t"))


DIRTY_CLOCK_SQL = """d AS (SELECT event_id, event_type, CASE WHEN event_id % 97 <> 0 THEN
  lpad(CAST(event_id % 31 AS VARCHAR), 2, '0') || lpad(CAST(event_id % 75 AS VARCHAR), 2, '0')
  || CASE event_id % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'P' WHEN 2 THEN 'X' ELSE '' END END AS t FROM events)"""
DIRTY_BINS_SQL = f"""{DIRTY_CLOCK_SQL},
h AS (SELECT event_id, event_type, {clock12_sql('t', 'as_written')} AS hour FROM d),
b AS (SELECT event_id, hour, event_type, {bin_case_sql('hour', REFERENCE_BINS)} AS time_bin FROM h)"""


def dirty_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = with_clock_hours(dirty_clock(spark, sf_dir), "t", "hour", None, "as_written").select("event_id", "hour", "event_type")
    return hours.withColumn("time_bin", bin_column("hour", REFERENCE_BINS))


@query("clock12_dirty_as_written", f"WITH {DIRTY_CLOCK_SQL}\nSELECT {clock12_sql('t', 'as_written')} AS hour, count(*) AS n FROM d GROUP BY 1")
def q_clock12_dirty_as_written(spark, sf_dir):
    return frequency(dirty_clock(spark, sf_dir).select(parse_clock12("t", "as_written").alias("hour")), "hour")


@query("clock12_dirty_standard", f"WITH {DIRTY_CLOCK_SQL}\nSELECT {clock12_sql('t', 'standard')} AS hour, count(*) AS n FROM d GROUP BY 1")
def q_clock12_dirty_standard(spark, sf_dir):
    return frequency(dirty_clock(spark, sf_dir).select(parse_clock12("t", "standard").alias("hour")), "hour")


@query("dirty_time_nulls", f"WITH {DIRTY_CLOCK_SQL}\nSELECT count(*) FILTER (WHERE t IS NULL) AS n_null FROM d")
def q_dirty_time_nulls(spark, sf_dir):
    return null_count(dirty_clock(spark, sf_dir), "t")


@query("dirty_bins_dropna", f"""
WITH {DIRTY_BINS_SQL}
SELECT time_bin, count(event_type) AS n FROM b
WHERE hour IS NOT NULL AND event_type IS NOT NULL AND time_bin IS NOT NULL GROUP BY time_bin""")
def q_dirty_bins_dropna(spark, sf_dir):
    return frequency(drop_incomplete(dirty_bins(spark, sf_dir)), "time_bin", count="event_type")


@query("dirty_unbinned", f"WITH {DIRTY_BINS_SQL}\nSELECT event_id, hour, event_type, time_bin FROM b WHERE time_bin IS NULL")
def q_dirty_unbinned(spark, sf_dir):
    return unbinned(dirty_bins(spark, sf_dir), "time_bin")


# --- rates table, text sentinels, names, listings ----------------------------------------------------

@query("revenue_table", """
WITH t AS (SELECT l_linenumber, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_linenumber ASC NULLS FIRST LIMIT 3),
r AS (SELECT CAST(p_size AS INTEGER) AS l_linenumber, count(*) AS fine FROM part WHERE p_size <> 2 GROUP BY 1)
SELECT t.l_linenumber, t.n, r.fine, t.n * r.fine AS total_fines FROM t LEFT JOIN r USING (l_linenumber)""")
def q_revenue_table(spark, sf_dir):
    """Rates from a table: the price of a line number is the number of parts of
    that size (one code has none)."""
    rates = frequency(read_table(spark, sf_dir, "part").where("p_size <> 2").select(F.col("p_size").cast("int").alias("l_linenumber")),
                      "l_linenumber", name="fine")
    return priced_top_k(read_table(spark, sf_dir, "lineitem"), "l_linenumber", 3, rates)


_TEXT_CHECKED = ("l_suppkey", "l_returnflag", "l_linestatus")


@query("zero_profile_text", _count_filter_union("lineitem", _TEXT_CHECKED, "TRY_CAST(CAST({c} AS VARCHAR) AS DOUBLE) = 0", "n_match"))
def q_zero_profile_text(spark, sf_dir):
    """Text columns against the number 0."""
    li = read_table(spark, sf_dir, "lineitem").select(*[F.col(c).cast("string").alias(c) for c in _TEXT_CHECKED])
    return sentinel_profile(li, {c: 0 for c in _TEXT_CHECKED})


@query("sentinel_filter_text", """
SELECT l_suppkey, count(*) AS n FROM (SELECT CAST(l_suppkey AS VARCHAR) AS l_suppkey FROM lineitem) t
WHERE TRY_CAST(l_suppkey AS DOUBLE) <> 0 GROUP BY l_suppkey""")
def q_sentinel_filter_text(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("string").alias("l_suppkey"))
    return frequency(drop_sentinels(li, {"l_suppkey": 0}), "l_suppkey")


@query("sentinel_to_constant", """
SELECT CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '3-MEDIUM' ELSE o_orderpriority END AS o_orderpriority, count(*) AS n
FROM orders GROUP BY 1""")
def q_sentinel_to_constant(spark, sf_dir):
    o = replace_sentinel(read_table(spark, sf_dir, "orders"), "o_orderpriority", "4-NOT SPECIFIED", "3-MEDIUM")
    return frequency(o, "o_orderpriority")


@query("normalize", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def q_normalize(spark, sf_dir):
    """Names with blanks, as in a file's header, brought to one form."""
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    return normalize_names(nation.toDF("n nationkey", "n name", "n regionkey"))


@query("structure", """
SELECT CAST(ordinal_position AS INTEGER) AS position, column_name,
       CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
       ELSE lower(data_type) END AS column_type
FROM information_schema.columns WHERE table_name = 'orders'""")
def q_structure(spark, sf_dir):
    return structure(read_table(spark, sf_dir, "orders"))


@query("first_rows", """
SELECT event_id, event_type FROM events ORDER BY event_type ASC NULLS FIRST, event_id ASC NULLS FIRST LIMIT 6""")
def q_first_rows(spark, sf_dir):
    return first_rows(read_table(spark, sf_dir, "events").select("event_id", "event_type"), ["event_type", "event_id"])


@query("bin_code_listing", f"""
WITH {BINNED_EVENTS_SQL}, p AS (SELECT event_type, time_bin, count(*) AS n FROM c GROUP BY event_type, time_bin)
SELECT *, CAST(row_number() OVER (ORDER BY n DESC, event_type ASC NULLS FIRST, time_bin ASC NULLS FIRST) AS INTEGER) AS "rank" FROM p""")
def q_bin_code_listing(spark, sf_dir):
    """Every (code, bin) count in listing order."""
    return ranked(frequency(binned_events(spark, sf_dir), ["event_type", "time_bin"]), ["event_type", "time_bin"])


@query("season_listing", f"""
WITH {SEASONED_ORDERS_SQL}, p AS (SELECT season, count(o_orderpriority) AS n FROM s GROUP BY season)
SELECT *, CAST(row_number() OVER (ORDER BY n DESC, season ASC NULLS FIRST) AS INTEGER) AS "rank" FROM p""")
def q_season_listing(spark, sf_dir):
    return ranked(frequency(seasoned_orders(spark, sf_dir), "season", count="o_orderpriority"), "season")
