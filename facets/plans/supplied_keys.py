"""Further questions on the supplied tables: keys of many values, long lists,
many bins, files with faults, file statistics. Each beside its DuckDB SQL."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facets.operators import (
    common_keys,
    each_bin,
    first_bin,
    frequency,
    key_uniqueness,
    mode_group_of_many,
    rarest_k,
    repeated_keys,
    restrict_to_top_keys,
    slice_top_k_of_many,
    structure_with_values,
    top_k_of_many,
    top_k_per_group,
    top_k_per_group_of_many,
)
from facets.plans.supplied import query
from facets.sources import file_statistics, load_checked_csv, read_table, record_faults, shared_dir

# --- keys seen once, keys seen again -------------------------------------------------------------


@query("duplicates_of_many", """
SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_partkey HAVING count(*) > 1""")
def q_duplicates_of_many(spark, sf_dir):
    """A key that repeats in a few rows of a thousand: only their hashes' twins are shuffled."""
    return repeated_keys(read_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_partkey"])


@query("uniqueness_of_many", """
SELECT 'event_id' AS key, count(*) AS n_rows, count(DISTINCT event_id) AS n_distinct, count(*) = count(DISTINCT event_id) AS is_unique FROM events
UNION ALL SELECT 'value', count(*), count(DISTINCT value), count(*) = count(DISTINCT value) FROM events""")
def q_uniqueness_of_many(spark, sf_dir):
    """A unique key and one that is not."""
    ev = read_table(spark, sf_dir, "events")
    parts = [key_uniqueness(ev.select(c), c).select(F.lit(c).alias("key"), "n_rows", "n_distinct", "is_unique") for c in ("event_id", "value")]
    return parts[0].union(parts[1])


@query("rarest_of_many", """
SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey ORDER BY n, l_orderkey NULLS FIRST LIMIT 25""")
def q_rarest_of_many(spark, sf_dir):
    return rarest_k(read_table(spark, sf_dir, "lineitem"), "l_orderkey", 25)


# --- top k over keys of many values ----------------------------------------------------------------

@query("topk_of_many", """
SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey ORDER BY n DESC, l_orderkey NULLS FIRST LIMIT 20""")
def q_topk_of_many(spark, sf_dir):
    return top_k_of_many(read_table(spark, sf_dir, "lineitem"), "l_orderkey", 20)


@query("slice_topk_of_many", """
SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey ORDER BY n DESC, o_custkey NULLS FIRST LIMIT 10""")
def q_slice_topk_of_many(spark, sf_dir):
    return slice_top_k_of_many(read_table(spark, sf_dir, "orders"), F.col("o_orderstatus") == "F", "o_custkey", 10)


_HOT_GROUP = "CASE WHEN {c} % 3 < 2 THEN NULL ELSE {c} % 7 END"


@query("per_group_topk_of_many", f"""
WITH g AS (SELECT {_HOT_GROUP.format(c='l_suppkey')} AS grp, l_partkey FROM lineitem),
p AS (SELECT grp, l_partkey, count(*) AS n FROM g GROUP BY 1, 2),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY grp ORDER BY n DESC, l_partkey NULLS FIRST) AS INTEGER) AS "rank" FROM p)
SELECT grp, l_partkey, n, "rank" FROM r WHERE "rank" <= 5""")
def q_per_group_topk_of_many(spark, sf_dir):
    """One group, the NULL one, owns two thirds of all rows and most keys."""
    li = read_table(spark, sf_dir, "lineitem").select(F.expr(_HOT_GROUP.format(c="l_suppkey")).alias("grp"), "l_partkey")
    return top_k_per_group_of_many(li, "grp", "l_partkey", 5)


@query("mode_group_of_many", """
WITH p AS (SELECT l_linenumber, l_partkey, count(*) AS n FROM lineitem GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY l_linenumber ORDER BY n DESC, l_partkey NULLS FIRST) AS k FROM p)
SELECT l_linenumber, l_partkey, n FROM r WHERE k = 1""")
def q_mode_group_of_many(spark, sf_dir):
    """For every line number its most common part, of many."""
    return mode_group_of_many(read_table(spark, sf_dir, "lineitem"), "l_linenumber", "l_partkey")


# --- long computed lists, keys common to many groups --------------------------------------------------

@query("restrict_many_keys", """
WITH t AS (SELECT l_orderkey FROM lineitem GROUP BY 1 ORDER BY count(*) DESC, l_orderkey NULLS FIRST LIMIT 1000)
SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_orderkey IN (SELECT l_orderkey FROM t) GROUP BY 1""")
def q_restrict_many_keys(spark, sf_dir):
    """A list too long to broadcast (here: of more than 100 keys)."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag")
    return frequency(restrict_to_top_keys(li, "l_orderkey", 1000, most_broadcast=100), "l_returnflag")


@query("common_keys_many_groups", """
WITH p AS (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, o_orderpriority NULLS FIRST) AS k FROM p),
t AS (SELECT * FROM r WHERE k <= 5)
SELECT o_orderpriority, count(*) AS n_groups FROM t GROUP BY 1 HAVING count(*) = (SELECT count(DISTINCT o_custkey) FROM t)""")
def q_common_keys_many_groups(spark, sf_dir):
    """Priorities among the top five of every customer: as many groups as customers."""
    return common_keys(top_k_per_group(read_table(spark, sf_dir, "orders"), "o_custkey", "o_orderpriority", 5), "o_custkey", "o_orderpriority")


# --- bins from a table -----------------------------------------------------------------------------------

def price_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bin for each customer: 75 wide, one starting every 50, so that they overlap."""
    c = F.col("c_custkey")
    return read_table(spark, sf_dir, "customer").select(c, F.col("c_name").alias("label"), (c * 50).alias("low"), (c * 50 + 75).alias("high"))


@query("table_bin_counts", """
WITH b AS (SELECT c_custkey, c_name, c_custkey * 50 AS low, c_custkey * 50 + 75 AS high FROM customer),
v AS (SELECT DISTINCT l_extendedprice AS x FROM lineitem),
f AS (SELECT v.x, min(b.c_custkey) AS k FROM v JOIN b ON v.x > b.low AND v.x <= b.high GROUP BY v.x)
SELECT c_name AS bin, count(*) AS n FROM lineitem LEFT JOIN f ON f.x = l_extendedprice LEFT JOIN customer ON c_custkey = f.k GROUP BY 1""")
def q_table_bin_counts(spark, sf_dir):
    """Over a thousand bins; of overlapping ones the first counts. Rows are
    counted by price, prices get their bin, the counts are rolled up."""
    prices = frequency(read_table(spark, sf_dir, "lineitem"), "l_extendedprice")
    return frequency(first_bin(prices, "l_extendedprice", price_bins(spark, sf_dir), "label", "low", "high", "c_custkey"), "bin", by="n")


@query("overlapping_bin_counts", """
WITH b AS (SELECT c_name, c_custkey * 50 AS low, c_custkey * 50 + 75 AS high FROM customer)
SELECT c_name AS bin, count(*) AS n FROM lineitem JOIN b ON l_extendedprice > low AND l_extendedprice <= high GROUP BY 1""")
def q_overlapping_bin_counts(spark, sf_dir):
    """The same bins, each value counted in every bin that holds it: rows are
    counted by price, prices meet their bins, the counts are rolled up."""
    prices = frequency(read_table(spark, sf_dir, "lineitem"), "l_extendedprice")
    return frequency(each_bin(prices, "l_extendedprice", price_bins(spark, sf_dir), "label", "low", "high", "c_custkey"), "bin", by="n")


# --- a file with faults -------------------------------------------------------------------------------------

def faulty_csv(spark: SparkSession, sf_dir: str) -> str:
    """``orders`` as a CSV that Spark writes, each record with the fault that its
    key tells: a field too many, one too few, a number that is none, a date that
    is none; some quoted texts hold a line break, quotes or commas."""
    k = F.col("o_orderkey")
    key = F.when(k % 11 == 2, F.lit("n/a")).otherwise(k.cast("string"))
    day = F.when(k % 11 == 3, F.lit("13/45/1999")).when(k % 11 == 5, F.lit("soon")).otherwise(F.date_format(F.to_date("o_orderdate"), "MM/dd/yyyy"))
    text = F.when(k % 5 == 0, F.concat(F.lit('"'), "o_orderpriority", F.lit('\nsecond line"'))).when(
        k % 5 == 1, F.concat(F.lit('"says ""'), "o_orderpriority", F.lit('"", twice"'))).otherwise(F.col("o_orderpriority"))
    whole = F.concat_ws(",", key, day, text)
    line = F.when(k % 11 == 0, F.concat(whole, F.lit(",extra"))).when(k % 11 == 1, F.concat_ws(",", key, day)).otherwise(whole)
    path = os.path.join(shared_dir(spark), f"facets-csv-{uuid.uuid4().hex}", "faulty")
    (read_table(spark, sf_dir, "orders").select(line.alias("o_orderkey,o_orderdate,o_orderpriority"))
     .write.option("header", True).option("sep", "\x01").option("quote", "").option("escapeQuotes", False).csv(path))
    return path


def checked_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_checked_csv(spark, faulty_csv(spark, sf_dir), "o_orderkey bigint, o_orderdate date, o_orderpriority string",
                            date_columns=("o_orderdate",), date_formats=("MM/dd/yyyy",))


@query("csv_faults", """
SELECT CASE WHEN o_orderkey % 11 IN (0, 1) THEN 'fields' WHEN o_orderkey % 11 = 2 THEN 'cast:o_orderkey'
       WHEN o_orderkey % 11 IN (3, 5) THEN 'cast:o_orderdate' ELSE 'none' END AS fault, count(*) AS n FROM orders GROUP BY 1""")
def q_csv_faults(spark, sf_dir):
    """Every record of the file is counted: good, or by its fault."""
    return record_faults(checked_orders(spark, sf_dir))


@query("csv_faulty_values", """
SELECT CASE WHEN o_orderkey % 11 = 2 THEN NULL ELSE o_orderkey END AS o_orderkey,
       CASE WHEN o_orderkey % 11 IN (3, 5) THEN NULL ELSE CAST(year(o_orderdate) AS INTEGER) END AS o_year,
       CASE o_orderkey % 5 WHEN 0 THEN o_orderpriority || chr(10) || 'second line' WHEN 1 THEN 'says "' || o_orderpriority || '", twice'
       ELSE o_orderpriority END AS o_orderpriority
FROM orders WHERE o_orderkey % 11 > 1""")
def q_csv_faulty_values(spark, sf_dir):
    """The values of all records with the right number of fields."""
    return checked_orders(spark, sf_dir).where("_bad_record is null").select("o_orderkey", F.year("o_orderdate").alias("o_year"), "o_orderpriority")


# --- file statistics, structure ---------------------------------------------------------------------------------

@query("file_statistics", """
SELECT 'l_orderkey' AS column_name, count(*) AS n_rows, count(*) - count(l_orderkey) AS n_null, CAST(min(l_orderkey) AS VARCHAR) AS min_value,
       CAST(max(l_orderkey) AS VARCHAR) AS max_value FROM lineitem
UNION ALL SELECT 'l_linenumber', count(*), count(*) - count(l_linenumber), CAST(min(l_linenumber) AS VARCHAR), CAST(max(l_linenumber) AS VARCHAR)
FROM lineitem""")
def q_file_statistics(spark, sf_dir):
    """Row count, nulls and ends of two columns, from the files' footers."""
    return file_statistics(spark, os.path.join(sf_dir, "lineitem.parquet"), ["l_orderkey", "l_linenumber"])


@query("structure_with_values", """
WITH f AS (SELECT *, row_number() OVER (ORDER BY c_custkey NULLS FIRST) AS k FROM (SELECT * FROM customer ORDER BY c_custkey NULLS FIRST LIMIT 5) t),
v AS (
  SELECT 'c_custkey' AS c, k, CAST(c_custkey AS VARCHAR) AS v FROM f UNION ALL SELECT 'c_name', k, c_name FROM f
  UNION ALL SELECT 'c_nationkey', k, CAST(c_nationkey AS VARCHAR) FROM f UNION ALL SELECT 'c_mktsegment', k, c_mktsegment FROM f),
s AS (SELECT c, array_to_string(list(v ORDER BY k), '|') AS first_values FROM v GROUP BY c),
n AS (SELECT column_name, row_number() OVER (ORDER BY ordinal_position) AS position,
      CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' ELSE lower(data_type) END AS column_type
      FROM information_schema.columns WHERE table_name = 'customer' AND column_name <> 'c_acctbal')
SELECT CAST(n.position AS INTEGER) AS position, n.column_name, n.column_type, s.first_values FROM n JOIN s ON s.c = n.column_name""")
def q_structure_with_values(spark, sf_dir):
    """Names, types and the first five values of every column but the balance."""
    found = structure_with_values(read_table(spark, sf_dir, "customer").drop("c_acctbal"), ["c_custkey"], 5)
    return found.withColumn("first_values", F.array_join("first_values", "|"))
