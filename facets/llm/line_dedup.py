"""Site-relative line de-duplication, in DataFrame operations only.

For each site, the share of its pages that contain a line tells boilerplate
from text: lines on more than a given share of a site's pages are dropped from
all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A line on more than this share of a site's pages is boilerplate ...
RATIO = 0.02
#: ... provided that it is on at least so many of them (a line of a site's only page is on all its pages).
LEAST_PAGES = 3


def _key(line: Column) -> Column:
    """What makes lines equal: their text without spaces and tabs at the ends."""
    return F.trim(F.translate(line, "\t\r", "  "))


def boilerplate_lines(pages: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                      ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """(host, line_id, pages, host_pages) of each host's boilerplate lines.

    A host has at most (distinct lines per page) / ``ratio`` of them. Counting
    combines on the map side by host and line, so neither a hot host nor a
    line that all its pages share meets in one task."""
    rows = pages.select(F.col(host_col).alias("host"), F.col(text_col).alias("text"))
    lines = (rows.select("host", F.explode(F.array_distinct(F.transform(F.split("text", "\n"), _key))).alias("line"))
             .where("line <> ''"))
    counts = lines.groupBy("host", _line_id(F.col("line")).alias("line_id")).agg(F.count(F.lit(1)).alias("pages"))
    totals = rows.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
    return (counts.where(F.col("pages") >= least_pages)
            .join(totals.withColumnRenamed("host", "_host"), F.col("host").eqNullSafe(F.col("_host"))).drop("_host")
            .where(F.col("pages") > ratio * F.col("host_pages")))


def _line_id(line: Column) -> Column:
    """128 bits that stand for a line."""
    return F.md5(line)


def drop_boilerplate(pages: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                     ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """One row per input row: id, ``n_lines``, ``n_dropped``, ``clean_text``.

    Lines end at a line feed and are equal if they are so without spaces, tabs
    and carriage returns at their ends; a page counts once for a line it
    repeats, and every occurrence of a boilerplate line is dropped. Blank
    lines are never boilerplate. Rows without a host form one host. A null text
    has no line and stays null. Rows that repeat id and host have the lines of
    all of them looked up together, and null ids likewise; other columns are
    ignored; an empty table gives an empty result.

    The lines that a page loses are found as ids (a few bytes a line), joined
    with the host's boilerplate and gathered by page; only then each text is
    joined with the list of its own lost lines, and filtered in place.
    """
    rows = pages.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), F.col(text_col).cast("string").alias("text"))
    common = boilerplate_lines(pages, id_col, text_col, host_col, ratio, least_pages).select(
        F.col("host").alias("b_host"), F.col("line_id").alias("b_line"))
    ids = rows.select("doc_id", "host", F.explode(F.array_distinct(F.transform(F.split("text", "\n"), _key))).alias("line")).where(
        "line <> ''").select("doc_id", "host", _line_id(F.col("line")).alias("line_id"))
    lost = (ids.join(common, F.col("host").eqNullSafe(F.col("b_host")) & (F.col("line_id") == F.col("b_line")), "left_semi")
            .groupBy(F.col("doc_id").alias("l_doc"), F.col("host").alias("l_host"))
            .agg(F.collect_set("line_id").alias("lost")))
    text_lines = F.split("text", "\n")
    kept = F.when(F.col("lost").isNull(), text_lines).otherwise(
        F.filter(text_lines, lambda x: ~F.array_contains(F.col("lost"), _line_id(_key(x)))))
    joined = rows.join(lost, F.col("doc_id").eqNullSafe(F.col("l_doc")) & F.col("host").eqNullSafe(F.col("l_host")), "left")
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(text_lines)).cast("long")
    return (joined.select("doc_id", "text", n_lines.alias("n_lines"), kept.alias("kept"))
            .select(F.col("doc_id").alias(id_col), "n_lines",
                    F.when(F.col("text").isNull(), 0).otherwise(F.col("n_lines") - F.size("kept")).cast("long").alias("n_dropped"),
                    F.when(F.col("text").isNotNull(), F.array_join("kept", "\n")).alias("clean_text")))


def oracle_sql(ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> str:
    key = "trim(translate({0}, chr(9) || chr(13), '  '))"
    return f"""
WITH r AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS parts FROM documents
), l AS (SELECT doc_id, source, unnest(parts) AS raw, generate_subscripts(parts, 1) AS nth FROM r
), k AS (SELECT *, {key.format('raw')} AS line FROM l
), c AS (SELECT source, line, count(DISTINCT doc_id) AS pages FROM k WHERE line <> '' GROUP BY 1, 2
), h AS (SELECT source, count(*) AS host_pages FROM documents GROUP BY 1
), b AS (SELECT c.source, c.line FROM c JOIN h ON c.source IS NOT DISTINCT FROM h.source
  WHERE pages >= {least_pages} AND pages > {ratio} * host_pages
), f AS (SELECT k.doc_id, k.raw, k.nth, EXISTS (SELECT 1 FROM b WHERE b.source IS NOT DISTINCT FROM k.source AND b.line = k.line) AS gone FROM k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  coalesce(string_agg(raw, chr(10) ORDER BY nth) FILTER (NOT gone), '') AS clean_text
FROM f GROUP BY doc_id
"""
