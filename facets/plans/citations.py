"""The reference's whole analysis of a parking-citation file, as Spark plans.

``load_citations`` -> ``quality_checks`` (before/while cleaning) ->
``clean_citations`` -> ``land_parquet`` -> ``citation_report``.

Every step returns DataFrames; nothing is collected. The report is a dict of
named, lazily planned answers - one per question the reference asks - meant
to run over the *landed* cleaned table, so each answer reads compact Parquet
(pruned to its columns) instead of re-parsing the raw CSV as the reference's
~70 actions do.

Parity switches (SURVEY 2.9): ``clock_policy`` ("as_written" keeps the
noon/midnight swap, "standard" fixes it), ``state_fill`` (a constant as
written, or ``None`` for the computed mode), ``precinct`` (the reference
filters on Violation_Precinct while asking about issuers).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facets.functions import REFERENCE_BINS, SEASONS, bin_column
from facets.functions import matches
from facets.operators import (
    bottom_k,
    common_keys,
    distinct_values,
    drop_incomplete,
    drop_sentinels,
    frequencies,
    frequency,
    keep_year,
    mode_group,
    priced_top_k,
    replace_sentinel,
    replace_with_mode,
    restrict_to_top_keys,
    top_k,
    top_k_in_top_groups,
    top_k_per_group,
    total_of_top_k,
    unbinned,
    with_clock_hours,
)
from facets.sources import FAILED_CASTS, land_parquet, load_csv, normalize_names, register_view

# The citation file's columns (header text) and their types.
CITATION_COLUMNS = (
    ("Summons Number", T.LongType()),
    ("Plate ID", T.StringType()),
    ("Registration State", T.StringType()),
    ("Issue Date", T.DateType()),
    ("Violation Code", T.IntegerType()),
    ("Vehicle Body Type", T.StringType()),
    ("Vehicle Make", T.StringType()),
    ("Violation Precinct", T.IntegerType()),
    ("Issuer Precinct", T.IntegerType()),
    ("Violation Time", T.StringType()),
)
CITATIONS_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in CITATION_COLUMNS])

# Cleaning rules of the reference.
YEAR = 2017
ZERO_SENTINELS = {"Violation_Precinct": 0, "Issuer_Precinct": 0, "Violation_Code": 0}
ZERO_CHECKED = ("Summons_Number", "Plate_ID", "Registration_State", "Violation_Code", "Vehicle_Body_Type",
                "Vehicle_Make", "Violation_Precinct", "Issuer_Precinct", "Issue_year")
STATE_PLACEHOLDER = "99"
STATE_FILL = "NY"

# Columns whose frequency the reference ranks.
FREQUENCY_COLUMNS = ("Violation_Code", "Vehicle_Body_Type", "Vehicle_Make", "Violation_Precinct",
                     "Issuer_Precinct")

# Text columns whose value counts come from one shared cube.
TEXT_COLUMNS = ("Registration_State", "Vehicle_Body_Type", "Vehicle_Make")

# Average fine per violation code (USD).
FINES = {21: 55, 38: 50, 14: 115}


def load_citations(spark: SparkSession, path: str, date_formats=("yyyy-MM-dd",), flag_failed: bool = False) -> DataFrame:
    return load_csv(spark, path, CITATIONS_SCHEMA, date_columns=("Issue Date",), date_formats=date_formats,
                    flag_failed=flag_failed)


def quality_checks(raw: DataFrame, year: int = YEAR, materialize: bool = True) -> dict[str, DataFrame]:
    """The reference's checks on the raw table in one pass over it.

    Rows are grouped by issue year, and every null, zero, placeholder and
    failed-cast count is a conditional count of that one aggregate (the
    reference runs one job per check, 21 in all, each re-parsing the file).
    Its result - a row per year - is checkpointed once when ``materialize``,
    which runs this pass on call; every answer reads those few rows. Answers
    on columns are about the rows of ``year``. ``failed_casts`` counts
    non-empty text that became NULL on load; it is there if ``raw`` was
    loaded with ``flag_failed``, and covers all years (a failed date has none)."""
    keep = _materialize if materialize else (lambda d: d)
    flagged = FAILED_CASTS in raw.columns
    table = raw.drop(FAILED_CASTS)
    renamed = normalize_names(table)
    original = dict(zip(renamed.columns, table.columns, strict=True))
    dated = normalize_names(raw).withColumn("Issue_year", F.year("Issue_Date"))

    checks = {f"null|{original[c]}": F.col(c).isNull() for c in renamed.columns}
    checks["null|Issue_year"] = F.col("Issue_year").isNull()
    checks.update({f"zero|{c}": matches(dated, c, 0) for c in ZERO_CHECKED})
    checks["placeholder|Registration_State"] = matches(dated, "Registration_State", STATE_PLACEHOLDER)
    if flagged:
        typed = [c for c, t in CITATION_COLUMNS if not isinstance(t, T.StringType)]
        checks.update({f"failed|{c}": F.array_contains(FAILED_CASTS, c) for c in typed})
    names = [n for n in checks if not n.startswith("null|Issue_year")] + ["null|Issue_year"]
    cube = keep(dated.groupBy("Issue_year").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.coalesce(checks[n], F.lit(False))).alias(n) for n in names]))

    def kind(k: str, value_name: str, rows: DataFrame) -> DataFrame:
        own = [n for n in names if n.startswith(f"{k}|")]
        one = rows.agg(*[F.coalesce(F.sum(f"`{n}`"), F.lit(0).cast("bigint")).alias(n.split("|")[1]) for n in own])
        return one.unpivot([], [n.split("|")[1] for n in own], "column_name", value_name)

    in_year = cube.where(F.col("Issue_year") == year)
    out = {
        "shape": cube.agg(F.sum("n").alias("n_rows")).withColumn("n_cols", F.lit(len(table.columns))),
        "year_counts": frequency(cube, "Issue_year", count="key", by="n"),
        "year_counts_after": frequency(in_year, "Issue_year", count="key", by="n"),
        "nulls": kind("null", "n_null", in_year),
        "zeros": kind("zero", "n_match", in_year),
        "placeholder_states": kind("placeholder", "n_match", in_year),
    }
    if flagged:
        out["failed_casts"] = kind("failed", "n_failed", cube)
    return out


def clean_citations(raw: DataFrame, year: int = YEAR, state_fill: str | None = STATE_FILL,
                    clock_policy: str = "as_written") -> DataFrame:
    """Year filter, names, sentinel rows, placeholder state, hour, month.

    All narrow: no shuffle anywhere in cleaning (the mode variant adds one
    scalar subquery).
    """
    df = raw.drop(FAILED_CASTS).withColumn("Issue_year", F.year("Issue Date"))
    df = keep_year(df, "Issue Date", year)
    df = normalize_names(df)
    df = drop_sentinels(df, ZERO_SENTINELS)
    if state_fill is None:
        df = replace_with_mode(df, "Registration_State", STATE_PLACEHOLDER)
    else:
        df = replace_sentinel(df, "Registration_State", STATE_PLACEHOLDER, state_fill)
    df = with_clock_hours(df, "Violation_Time", "Violation_hours", "Violation_mins", clock_policy)
    return df.withColumn("Issue_month", F.month("Issue_Date"))


def land_cleaned(clean: DataFrame, path: str | None = None) -> DataFrame:
    """Write the cleaned table once and read it back for the report.

    No ``partitionBy``: on a 1000-executor cluster a month partitioning
    writes tasks x months small files (or needs a full shuffle to avoid
    them). Each task instead sorts its own rows by date - no shuffle - so
    Parquet row-group min/max statistics are tight and date or month
    predicates skip row groups at scan time.
    """
    return land_parquet(clean.sortWithinPartitions("Issue_Date"), path)


def time_bins(clean: DataFrame, spec=REFERENCE_BINS, drop: bool = True) -> DataFrame:
    tb = clean.select("Violation_hours", "Violation_Code",
                      bin_column("Violation_hours", spec).alias("Time_Bins"))
    return drop_incomplete(tb) if drop else tb


def seasons(clean: DataFrame, spec=SEASONS) -> DataFrame:
    return clean.select("Issue_month", "Violation_Code", bin_column("Issue_month", spec).alias("Seasons"))


def citation_report(clean: DataFrame, precinct: str = "Violation_Precinct", fines=FINES,
                    bins=REFERENCE_BINS, materialize: bool = True) -> dict[str, DataFrame]:
    """One lazily planned DataFrame per question of the reference.

    ``precinct="Issuer_Precinct"`` asks the precinct question as worded
    rather than as coded; ``bins=EQUAL_4H_BINS`` gives six equal bins.

    Aggregate once, answer many: the table is scanned four times for the 27
    answers. A cube of the value counts of seven columns, and one of (bin,
    season, precinct, code) that keeps rows without a bin, serve all rankings;
    their size is that of the domains, however large the table. One aggregate
    has the distinct count, the date range and the missing times, and rows
    without a bin are listed by themselves. Each cube is counted with a
    map-side partial count; with ``materialize`` cubes and aggregate are
    checkpointed (reliably, into ``spark.checkpoint.dir``), so three jobs run
    on call, and the answers read those few rows.
    """
    keep = _materialize if materialize else (lambda d: d)
    code = "Violation_Code"
    counted = tuple(dict.fromkeys(TEXT_COLUMNS + FREQUENCY_COLUMNS))
    value_cube = keep(frequencies(clean, counted))

    def counts_of(column: str) -> DataFrame:
        """(column, n) for one column, read from the value cube, in the column's own type."""
        dtype = clean.schema[column].dataType
        return (value_cube.where(F.col("column_name") == column)
                .select(F.col("value").cast(dtype).alias(column), "n"))

    tb_all = time_bins(clean, bins, drop=False)
    in_bin = F.col("Violation_hours").isNotNull() & F.col(code).isNotNull()  # as dropna sees the row, besides the bin
    cube = keep(frequency(clean.select(
        F.when(in_bin, bin_column("Violation_hours", bins)).alias("Time_Bins"), bin_column("Issue_month", SEASONS).alias("Seasons"),
        precinct, code), ["Time_Bins", "Seasons", precinct, code]))
    bin_cube = frequency(cube.where("Time_Bins is not null"), ["Time_Bins", code], by="n")
    season_cube = frequency(cube, ["Seasons", code], by="n")
    precinct_cube = frequency(cube, [precinct, code], by="n")
    whole = keep(clean.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("Summons_Number").alias("n_distinct"),
                           F.min("Issue_Date").alias("min_value"), F.max("Issue_Date").alias("max_value"),
                           F.count_if(F.col("Violation_Time").isNull()).alias("n_null")))
    code_totals = frequency(precinct_cube, code, by="n")
    precinct_codes = top_k_in_top_groups(precinct_cube, precinct, code, 3, 6, by="n")
    binned_codes = frequency(bin_cube, code, by="n")
    top_binned = restrict_to_top_keys(bin_cube, code, 3, by="n")
    report = {
        "distinct_summons": whole.select("n_rows", "n_distinct", (F.col("n_rows") == F.col("n_distinct")).alias("is_unique")),
        "date_range": whole.select("min_value", "max_value"),
        "total_tickets": whole.select("n_rows", F.lit(len(clean.columns)).alias("n_cols")),
        "unique_states": distinct_values(counts_of("Registration_State"), "Registration_State"),
        "state_top": top_k(frequency(counts_of("Registration_State"), "Registration_State", count="key", by="n"),
                           "Registration_State", 6, by="n"),
        "code_top": top_k(frequency(precinct_cube, code, count="key", by="n"), code, 6, by="n"),
        "body_top": top_k(counts_of("Vehicle_Body_Type"), "Vehicle_Body_Type", 5, by="n"),
        "body_bottom": bottom_k(counts_of("Vehicle_Body_Type"), "Vehicle_Body_Type", 5, by="n"),
        "make_top": top_k(counts_of("Vehicle_Make"), "Vehicle_Make", 5, by="n"),
        "make_bottom": bottom_k(counts_of("Vehicle_Make"), "Vehicle_Make", 5, by="n"),
        "violation_precinct_top": top_k(frequency(counts_of("Violation_Precinct"), "Violation_Precinct",
                                                  count="key", by="n"), "Violation_Precinct", 6, by="n"),
        "issuer_precinct_top": top_k(frequency(counts_of("Issuer_Precinct"), "Issuer_Precinct", count="key",
                                               by="n"), "Issuer_Precinct", 6, by="n"),
        "codes_in_top_precincts": precinct_codes,
        "codes_common_to_top_precincts": common_keys(precinct_codes, precinct, code),
        "time_nulls": whole.select("n_null"),
        "unbinned": unbinned(tb_all, "Time_Bins"),
        "bin_counts": frequency(bin_cube, "Time_Bins", count=code, by="n"),
        "per_bin_top_codes": top_k_per_group(bin_cube, "Time_Bins", code, 3, by="n"),
        "top_codes_binned": top_k(binned_codes, code, 3, by="n"),
        "bins_of_top_codes": top_binned.select(code, "Time_Bins", "n"),  # column order of the direct form
        "mode_bin_of_top_codes": mode_group(top_binned, code, "Time_Bins", by="n"),
        "season_counts": frequency(season_cube, "Seasons", count=code, by="n"),
        "per_season_top_codes": top_k_per_group(season_cube, "Seasons", code, 3, by="n"),
        "top_codes": top_k(code_totals, code, 3, by="n"),
        "top_codes_total": total_of_top_k(precinct_cube, code, 3, by="n"),
        "fines": priced_top_k(precinct_cube, code, 3, fines, by="n"),
        # the five frequency questions from one scan, top 6 each
        "frequency_tables": top_k_per_group(value_cube.where(F.col("column_name").isin(*FREQUENCY_COLUMNS)),
                                            "column_name", "value", 6, by="n"),
    }
    return report


def _materialize(df: DataFrame) -> DataFrame:
    from facets.sources import materialize

    return materialize(df)


# Default names of the views ``register_citation_views`` creates.
VIEW_NAMES = {"table": "citations", "time_bins": "citation_time_bins", "seasons": "citation_seasons",
              "top_codes": "citation_top_codes"}


def register_citation_views(clean: DataFrame, names: dict[str, str] | None = None) -> dict[str, str]:
    """Register the cleaned table and its derived tables as temp views, with
    the column names the analysis uses (``Violation_Code``, ``Time_Bins``,
    ``Seasons``, ``Issue_Month`` ...), so existing SQL text over such views
    runs unchanged. ``names`` maps table/time_bins/seasons/top_codes to the
    view names a caller's SQL uses. Views are plans: Catalyst optimises
    every query from the scan up."""
    names = {**VIEW_NAMES, **(names or {})}
    register_view(clean, names["table"])
    register_view(time_bins(clean), names["time_bins"])
    register_view(seasons(clean), names["seasons"])
    register_view(top_k(clean, "Violation_Code", 3, name="count1"), names["top_codes"])
    return names


def write_report(report: dict[str, DataFrame], out_dir: str, mode: str = "overwrite") -> dict[str, str]:
    """Write every answer as Parquet under ``out_dir`` (one folder each).

    Written by the executors, not collected: nothing passes through the
    driver. No ``coalesce(1)``: most answers are k rows (AQE already merges
    their tiny shuffle partitions), but some (``unbinned``) grow with the
    data and must not be funnelled into one task."""
    paths = {}
    for name, df in report.items():
        path = f"{out_dir.rstrip('/')}/{name}"
        df.write.mode(mode).parquet(path)
        paths[name] = path
    return paths


def run_citation_report(spark: SparkSession, csv_path: str, out_dir: str, *, landed_path: str | None = None,
                        date_formats=("yyyy-MM-dd",), **clean_kw) -> dict[str, str]:
    """Load -> checks -> clean -> land -> report, every answer written to ``out_dir``."""
    raw = load_citations(spark, csv_path, date_formats, flag_failed=True)
    paths = write_report({f"check_{k}": v for k, v in quality_checks(raw).items()}, out_dir)
    landed = land_cleaned(clean_citations(raw, **clean_kw), landed_path)
    paths.update(write_report(citation_report(landed), out_dir))
    return paths
