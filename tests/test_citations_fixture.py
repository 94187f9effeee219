"""The whole analysis on the handmade citations CSV (FIXTURES.md section 1)."""

import os

from conftest import FIXTURES, as_dict, rows

from facets.functions import matches
from facets.plans.citations import (
    citation_report,
    clean_citations,
    land_cleaned,
    load_citations,
    quality_checks,
    time_bins,
)


def test_load_declared_schema(raw):
    assert raw.count() == 16
    types = dict(raw.dtypes)
    assert types["Summons Number"] == "bigint"
    assert types["Issue Date"] == "date"
    assert types["Violation Code"] == "int"
    assert types["Violation Time"] == "string"


def test_plate_zero_under_try_cast(raw):
    # "0" and "000" equal 0; text plates do not, and ANSI mode does not raise.
    assert raw.where(matches(raw, "Plate ID", 0)).count() == 2


def test_us_date_format(spark):
    us = load_citations(spark, os.path.join(FIXTURES, "citations_us_dates.csv"),
                        date_formats=("MM/dd/yyyy", "yyyy-MM-dd"))
    iso = load_citations(spark, os.path.join(FIXTURES, "citations.csv"))
    assert dict(us.dtypes)["Issue Date"] == "date"
    assert sorted(rows(us, "Summons Number", "Issue Date")) == sorted(rows(iso, "Summons Number", "Issue Date"))


def test_quality_checks(raw):
    q = quality_checks(raw)
    assert rows(q["shape"]) == [(16, 10)]
    years = as_dict(q["year_counts"], "Issue_year", "n")
    assert years == {2017: 14, 2016: 1, None: 0}     # n(key): the undated group counts 0
    assert rows(q["year_counts_after"]) == [(2017, 14)]
    nulls = as_dict(q["nulls"], "column_name", "n_null")
    assert nulls["Registration State"] == 1 and nulls["Violation Precinct"] == 1
    assert nulls["Issue Date"] == 0 and nulls["Summons Number"] == 0
    zeros = as_dict(q["zeros"], "column_name", "n_match")
    assert zeros["Plate_ID"] == 2 and zeros["Violation_Code"] == 1
    assert zeros["Violation_Precinct"] == 1 and zeros["Issuer_Precinct"] == 1
    assert zeros["Registration_State"] == 0 and zeros["Summons_Number"] == 0
    assert rows(q["placeholder_states"]) == [("Registration_State", 1)]


def test_clean_counts(raw):
    clean = clean_citations(raw)
    assert clean.count() == 10
    assert sorted(r[0] for r in rows(clean, "Summons_Number")) == [1001, 1002, 1003, 1004, 1009, 1010, 1011,
                                                                  1012, 1013, 1014]
    codes = as_dict(clean.groupBy("Violation_Code").count(), "Violation_Code", "count")
    assert codes == {46: 4, 21: 3, 14: 2, 38: 1}
    states = as_dict(clean.groupBy("Registration_State").count(), "Registration_State", "count")
    assert states == {"PA": 4, "NY": 3, "NJ": 2, None: 1}


AS_WRITTEN = {1001: 1, 1002: 21, 1003: 0, 1004: 12, 1009: None, 1010: 15, 1011: None, 1012: None,
              1013: 17, 1014: 6}
STANDARD = {1001: 1, 1002: 21, 1003: 12, 1004: 0, 1009: None, 1010: None, 1011: None, 1012: None,
            1013: 17, 1014: 6}
BIN_AS_WRITTEN = {1001: "Midnight", 1002: "Night", 1003: "Midnight", 1004: "Afternoon", 1009: None,
                  1010: "Afternoon", 1011: None, 1012: None, 1013: "Evening", 1014: "Early Morning"}


def test_clock_policies(raw):
    aw = as_dict(clean_citations(raw), "Summons_Number", "Violation_hours")
    assert aw == AS_WRITTEN
    st = as_dict(clean_citations(raw, clock_policy="standard"), "Summons_Number", "Violation_hours")
    assert st == STANDARD


def test_bins_and_dropna(raw):
    from facets.functions import REFERENCE_BINS, bin_column

    clean = clean_citations(raw)
    b = as_dict(clean.select("Summons_Number", bin_column("Violation_hours", REFERENCE_BINS).alias("bin")),
                "Summons_Number", "bin")
    assert b == BIN_AS_WRITTEN
    assert time_bins(clean).count() == 7          # dropna over (hour, code, bin)


def test_report(raw):
    r = citation_report(clean_citations(raw))
    assert rows(r["distinct_summons"]) == [(10, 10, True)]
    assert [str(x) for x in rows(r["date_range"])[0]] == ["2017-01-15", "2017-11-02"]
    assert rows(r["total_tickets"]) == [(10, 14)]
    assert rows(r["unique_states"]) == [(3,)]
    assert rows(r["code_top"]) == [(46, 4), (21, 3), (14, 2), (38, 1)]
    assert rows(r["state_top"]) == [("PA", 4), ("NY", 3), ("NJ", 2), (None, 0)]
    assert rows(r["body_top"])[:3] == [("DELV", 4), ("SUBN", 2), ("VAN", 2)]
    assert rows(r["bin_counts"]) and as_dict(r["bin_counts"], "Time_Bins", "n") == {
        "Afternoon": 2, "Midnight": 2, "Early Morning": 1, "Evening": 1, "Night": 1}
    assert sum(n for _, n in rows(r["bin_counts"])) == 7
    assert r["unbinned"].count() == 3
    assert as_dict(r["season_counts"], "Seasons", "n") == {"Winter": 4, "Rainy": 3, "Summer": 3}
    assert rows(r["top_codes"]) == [(46, 4), (21, 3), (14, 2)]
    assert rows(r["top_codes_total"]) == [(9,)]
    fines = {c: (n, f, t) for c, n, f, t in rows(r["fines"])}
    assert fines == {46: (4, None, None), 21: (3, 55, 165), 14: (2, 115, 230)}
    assert rows(r["top_codes_binned"]) == [(14, 2), (21, 2), (46, 2)]
    mode = {c: (b, n) for c, b, n in rows(r["mode_bin_of_top_codes"])}
    assert mode == {46: ("Afternoon", 1), 21: ("Early Morning", 1), 14: ("Afternoon", 1)}
    for name, df in r.items():     # every answer plans and runs
        df.collect()


def test_landed_report_matches(spark, raw):
    clean = clean_citations(raw)
    landed = land_cleaned(clean)
    a = citation_report(clean)
    b = citation_report(landed)
    for name in ("code_top", "bin_counts", "season_counts", "per_bin_top_codes", "fines"):
        assert sorted(map(str, rows(a[name]))) == sorted(map(str, rows(b[name].select(*a[name].columns))))


def test_frequency_tables_one_scan(raw):
    from facets.operators import frequency
    from facets.plans.citations import FREQUENCY_COLUMNS

    clean = clean_citations(raw)
    ft = {(c, v): (n, k) for c, v, n, k in rows(citation_report(clean)["frequency_tables"])}
    assert ft[("Vehicle_Make", "NISSA")] == (4, 1) and ft[("Vehicle_Make", "FORD")] == (3, 2)
    for c in FREQUENCY_COLUMNS:
        separate = {(None if v is None else str(v)): n for v, n in rows(frequency(clean, c))}
        for (col, v), (n, _) in ft.items():
            if col == c:
                assert separate[v] == n


def test_sql_text_over_views(spark, raw):
    from facets.operators import top_k, top_k_per_group
    from facets.plans.citations import register_citation_views

    clean = clean_citations(raw)
    v = register_citation_views(clean)
    morning = spark.sql(f"""select Violation_Code, count(*) as vio_count from {v['time_bins']}
                            where Time_Bins='Afternoon' group by Violation_Code
                            order by vio_count desc, Violation_Code""")
    per_bin = top_k_per_group(time_bins(clean), "Time_Bins", "Violation_Code", 6)
    expect = [(c, n) for b, c, n, _ in rows(per_bin.orderBy("Time_Bins", "rank")) if b == "Afternoon"]
    assert rows(morning) == expect
    seasons = spark.sql(f"select Seasons, count(Violation_Code) as vio_count from {v['seasons']} group by Seasons")
    assert dict(rows(seasons)) == {"Winter": 4, "Rainy": 3, "Summer": 3}
    total = spark.sql(f"select sum(count1) as total from {v['top_codes']}")
    assert rows(total) == [(9,)]
    distinct = spark.sql(f"select count(distinct(Summons_Number)) as n from {v['table']}")
    assert rows(distinct) == [(10,)]
    assert rows(top_k(clean, "Violation_Code", 3)) == [(46, 4), (21, 3), (14, 2)]


def test_run_report_writes_every_answer(spark, citations_path, tmp_path):
    from facets.plans.citations import run_citation_report

    paths = run_citation_report(spark, citations_path, str(tmp_path / "out"), landed_path=str(tmp_path / "landed"))
    assert "check_nulls" in paths and "fines" in paths and "per_bin_top_codes" in paths
    fines = rows(spark.read.parquet(paths["fines"]).orderBy("Violation_Code"))
    assert fines == [(14, 2, 115, 230), (21, 3, 55, 165), (46, 4, None, None)]


def test_infer_schema_reads_iso_dates_as_dates(spark):
    from facets.sources import load_csv

    iso = load_csv(spark, os.path.join(FIXTURES, "citations.csv"), infer=True)
    us = load_csv(spark, os.path.join(FIXTURES, "citations_us_dates.csv"), infer=True)
    assert dict(iso.dtypes)["Issue Date"] == "date"
    assert dict(us.dtypes)["Issue Date"] == "string"


def test_precinct_parameter_s12(raw):
    clean = clean_citations(raw)
    as_coded = rows(citation_report(clean)["codes_in_top_precincts"].orderBy("Violation_Precinct", "rank"))
    as_worded = rows(citation_report(clean, precinct="Issuer_Precinct")["codes_in_top_precincts"]
                     .orderBy("Issuer_Precinct", "rank"))
    # violation precincts 19:4 18:3 1:2 14:1; issuer precincts 19:3 18:3 1:2 14:2 (tie -> 1)
    assert {r[0] for r in as_coded} == {r[0] for r in as_worded} == {1, 18, 19}
    assert [r for r in as_coded if r[0] == 19] == [(19, 21, 3, 1), (19, 46, 1, 2)]
    assert [r for r in as_worded if r[0] == 19] == [(19, 21, 3, 1)]
    assert as_coded[0] == (1, 14, 2, 1)


def test_names_resolve_case_insensitively_s14(spark, raw):
    from facets.plans.citations import register_citation_views

    v = register_citation_views(clean_citations(raw))
    out = spark.sql(f"SELECT Issue_Month, count(*) AS Count FROM {v['seasons']} GROUP BY Issue_Month "
                    "ORDER BY count DESC, issue_month")
    assert out.columns == ["Issue_Month", "Count"]
    # every kept row has a different month (Jan..Nov, no September or December)
    assert rows(out) == [(m, 1) for m in (1, 2, 3, 4, 5, 6, 7, 8, 10, 11)]



def test_command_line_report(citations_path, tmp_path):
    import subprocess
    import sys

    from conftest import ROOT

    out = tmp_path / "cli"
    res = subprocess.run([sys.executable, "-m", "facets", "report", citations_path, str(out),
                          "--landed", str(tmp_path / "landed"), "--clock-policy", "standard"],
                         cwd=ROOT, capture_output=True, text=True, timeout=600)
    assert res.returncode == 0, res.stderr[-2000:]
    names = {line.split("\t")[0] for line in res.stdout.splitlines() if "\t" in line}
    assert {"check_nulls", "fines", "per_bin_top_codes", "frequency_tables"} <= names
    assert (out / "fines" / "_SUCCESS").exists()


def test_declared_schema_applies_by_name(spark, tmp_path):
    # a wider file with the columns in another order still loads the right values
    import csv as _csv

    src = list(_csv.reader(open(os.path.join(FIXTURES, "citations.csv"))))
    header = ["Extra A"] + src[0][::-1] + ["Extra B"]
    path = tmp_path / "wide.csv"
    with open(path, "w", newline="") as fh:
        w = _csv.writer(fh)
        w.writerow(header)
        for r in src[1:]:
            w.writerow(["x"] + r[::-1] + ["y"])
    wide = load_citations(spark, str(path))
    narrow = load_citations(spark, os.path.join(FIXTURES, "citations.csv"))
    assert wide.columns == narrow.columns
    assert sorted(map(str, rows(wide))) == sorted(map(str, rows(narrow)))
