"""Golden values printed by the reference on its original citation file.

Skipped unless FACETS_CITATIONS_CSV names that file (it is not shipped).
Values are from the run that replaced placeholder states (FIXTURES.md 3).
"""

import os

import pytest
from conftest import as_dict, rows

from facets.plans.citations import citation_report, clean_citations, load_citations, quality_checks

CSV = os.environ.get("FACETS_CITATIONS_CSV")
pytestmark = pytest.mark.skipif(not CSV, reason="original citation file not supplied")

# Results the reference printed (run B).
ROWS_2017 = 5431918
ZEROS = {"Plate_ID": 3, "Violation_Code": 36, "Violation_Precinct": 925596, "Issuer_Precinct": 1078406}
PLACEHOLDER_STATES = 12525
CLEAN_ROWS = 4350123
BIN_COUNTS = {"Morning": 1890227, "Afternoon": 1359183, "Midnight": 516256, "Evening": 322411,
              "Early Morning": 154893, "Night": 107120}
SEASON_COUNTS = {"Summer": 2232049, "Winter": 2117032, "Rainy": 1042}
TOP_CODES = [(21, 641961), (38, 541397), (14, 471966)]
TOP_CODES_BINNED = [(21, 641959), (38, 541396), (14, 471965)]
FINES = {21: 35307855, 38: 27069850, 14: 54276090}


@pytest.fixture(scope="module")
def original(spark):
    return load_citations(spark, CSV, date_formats=("MM/dd/yyyy", "yyyy-MM-dd"))


def test_checks(original):
    q = quality_checks(original)
    assert rows(q["year_counts_after"]) == [(2017, ROWS_2017)]
    zeros = as_dict(q["zeros"], "column_name", "n_match")
    assert {k: zeros[k] for k in ZEROS} == ZEROS
    assert rows(q["placeholder_states"]) == [("Registration_State", PLACEHOLDER_STATES)]


def test_report(original):
    r = citation_report(clean_citations(original))
    assert rows(r["total_tickets"])[0][0] == CLEAN_ROWS
    assert as_dict(r["bin_counts"], "Time_Bins", "n") == BIN_COUNTS
    assert as_dict(r["season_counts"], "Seasons", "n") == SEASON_COUNTS
    assert rows(r["top_codes"]) == TOP_CODES
    assert rows(r["top_codes_binned"]) == TOP_CODES_BINNED
    assert rows(r["top_codes_total"]) == [(sum(n for _, n in TOP_CODES),)]
    assert {c: t for c, _, _, t in rows(r["fines"])} == FINES
