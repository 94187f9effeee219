"""citation_report against a plain-Python model of the same steps on the fixture CSV."""

import csv
import datetime as dt
import os
from collections import Counter

from conftest import FIXTURES, rows
from test_properties import reference_hour

from facets.plans.citations import citation_report, clean_citations

BINS = [("Midnight", 0, 4, True), ("Early Morning", 4, 6, False), ("Morning", 6, 11, False),
        ("Afternoon", 11, 16, False), ("Evening", 16, 20, False), ("Night", 20, 23, False)]


def _int(v):
    return int(v) if v not in ("", None) else None


def model_rows():
    out = []
    with open(os.path.join(FIXTURES, "citations.csv")) as fh:
        for r in csv.DictReader(fh):
            d = dt.date.fromisoformat(r["Issue Date"]) if r["Issue Date"] else None
            vp, ip, code = _int(r["Violation Precinct"]), _int(r["Issuer Precinct"]), _int(r["Violation Code"])
            if d is None or d.year != 2017 or vp in (None, 0) or ip in (None, 0) or code in (None, 0):
                continue
            state = r["Registration State"] or None
            h = reference_hour(r["Violation Time"] or None)
            b = None if h is None else next((n for n, lo, hi, closed in BINS
                                            if (h >= lo if closed else h > lo) and h <= hi), None)
            m = d.month
            season = "Winter" if m <= 3 or m >= 11 else "Summer" if m <= 6 else "Rainy"
            out.append({"summons": int(r["Summons Number"]), "state": "NY" if state == "99" else state,
                        "code": code, "body": r["Vehicle Body Type"] or None, "make": r["Vehicle Make"] or None,
                        "vp": vp, "ip": ip, "hour": h, "bin": b, "season": season})
    return out


def ranked(counter, k, desc=True):
    key = (lambda kv: (-kv[1], kv[0] is not None, kv[0])) if desc else (lambda kv: (kv[1], kv[0] is not None, kv[0]))
    return sorted(counter.items(), key=key)[:k]


def test_report_matches_model(raw):
    m = model_rows()
    r = citation_report(clean_citations(raw))
    assert rows(r["total_tickets"])[0][0] == len(m)
    assert rows(r["code_top"]) == ranked(Counter(x["code"] for x in m), 6)
    assert rows(r["body_top"]) == ranked(Counter(x["body"] for x in m), 5)
    assert rows(r["body_bottom"]) == ranked(Counter(x["body"] for x in m), 5, desc=False)
    assert rows(r["make_top"]) == ranked(Counter(x["make"] for x in m), 5)
    assert rows(r["make_bottom"]) == ranked(Counter(x["make"] for x in m), 5, desc=False)
    assert rows(r["violation_precinct_top"]) == ranked(Counter(x["vp"] for x in m), 6)
    assert rows(r["issuer_precinct_top"]) == ranked(Counter(x["ip"] for x in m), 6)
    binned = [x for x in m if x["bin"] is not None]
    assert sorted(rows(r["bin_counts"])) == sorted(Counter(x["bin"] for x in binned).items())
    assert r["unbinned"].count() == len(m) - len(binned)
    per_bin = []
    for b in sorted({x["bin"] for x in binned}):
        top = ranked(Counter(x["code"] for x in binned if x["bin"] == b), 3)
        per_bin += [(b, c, n, i + 1) for i, (c, n) in enumerate(top)]
    assert sorted(rows(r["per_bin_top_codes"])) == sorted(per_bin)
    assert rows(r["top_codes_binned"]) == ranked(Counter(x["code"] for x in binned), 3)
    assert sorted(rows(r["season_counts"])) == sorted(Counter(x["season"] for x in m).items())
    per_season = []
    for s in sorted({x["season"] for x in m}):
        top = ranked(Counter(x["code"] for x in m if x["season"] == s), 3)
        per_season += [(s, c, n, i + 1) for i, (c, n) in enumerate(top)]
    assert sorted(rows(r["per_season_top_codes"])) == sorted(per_season)
    top3 = ranked(Counter(x["code"] for x in m), 3)
    assert rows(r["top_codes"]) == top3
    assert rows(r["top_codes_total"]) == [(sum(n for _, n in top3),)]
    fines = {21: 55, 38: 50, 14: 115}
    assert sorted(rows(r["fines"])) == sorted((c, n, fines.get(c), n * fines[c] if c in fines else None)
                                              for c, n in top3)
    top_codes = {c for c, _ in ranked(Counter(x["code"] for x in binned), 3)}
    pairs = Counter((x["code"], x["bin"]) for x in binned if x["code"] in top_codes)
    assert sorted(rows(r["bins_of_top_codes"])) == sorted((c, b, n) for (c, b), n in pairs.items())
    mode = {}
    for c in top_codes:
        (b, n), = ranked(Counter(x["bin"] for x in binned if x["code"] == c), 1)
        mode[c] = (b, n)
    assert {c: (b, n) for c, b, n in rows(r["mode_bin_of_top_codes"])} == mode
    assert rows(r["distinct_summons"]) == [(len(m), len({x["summons"] for x in m}), True)]
    assert rows(r["unique_states"]) == [(len({x["state"] for x in m if x["state"] is not None}),)]
