"""Summarise the executed (adaptive, final) physical plan of every query.

Usage: python tools/plan_summary.py [sf_dir] > PLANS.md (table part)
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

PATTERNS = {
    "hash shuffles": r"Exchange hashpartitioning",
    "single-partition merges": r"Exchange SinglePartition",
    "broadcasts": r"BroadcastExchange",
    "semi joins": r"LeftSemi",
    "sort-merge joins": r"SortMergeJoin",
    "take-ordered": r"TakeOrderedAndProject",
    "partial window limits": r"WindowGroupLimit .*Partial",
    "windows": r"\bWindow \[",
    "expands": r"\bExpand\b",
    "generates": r"\bGenerate\b",
    "scalar subqueries": r"Subquery subquery",
    "python": r"(BatchEvalPython|ArrowEvalPython)",
}


def main_plan(p: str) -> str:
    return p.split("== Initial Plan ==")[0]


def summarise(spark, sf_dir: str):
    from facets.plans.supplied import QUERIES

    rows = []
    for name in sorted(QUERIES):
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = main_plan(df._jdf.queryExecution().executedPlan().toString())
        counts = {k: len(re.findall(v, plan)) for k, v in PATTERNS.items()}
        reads = set()
        for line in plan.splitlines():
            m = re.search(r"FileScan parquet \[([^\]]*)\]", line)
            if not m:
                continue
            cols = re.sub(r"#\d+L?", "", m.group(1))
            table = re.search(r"/([a-z_]+)\.parquet", line)
            pushed = re.search(r"PushedFilters: \[(.*?)(?:\](?:, ReadSchema|$)|\.\.\.)", line)
            txt = f"{table.group(1) if table else '?'}({cols})"
            if pushed and pushed.group(1):
                txt += " where " + pushed.group(1)
            reads.add(txt)
        reads = sorted(reads)
        rows.append((name, counts, reads))
    return rows


if __name__ == "__main__":
    from facets.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session()
    print("| query | shuffles | broadcasts | other operators | scans: table(columns) where pushed filters |")
    print("|---|---|---|---|---|")
    for name, c, reads in summarise(spark, sf):
        other = ", ".join(f"{k} {v}" for k, v in c.items()
                          if v and k not in ("hash shuffles", "broadcasts", "single-partition merges"))
        sh = f"{c['hash shuffles']}" + (f" + {c['single-partition merges']} final merge" if c["single-partition merges"] else "")
        print(f"| `{name}` | {sh} | {c['broadcasts']} | {other or '-'} | {'; '.join(reads)} |")
