"""Command line: ``python -m facets report CSV OUT_DIR [--landed PATH] [--date-format FMT ...]``.

Runs the whole citation analysis on the session ``spark-submit`` (or the
local defaults) provides and writes every answer as Parquet under OUT_DIR.
"""

from __future__ import annotations

import argparse

from facets.plans.citations import run_citation_report
from facets.session import cluster_session


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="python -m facets")
    sub = ap.add_subparsers(dest="cmd", required=True)
    rep = sub.add_parser("report", help="load, check, clean, land and answer every question")
    rep.add_argument("csv")
    rep.add_argument("out_dir")
    rep.add_argument("--landed", default=None, help="where to land the cleaned table (default: spark.checkpoint.dir)")
    rep.add_argument("--date-format", action="append", default=None, help="Issue Date layout(s), tried in order")
    rep.add_argument("--clock-policy", choices=("as_written", "standard"), default="as_written")
    args = ap.parse_args(argv)

    spark = cluster_session("facets-report")
    paths = run_citation_report(spark, args.csv, args.out_dir, landed_path=args.landed,
                                date_formats=tuple(args.date_format or ("yyyy-MM-dd",)),
                                clock_policy=args.clock_policy)
    for name, path in paths.items():
        print(f"{name}\t{path}")


if __name__ == "__main__":
    main()
