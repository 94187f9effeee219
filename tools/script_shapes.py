"""Per-question comparisons for the benchmark: one job per part of a question
against one pass for all of it, on the supplied tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facets.functions import SEASONS
from facets.operators import check_counts, frequencies, frequency, null_profile, top_k, top_k_per_group
from facets.plans.supplied import binned_events, seasoned_orders
from facets.sources import read_table

Run = Callable[[DataFrame], None]


def comparisons(spark: SparkSession, sf_dir: str, run: Run) -> dict[str, tuple[Callable[[], None], Callable[[], None]]]:
    """Question -> (one job per part, one pass)."""
    li, part = read_table(spark, sf_dir, "lineitem"), read_table(spark, sf_dir, "part")
    binned, seasons = binned_events(spark, sf_dir), seasoned_orders(spark, sf_dir)
    columns = ("p_brand", "p_type", "p_size")
    season_names = sorted({s.label for s in SEASONS})
    bins = ("Midnight", "Early Morning", "Morning", "Afternoon", "Evening", "Night")

    def each(parts) -> Callable[[], None]:
        def go() -> None:
            for df in parts():
                run(df)

        return go

    return {
        "null_checks": (each(lambda: [li.where(F.col(c).isNull()).agg(F.count(F.lit(1))) for c in li.columns]),
                        lambda: run(null_profile(li))),
        "zero_checks": (each(lambda: [li.where(F.col(c) == 0).agg(F.count(F.lit(1))) for c in ("l_suppkey", "l_partkey", "l_discount")]),
                        lambda: run(check_counts(li, {c: F.col(c) == 0 for c in ("l_suppkey", "l_partkey", "l_discount")}))),
        "top_per_bin": (each(lambda: [top_k(binned.where(F.col("time_bin") == b), "event_type", 3) for b in bins]),
                        lambda: run(top_k_per_group(binned, "time_bin", "event_type", 3))),
        "top_per_season": (each(lambda: [top_k(seasons.where(F.col("season") == s), "o_orderpriority", 3) for s in season_names]),
                           lambda: run(top_k_per_group(seasons, "season", "o_orderpriority", 3))),
        "several_columns": (each(lambda: [top_k(frequency(part, c), c, 6, by="n") for c in columns]),
                            lambda: run(top_k_per_group(frequencies(part, columns), "column_name", "value", 6, by="n"))),
    }
