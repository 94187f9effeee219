"""12-hour clock text (``hhmmA`` / ``hhmmP``) to an hour of day.

Two policies, both pure built-in expressions:

``as_written``
    What the reference computes: hour text (chars 1-2) read as a number, plus
    12 when chars 5-6 equal ``"P"``, 24 folded to 0, then anything outside
    0..23 set to NULL. Noon and midnight come out swapped (12xxP -> 0,
    12xxA -> 12); an AM suffix with a 24-hour value passes; a NULL or other
    suffix counts as AM; non-numeric text gives NULL (``try_cast``, so ANSI
    mode does not raise). Result is DOUBLE, as in the reference.

``standard``
    The corrected reading: text must be exactly four digits and A/P, hour
    1-12 (0 tolerated), minute 0-59; hour = hh % 12 + 12 for PM. Anything
    else is NULL. Result is INT.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from facets.functions.compare import number_of

POLICIES = ("as_written", "standard")

# Fixed value: the accepted layout of a well-formed clock text.
CLOCK12_PATTERN = r"^[0-9]{4}[AP]$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clock_parts(c: Column | str) -> tuple[Column, Column, Column]:
    """Hour text, minute text and suffix text (1-based chars 1-2, 3-4, 5-6)."""
    c = _col(c)
    return F.substring(c, 1, 2), F.substring(c, 3, 2), F.substring(c, 5, 2)


def parse_clock12(c: Column | str, policy: str = "as_written") -> Column:
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}, got {policy!r}")
    c = _col(c)
    hh, mm, suffix = clock_parts(c)
    if policy == "as_written":
        shift = F.when(suffix == "P", F.lit(12.0)).otherwise(F.lit(0.0))
        h = number_of(hh) + shift
        # 24 folds to 0; then only 0..23 survives (the reference's two steps).
        return F.when(h == 24, F.lit(0.0)).when((h >= 0) & (h <= 23), h)
    hour = number_of(hh, "int")
    minute = number_of(mm, "int")
    ok = c.rlike(CLOCK12_PATTERN) & hour.between(0, 12) & minute.between(0, 59)
    pm = F.substring(c, 5, 1) == "P"
    return F.when(ok, (hour % 12) + F.when(pm, F.lit(12)).otherwise(F.lit(0)))


def clock12_sql(name: str, policy: str = "as_written") -> str:
    """DuckDB/ANSI SQL text of ``parse_clock12`` for oracle queries."""
    if policy == "as_written":
        h = (f"(TRY_CAST(substr({name}, 1, 2) AS DOUBLE) + "
             f"CASE WHEN substr({name}, 5, 2) = 'P' THEN 12.0 ELSE 0.0 END)")
        return f"(CASE WHEN {h} = 24 THEN 0.0 WHEN {h} >= 0 AND {h} <= 23 THEN {h} END)"
    hour = f"TRY_CAST(substr({name}, 1, 2) AS INTEGER)"
    minute = f"TRY_CAST(substr({name}, 3, 2) AS INTEGER)"
    ok = (f"regexp_matches({name}, '{CLOCK12_PATTERN}') AND {hour} BETWEEN 0 AND 12 "
          f"AND {minute} BETWEEN 0 AND 59")
    return (f"(CASE WHEN {ok} THEN ({hour} % 12) + "
            f"CASE WHEN substr({name}, 5, 1) = 'P' THEN 12 ELSE 0 END END)")
