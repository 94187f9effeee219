"""Column-expression builders: everything here returns a ``Column``."""

from facets.functions.binning import (
    EQUAL_4H_BINS,
    REFERENCE_BINS,
    SEASONS,
    Bin,
    bin_case_sql,
    bin_column,
    bin_lookup,
    bins_lookup,
    bins_of_table,
    equal_bins,
)
from facets.functions.clock import CLOCK12_PATTERN, clock12_sql, clock_parts, parse_clock12
from facets.functions.compare import matches, number_of
from facets.functions.dates import in_year, with_date_parts

__all__ = [
    "Bin", "REFERENCE_BINS", "SEASONS", "EQUAL_4H_BINS", "equal_bins", "bin_column", "bin_case_sql", "bin_lookup", "bins_lookup",
    "bins_of_table", "number_of",
    "CLOCK12_PATTERN", "clock_parts", "parse_clock12", "clock12_sql", "matches", "in_year",
    "with_date_parts",
]
