"""DataFrame -> DataFrame operators."""

from facets.operators.bins import each_bin, first_bin
from facets.operators.clean import (
    drop_incomplete,
    drop_sentinels,
    keep_year,
    replace_sentinel,
    replace_with_mode,
    with_clock_hours,
)
from facets.operators.derive import with_bound_columns
from facets.operators.estimate import priced_top_k, total_of_top_k
from facets.operators.profile import (
    check_counts,
    distinct_values,
    duplicates,
    first_rows,
    joined_null_profile,
    null_count,
    null_profile,
    sentinel_profile,
    shape,
    structure,
    structure_with_values,
    unbinned,
    uniqueness,
    value_range,
    year_profile,
)
from facets.operators.rank import (
    bottom_k,
    common_keys,
    frequencies,
    frequency,
    mode_group,
    ranked,
    restrict_to_top_keys,
    slice_top_k,
    top_k,
    top_k_in_top_groups,
    top_k_per_group,
)
from facets.operators.report import chart_rows
from facets.operators.seen import key_uniqueness, rarest_k, repeated_keys
from facets.operators.threshold import mode_group_of_many, slice_top_k_of_many, top_k_of_many, top_k_per_group_of_many

__all__ = [
    "keep_year", "drop_sentinels", "replace_sentinel", "replace_with_mode", "with_clock_hours",
    "drop_incomplete", "priced_top_k", "total_of_top_k", "shape", "structure", "first_rows", "joined_null_profile", "null_profile",
    "sentinel_profile", "check_counts", "year_profile", "uniqueness", "duplicates", "value_range", "distinct_values",
    "null_count", "unbinned", "frequency", "frequencies", "ranked", "top_k", "bottom_k", "slice_top_k", "top_k_per_group",
    "top_k_in_top_groups", "common_keys", "restrict_to_top_keys", "mode_group", "chart_rows", "with_bound_columns",
    "structure_with_values", "repeated_keys", "key_uniqueness", "rarest_k", "top_k_of_many", "slice_top_k_of_many",
    "top_k_per_group_of_many", "mode_group_of_many", "each_bin", "first_bin",
]
