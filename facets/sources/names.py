"""Column-name normalisation (metadata only; no data is touched)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def normalize_names(df: DataFrame, pattern: str = " ", replacement: str = "_") -> DataFrame:
    """Rename every column by regex substitution, e.g. spaces to underscores.
    Two columns that would get one name (Spark ignores case) raise an error."""
    names = [re.sub(pattern, replacement, c) for c in df.columns]
    seen: dict[str, str] = {}
    for old, new in zip(df.columns, names, strict=True):
        if seen.setdefault(new.lower(), old) != old:
            raise ValueError(f"columns {seen[new.lower()]!r} and {old!r} would both be named {new!r}")
    return df.toDF(*names)


def rename_prefix(df: DataFrame, old: str, new: str) -> DataFrame:
    """Swap a leading name prefix (``r_name`` -> ``region_name``)."""
    mapping = {c: new + c[len(old):] for c in df.columns if c.startswith(old)}
    return df.withColumnsRenamed(mapping)
