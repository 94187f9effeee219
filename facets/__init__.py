"""facets: frequency and data-quality analytics on Spark DataFrames.

Every operator takes and returns a DataFrame and is built from Spark's own
expressions, so Catalyst prunes, pushes down and plans it.

Subpackages: ``functions`` (Column builders), ``sources`` (CSV/Parquet in,
Parquet and checkpoints out, views), ``operators`` (profiles, cleaning,
rankings, estimates), ``plans`` (whole analyses), ``streaming`` (the same
questions on file streams). Command line: ``python -m facets report CSV OUT``.
"""

__version__ = "0.1.0"
