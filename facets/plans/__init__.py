"""Whole analyses composed from the operators.

* ``citations``: the citation analysis end to end - ``load_citations``,
  ``quality_checks``, ``clean_citations``, ``land_cleaned``,
  ``citation_report``, ``register_citation_views``, ``run_citation_report``.
* ``supplied``, ``supplied_keys``: the same questions on the supplied tables
  (``QUERIES``), each paired with DuckDB SQL (``ORACLE``) for the cross-engine check.
"""

from facets.plans import supplied, supplied_keys

__all__ = ["supplied", "supplied_keys"]
