import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def shipped(spark):
    """The session, with this package importable in its Python workers."""
    from facets.llm.common import ship_package

    ship_package(spark)
    return spark
