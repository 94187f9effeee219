import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

FIXTURES = os.path.join(ROOT, "tests", "fixtures")
SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from facets.session import ensure_checkpoint_dir

    s = (SparkSession.builder.master("local[*]").appName("facets-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def citations_path():
    return os.path.join(FIXTURES, "citations.csv")


@pytest.fixture(scope="session")
def raw(spark, citations_path):
    from facets.plans.citations import load_citations

    return load_citations(spark, citations_path)


def rows(df, *cols):
    """Rows as plain tuples (optionally a projection), in frame order."""
    if cols:
        df = df.select(*cols)
    return [tuple(r) for r in df.collect()]


def as_dict(df, key, value):
    return {r[key]: r[value] for r in df.collect()}
