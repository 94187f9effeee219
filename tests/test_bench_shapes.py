"""Smoke test of the benchmark's comparisons (they must not break the bench)."""

from conftest import SF001


def test_comparisons_run(spark):
    from tools.script_shapes import comparisons

    done = []
    for parts, whole in comparisons(spark, SF001, lambda df: done.append(df.count())).values():
        parts()
        whole()
    assert len(done) > 20
