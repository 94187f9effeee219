"""The dirty clock queries reach the branches they stand for."""

from conftest import SF001

from facets.plans.supplied import QUERIES, dirty_bins, dirty_clock


def test_dirty_text_gives_null_hours_and_dropped_rows(spark):
    total = dirty_clock(spark, SF001).count()
    for name in ("clock12_dirty_as_written", "clock12_dirty_standard"):
        by_hour = {r.hour: r.n for r in QUERIES[name](spark, SF001).collect()}
        assert by_hour[None] > 0 and len(by_hour) > 10 and sum(by_hour.values()) == total
    assert QUERIES["dirty_time_nulls"](spark, SF001).first().n_null > 0
    kept = sum(r.n for r in QUERIES["dirty_bins_dropna"](spark, SF001).collect())
    outside = QUERIES["dirty_unbinned"](spark, SF001).count()
    assert 0 < kept < total and kept + outside == total
    assert dirty_bins(spark, SF001).where("hour is null").count() > QUERIES["dirty_time_nulls"](spark, SF001).first().n_null
