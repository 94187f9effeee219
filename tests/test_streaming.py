"""Streaming counts equal the batch counts over the same files."""

import os
import shutil

from conftest import FIXTURES, rows

from facets.operators import top_k
from facets.plans.citations import clean_citations, load_citations
from facets.streaming import citation_stream, published, running_counts, start_top_k


def test_stream_top_k_matches_batch(spark, tmp_path):
    src = tmp_path / "incoming"
    src.mkdir()
    shutil.copy(os.path.join(FIXTURES, "citations.csv"), src / "day1.csv")
    out = str(tmp_path / "top")
    q = start_top_k(running_counts(citation_stream(spark, str(src)), "Violation_Code"), "Violation_Code", 3,
                    out, checkpoint=str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    got = rows(published(spark, out, "top").orderBy("n", "Violation_Code", ascending=[False, True]))
    batch = rows(top_k(clean_citations(load_citations(spark, str(src))), "Violation_Code", 3))
    assert got == batch == [(46, 4), (21, 3), (14, 2)]

    # a second file arrives: the restarted query continues from its checkpoint
    shutil.copy(os.path.join(FIXTURES, "citations.csv"), src / "day2.csv")
    q = start_top_k(running_counts(citation_stream(spark, str(src)), "Violation_Code"), "Violation_Code", 3,
                    out, checkpoint=str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    assert rows(published(spark, out, "top").orderBy("n", "Violation_Code", ascending=[False, True])) == \
        [(46, 8), (21, 6), (14, 4)]


def test_stream_cube_answers_match_batch_report(spark, tmp_path):
    from facets.plans.citations import citation_report
    from facets.streaming import running_cube, start_publishing

    src = tmp_path / "incoming"
    src.mkdir()
    shutil.copy(os.path.join(FIXTURES, "citations.csv"), src / "day1.csv")
    out = tmp_path / "answers"
    q = start_publishing(running_cube(citation_stream(spark, str(src))), str(out), checkpoint=str(tmp_path / "ck"))
    q.awaitTermination(120)
    batch = citation_report(clean_citations(load_citations(spark, str(src))), materialize=False)
    for name in ("bin_counts", "per_bin_top_codes", "top_codes_binned"):
        got = rows(published(spark, str(out), name))
        assert sorted(map(str, got)) == sorted(map(str, rows(batch[name]))), name
