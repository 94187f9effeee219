"""Each stage of the pipeline against plain Python on the stage's own input."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from facets.llm import mixing, toxicity
from facets.llm.common import documents, read_table, text_chunks
from facets.llm.queries import default_vocabulary
from tests.llm.helpers import empty_documents, near_components, odd_documents

SF = "/root/testdata/sf0.001"
tokenizers = pytest.importorskip("tokenizers")


def toxic_by_hand(chain, text):
    """The chain on one text: words and beginnings one by one, then the sums."""
    seen = set()
    for _, data, offs in text_chunks(pa.array([text or ""])):
        _, bucket = toxicity.word_features(data, offs)
        seen = set(bucket.tolist())
    at = [i for i, b in enumerate(chain.buckets.tolist()) if b in seen]
    odds = []
    for w in chain.weights:
        z = sum(w[i] for i in at) + sum(o * x for o, x in zip(odds, w[len(chain.buckets):-1], strict=True)) + w[-1]
        odds.append(min(max(z, -8), 8))
    return 1 / (1 + np.exp(-odds[-1])) >= chain.threshold


def test_stages_against_plain_python(shipped, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mixing", "bpe"]
    kept = [documents(shipped, SF)]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(shipped, kept[-1], SF)
        assert k == 4 or out.columns == kept[0].columns
        out.write.parquet(str(tmp_path / str(k)))
        kept.append(shipped.read.parquet(str(tmp_path / str(k))))
    rows = [x.collect() for x in kept]

    chain = toxicity.fit(documents(shipped, SF), read_table(shipped, SF, "labels"))
    assert {r.doc_id for r in rows[1]} == {r.doc_id for r in rows[0] if not toxic_by_hand(chain, r.text)}
    assert len(rows[1]) < len(rows[0])

    first = {}
    for r in sorted(rows[1], key=lambda r: r.doc_id):
        first.setdefault(re.sub(r"[\x20\x09-\x0d]+", " ", r.text), r)
    assert sorted(rows[2]) == sorted(first.values()) and len(rows[2]) < len(rows[1])

    component = near_components({r.doc_id: r.text for r in rows[2]}, 5, 80)
    assert sorted(rows[3]) == sorted(r for r in rows[2] if component[r.doc_id] == r.doc_id)

    sizes = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0d]+", r.text)) for r in rows[3]}
    by_source, taken, largest = Counter(), Counter(), defaultdict(int)
    for r in rows[3]:
        by_source[r.source] += sizes[r.doc_id]
        largest[r.source] = max(largest[r.source], sizes[r.doc_id])
    for r in rows[4]:
        taken[r.source] += sizes[r.doc_id]
    names = sorted(by_source)
    targets = mixing.capped_targets([by_source[s] for s in names], [(5, 2, 1)[i % 3] for i in range(len(names))], 3, sum(by_source.values()))
    for s, t in zip(names, targets, strict=True):
        assert abs(taken[s] - t) <= largest[s] / 2 + 1
    assert max(Counter(r.doc_id for r in rows[4]).values()) <= 3
    assert set(rows[4]) <= set(rows[3])

    library = tokenizers.Tokenizer.from_file(default_vocabulary())
    want = Counter()
    for r in rows[4]:
        ids = library.encode(r.text, add_special_tokens=False).ids
        want[r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
             hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    assert Counter(map(tuple, rows[5])) == want


@pytest.mark.parametrize("case", ["odd", "empty"])
def test_each_stage_on_odd_and_empty_tables(shipped, tmp_path, case):
    """Null and repeated ids, null, empty and very long texts, clashing columns; no row at all."""
    docs = odd_documents(shipped) if case == "odd" else empty_documents(shipped)
    if case == "odd":
        extra = [(50, "long " * 300_000, "en", "s1", 5), (51, "long " * 300_000, "en", "s1", 5), (7, "w x y z v u t s", None, None, None)]
        docs = docs.unionByName(shipped.createDataFrame(extra, docs.select("doc_id", "text", "lang", "source", "n_chars").schema), allowMissingColumns=True)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(shipped, docs, SF)
        path = str(tmp_path / name)
        out.write.parquet(path)
        kept = shipped.read.parquet(path)
        if name == "bpe":
            assert kept.count() == docs.count()
        else:
            assert kept.columns == docs.columns
            assert {str(r.text) for r in kept.select("text").collect()} <= {str(r.text) for r in docs.select("text").collect()}
            if name == "exact_dedup":
                texts = [re.sub(r"[\x20\x09-\x0d]+", " ", r.text or "") for r in kept.select("text").collect()]
                assert len(texts) == len(set(texts))
                assert set(texts) == {re.sub(r"[\x20\x09-\x0d]+", " ", r.text or "") for r in docs.select("text").collect()}
        docs = kept
    assert (docs.count() > 0) == (case == "odd")


def test_no_text_is_lost_where_an_id_carries_several(shipped):
    """Through exact and near de-duplication each text keeps a copy or a near copy."""
    base = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"v{i}" for i in range(60))
    rows = [(2, base), (4, base), (4, other), (9, other), (9, base + " more"), (4, "third text of four with some more words")]
    docs = shipped.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for stage in (corpus_pipeline.drop_exact, corpus_pipeline.drop_near):
        docs = stage(shipped, docs, SF)
    assert sorted((r.doc_id, r.text) for r in docs.collect()) == sorted([(2, base), (4, other), (4, "third text of four with some more words")])
