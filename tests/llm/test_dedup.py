import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from facets.llm import exact_dedup, minhash
from facets.llm.common import shingles, text_chunks
from facets.llm.components import connected_components
from tests.llm.helpers import empty_documents, near_components, odd_documents, shingle_set


def normal(text):
    return re.sub(r"[\x20\x09-\x0d]+", " ", text or "")


def test_exact_duplicates_of_odd_rows(shipped):
    docs = odd_documents(shipped)
    rows = docs.select("doc_id", "text").collect()
    groups = defaultdict(list)
    for r in rows:
        groups[normal(r.text)].append(r.doc_id)
    want = Counter()
    for r in rows:
        ids = groups[normal(r.text)]
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        want[(r.doc_id, keep, len(ids), r.doc_id == keep, hashlib.sha256(normal(r.text).encode()).hexdigest())] += 1
    got = Counter(tuple(r) for r in exact_dedup.exact_duplicates(docs).collect())
    assert got == want


def test_exact_duplicates_small_counters(shipped):
    """With few counters some groups are broadcast and the others are shuffled."""
    rng = random.Random(3)
    texts = ["hot"] * 400 + [f"warm {i % 7}" for i in range(200)] + [f"cold {i}" for i in range(300)]
    rng.shuffle(texts)
    docs = shipped.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    out = exact_dedup.exact_duplicates(docs, counters=4).collect()
    first = {}
    for i, t in enumerate(texts):
        first.setdefault(t, i)
    size = Counter(texts)
    assert len(out) == len(texts)
    for r in out:
        assert (r.keep_id, r.group_size, r.kept) == (first[texts[r.doc_id]], size[texts[r.doc_id]], first[texts[r.doc_id]] == r.doc_id)


def test_frequent_values_bound(shipped):
    docs = shipped.createDataFrame([(f"v{i % 50}" if i % 2 else "hot",) for i in range(3000)], "v string").repartition(5)
    found = {r.v for r in exact_dedup.frequent_values(docs, "v", counters=9).collect()}
    assert "hot" in found and len(found) <= 9


def test_drop_exact_keeps_one_row_a_text(shipped):
    docs = odd_documents(shipped)
    kept = exact_dedup.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    texts = [normal(r.text) for r in kept.collect()]
    assert Counter(texts) == Counter({normal(r.text) for r in docs.collect()})


def test_exact_empty(shipped):
    assert exact_dedup.exact_duplicates(empty_documents(shipped)).count() == 0
    assert exact_dedup.drop_exact_duplicates(empty_documents(shipped)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab A\tB\néÉ.", max_size=40), min_size=1, max_size=8), st.integers(1, 5))
def test_shingles_agree_with_sets(texts, width):
    out = []
    for _, data, offs in text_chunks(pa.array(texts), 16):
        h, bounds = shingles(data, offs, width)
        out += [frozenset(h[a:b].tolist()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    sets = [frozenset(shingle_set(t, width)) for t in texts]
    assert [len(x) for x in out] == [len(x) for x in sets]
    for i in range(len(texts)):
        for j in range(i):
            assert len(out[i] & out[j]) == len(sets[i] & sets[j])


def test_signature_is_min_and_max():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    b = np.concatenate((a[:320], rng.integers(0, 1 << 63, 80, dtype=np.uint64)))
    sig = minhash.signatures(np.concatenate((a, b)), np.array([0, 400, 800]), 400)
    true = 320 / 480
    assert abs((sig[0] == sig[1]).mean() - true) < 0.08
    assert (sig[:, 0] <= sig[:, 1]).all()


def copies_with_edits(rng, groups, most):
    """Groups of edited copies around a shared passage, at all similarities."""
    passage = [f"common{i}" for i in range(25)]
    texts = {}
    for _ in range(groups):
        base = [f"w{rng.randrange(10_000)}" for _ in range(rng.randrange(5, 90))] + passage
        for _ in range(rng.randrange(1, most)):
            own = list(base)
            for _ in range(rng.randrange(0, 6)):
                own[rng.randrange(len(own))] = f"e{rng.randrange(10_000)}"
            texts[len(texts)] = " ".join(own)
    return texts


@pytest.mark.parametrize(("seed", "width"), [(1, 4), (2, 5)])
def test_near_duplicates_against_all_pairs(shipped, seed, width):
    texts = copies_with_edits(random.Random(seed), 40, 14)
    docs = shipped.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(6)
    want = near_components(texts, width, 80)
    out = minhash.near_duplicates(docs, width=width).collect()
    assert {r.doc_id: r.component_id for r in out} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)
    assert {r.doc_id: r.n_shingles for r in out} == {i: len(shingle_set(t, width)) for i, t in texts.items()}


def test_prefix_pairs_lose_no_link(shipped):
    """Without any link found before, the prefix filter alone finds all of them."""
    texts = copies_with_edits(random.Random(5), 15, 12)
    docs = shipped.createDataFrame(list(texts.items()), "c long, text string")
    sets = {i: shingle_set(t, 4) for i, t in texts.items()}
    members = shipped.createDataFrame([(i, len(s), i) for i, s in sets.items()], "c long, n long, component long")
    hashed = minhash.hashed_sets(docs, 4)
    found = {(r.a, r.b) for r in minhash.prefix_pairs(members, hashed, 80).collect()}
    links = {(i, j) for i in sets for j in sets if i < j and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
    assert links <= found
    confirmed = {(r.a, r.b) for r in minhash.confirmed(minhash.prefix_pairs(members, hashed, 80), hashed, 80).collect()}
    assert confirmed == links


def test_near_duplicates_of_odd_rows(shipped):
    docs = odd_documents(shipped)
    out = minhash.near_duplicates(docs).collect()
    assert len(out) == docs.count()
    by_id = defaultdict(set)
    for r in out:
        by_id[r.doc_id].add(r.component_id)
        assert r.kept == (r.doc_id == r.component_id)
    assert by_id[None] == {None}
    assert by_id[0] == {0} and by_id[1] == {1} and by_id[2] == {2}  # no words: linked with nothing
    assert by_id[4] == {4}  # two texts, one node
    assert by_id[13] == by_id[12] == {12}
    kept = minhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert minhash.near_duplicates(empty_documents(shipped)).count() == 0


def ids_with_several_texts(rng, n):
    """Rows whose ids repeat, with other texts, near copies, equal texts and empty ones."""
    texts = list(copies_with_edits(rng, 12, 6).values()) + ["", None, "one two"]
    return [(rng.randrange(n // 2), rng.choice(texts)) for _ in range(n)] + [(None, texts[0]), (None, "")]


def test_rows_of_one_id_share_a_component(shipped):
    base = " ".join(f"w{i}" for i in range(40))
    other = " ".join(f"v{i}" for i in range(40))
    docs = shipped.createDataFrame([(2, base), (4, base), (4, other), (9, other), (9, ""), (11, "")], "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in minhash.near_duplicates(docs).collect()} == {(2, 2), (4, 2), (9, 2), (11, 11)}
    assert sorted(tuple(r) for r in minhash.drop_near_duplicates(docs).collect()) == [(2, base), (4, other), (9, ""), (11, "")]


@pytest.mark.parametrize("seed", [1])
def test_repeated_ids_against_plain_python(shipped, seed):
    rows = ids_with_several_texts(random.Random(seed), 90)
    docs = shipped.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, set_id string").repartition(5)
    sets = [shingle_set(t, 5) for _, t in rows]
    near = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j] and rows[i][0] is not None and rows[j][0] is not None
            and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]

    def reach(links):
        root = list(range(len(rows)))
        for _ in rows:
            for i, j in links:
                root[i] = root[j] = min(root[i], root[j])
        return root

    same_id = [(i, j) for i in range(len(rows)) for j in range(i) if rows[i][0] == rows[j][0] and rows[i][0] is not None]
    whole = reach(near + same_id)
    lowest = {}
    for (i, _), g in zip(rows, whole, strict=True):
        lowest[g] = i if i is None else min(i, lowest.get(g, i))
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs).collect())
    assert got == Counter((i, len(s), lowest[g]) for (i, _), s, g in zip(rows, sets, whole, strict=True))

    # one row a group of linked texts stays, or several if they repeat an id and a set
    group = reach(near)
    kept = minhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in kept.collect()]
    assert not Counter(kept) - Counter(rows)
    free = [r for r, s in zip(rows, sets, strict=True) if r[0] is None or not s]
    assert Counter(r for r in kept if r[0] is None or not shingle_set(r[1], 5)) == Counter(free)
    best = defaultdict(set)
    for k, ((i, t), s) in enumerate(zip(rows, sets, strict=True)):
        if i is not None and s:
            best[group[k]].add((i, frozenset(s)))
    stayed = Counter()
    for k, ((i, t), s) in enumerate(zip(rows, sets, strict=True)):
        if i is not None and s and (i, t) in kept:
            stayed[group[k]] += 1
            assert i == min(x for x, _ in best[group[k]])
    assert set(stayed) == set(best)  # no group of texts is lost


def test_components_of_a_long_path(shipped):
    links = [(i, i + 1) for i in range(60)] + [(200, 100), (100, 150), (7, 7), (None, 3), (300, 300)]
    out = {r.id: r.component for r in connected_components(shipped.createDataFrame(links, "a long, b long")).collect()}
    assert out == {**{i: 0 for i in range(61)}, 100: 100, 150: 100, 200: 100, 300: 300}
