import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from facets.llm import bpe, fingerprints, line_dedup, mixing
from facets.llm.queries import default_vocabulary
from tests.llm.helpers import empty_documents, odd_documents, shingle_set

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(default_vocabulary())


def test_bpe_equals_the_library_on_documents(shipped, library):
    docs = shipped.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    out = bpe.encode_decode(docs, default_vocabulary()).collect()
    assert len(out) == len(texts)
    for r in out:
        want = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.ids == want
        assert r.decoded == library.decode(want, skip_special_tokens=False)


def test_bpe_odd_rows_and_digests(shipped, library):
    docs = odd_documents(shipped)
    want = Counter()
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        want[r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
             hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    got = Counter(tuple(r) for r in bpe.encode_decode(docs, default_vocabulary(), result=bpe.DIGESTS).collect())
    assert got == want
    assert bpe.encode_decode(empty_documents(shipped), default_vocabulary()).count() == 0


def test_bpe_random_strings(library):
    v = bpe._vocabulary(bpe.read_spec(default_vocabulary()))
    rng = random.Random(4)
    letters = "aaabcdeefinorstt  'sre'll0123½éÉΣσßİ\n\u00a0\u0301\u200b漢字<|endoftext|>!!..ё𝒳👍🏽ﬁ"
    for n in range(4000):
        s = "".join(rng.choice(letters) for _ in range(rng.randrange(0, 40))) + ("<|startoftext|>'S tail" if n % 5 == 0 else "")
        assert v.encode(s).tolist() == library.encode(s, add_special_tokens=False).ids, s


def test_bpe_tables_start_anew(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    v = bpe.Vocabulary(__import__("json").loads(bpe.read_spec(default_vocabulary())))
    text = "many different words in one text and then again many different words"
    assert v.encode(text).tolist() == v.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_decode_rows(shipped):
    rows = shipped.createDataFrame([(1, [320, 1125]), (2, []), (3, None)], "doc_id long, ids array<int>")
    out = {r.doc_id: r.decoded for r in bpe.decode(rows, default_vocabulary()).collect()}
    v = bpe._vocabulary(bpe.read_spec(default_vocabulary()))
    assert out == {1: v.decode([320, 1125]), 2: "", 3: ""}


def ring(rows):
    """Rows in falling order of ids, nulls last, equal ids by text."""
    return sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))


@pytest.mark.parametrize("odd", [False, True])
def test_edited_neighbours(shipped, odd):
    docs = odd_documents(shipped) if odd else shipped.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(5)
    order = ring([(r.doc_id, r.text) for r in docs.collect()])
    want = Counter()
    sets, truth = {}, {}
    for (i, t), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        want[i, len(t), hashlib.sha256(edited.encode()).hexdigest()] += 1
        a, b, c = (shingle_set(x, 5) for x in (t, edited, after))
        truth[i] = tuple(len(a & x) / len(a | x) if a | x else 1.0 for x in (b, c))
        sets[i] = t
    out = fingerprints.edited_neighbours(docs).collect()
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in out) == want
    off = [abs(r.near_edited - truth[r.doc_id][0]) for r in out if not odd] + [abs(r.near_next - truth[r.doc_id][1]) for r in out if not odd]
    if not odd:
        assert np.mean(off) < 0.03 and max(off) < 0.2
        by_text = defaultdict(set)
        for r in out:
            by_text[sets[r.doc_id]].add(r.fingerprint)
        assert all(len(x) == 1 for x in by_text.values())


def test_edited_neighbours_small_tables(shipped):
    assert fingerprints.edited_neighbours(empty_documents(shipped)).count() == 0
    one = shipped.createDataFrame([(5, "a b c d e f")], "doc_id long, text string")
    r = fingerprints.edited_neighbours(one).first()
    assert r.near_next == 1.0 and r.edited_sha256 == hashlib.sha256(b"a b c a b c").hexdigest()


def test_sketch_estimates_and_merges(shipped):
    rng = random.Random(9)
    a = [f"x{rng.random()}" for _ in range(4000)]
    x, y = " ".join(a), " ".join(a[:3000] + [f"y{rng.random()}" for _ in range(1000)])
    s, t = fingerprints.sketch_texts([x, y])
    union, common = len(shingle_set(x, 5) | shingle_set(y, 5)), len(shingle_set(x, 5) & shingle_set(y, 5))
    assert abs(fingerprints.resemblance(s, t) - common / union) < 0.15
    assert abs(fingerprints.containment(s, t) - 0.75) < 0.15
    assert abs(fingerprints.distinct_count(s) / 3996 - 1) < 0.3
    docs = shipped.createDataFrame([(1, x, "k"), (2, y, "k"), (3, "few words", None)], "doc_id long, text string, k string")
    parts = fingerprints.sketches(docs).join(docs.select("doc_id", "k"), "doc_id")
    merged = {r.k: r.sketch for r in fingerprints.merge_sketches(parts, "k").collect()}
    assert merged["k"] == fingerprints.merged(s, t).tolist()
    assert len(merged[None]) == 1


def test_line_dedup_against_python(shipped):
    docs = odd_documents(shipped).where("doc_id is not null").dropDuplicates(["doc_id"]).select("doc_id", "text", "source")
    more = [(1000 + i, f"boiler \nown {i}\n\n boiler\t\nold {i % 40}", "big" if i % 3 else None) for i in range(300)]
    docs = docs.unionByName(shipped.createDataFrame(more, "doc_id long, text string, source string")).repartition(4)
    rows = docs.collect()
    pages, hosts = defaultdict(set), Counter(r.source for r in rows)

    def key(line):
        return line.replace("\t", " ").replace("\r", " ").strip(" ")

    for r in rows:
        for line in (r.text or "").split("\n"):
            if key(line):
                pages[r.source, key(line)].add(r.doc_id)
    gone = {k for k, ids in pages.items() if len(ids) >= 3 and len(ids) > 0.02 * hosts[k[0]]}
    assert gone
    for r, want in ((x, next(w for w in rows if w.doc_id == x.doc_id)) for x in line_dedup.drop_boilerplate(docs).collect()):
        lines = (want.text or "").split("\n")
        kept = [x for x in lines if (want.source, key(x)) not in gone]
        if want.text is None:
            assert (r.n_lines, r.n_dropped, r.clean_text) == (0, 0, None)
        else:
            assert (r.n_lines, r.n_dropped, r.clean_text) == (len(lines), len(lines) - len(kept), "\n".join(kept))


def test_line_dedup_odd_and_empty(shipped):
    docs = odd_documents(shipped)
    assert line_dedup.drop_boilerplate(docs).count() == docs.count()
    assert line_dedup.drop_boilerplate(empty_documents(shipped)).count() == 0


def test_line_dedup_has_no_python(shipped):
    plan = line_dedup.drop_boilerplate(odd_documents(shipped))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_capped_targets():
    assert mixing.capped_targets([100, 100, 100], [5, 2, 1], 3, 300) == pytest.approx([187.5, 75, 37.5])
    targets = mixing.capped_targets([10, 1000, 0], [5, 2, 1], 3, 1010)
    assert targets == pytest.approx([30, 980, 0])
    assert mixing.capped_targets([], [], 3, 0) == []


def best_flow(capacity, members, quotas, copies):
    """Largest flow, then least cost, by trying all whole flows."""
    best = None

    def cost(n, cap):
        return sum(min(max(n - c * cap, 0), cap) * (c + 1) for c in range(copies))

    def go(p, left, used):
        nonlocal best
        if p == len(capacity):
            key = (-sum(sum(u) for u in used), sum(cost(sum(u), c) for u, c in zip(used, capacity, strict=True)))
            best = key if best is None or key < best else best
            return

        def give(i, room, rest, mine):
            if i == len(members[p]):
                go(p + 1, rest, [*used, mine])
                return
            s = members[p][i]
            for n in range(min(room, rest[s]) + 1):
                after = list(rest)
                after[s] -= n
                give(i + 1, room - n, after, [*mine, n])

        give(0, capacity[p] * copies, left, [])

    go(0, list(quotas), [])
    return best


def test_route_is_optimal():
    rng = random.Random(2)
    for _ in range(25):
        capacity = [rng.randrange(0, 4) for _ in range(3)]
        members = [sorted(rng.sample(range(2), rng.randrange(0, 3))) for _ in range(3)]
        quotas = [rng.randrange(0, 7) for _ in range(2)]
        flows = mixing.route(capacity, members, quotas, 3)
        total = [sum(f.values()) for f in flows]
        cost = sum(sum(min(max(n - c * cap, 0), cap) * (c + 1) for c in range(3)) for n, cap in zip(total, capacity, strict=True))
        assert (-sum(total), cost) == best_flow(capacity, members, quotas, 3)
        for s in range(2):
            assert sum(f.get(s, 0) for f in flows) <= quotas[s]


def test_mix_reaches_targets(shipped):
    docs = shipped.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mixing.mix_report(docs, mixing.cyclic_weights(5, 2, 1)).collect()
    again = mixing.mix_report(docs.repartition(3), mixing.cyclic_weights(5, 2, 1)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    by = defaultdict(list)
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in rows:
        assert r.size == len(re.findall(r"[^\x20\x09-\x0d]+", text[r.doc_id])) and 0 <= r.taken <= 3 * r.size
        by[r.source].append(r)
    names = sorted(by)
    sizes = [sum(r.size for r in by[s]) for s in names]
    want = mixing.capped_targets(sizes, [(5, 2, 1)[i % 3] for i in range(len(names))], 3, sum(sizes))
    for s, n, t in zip(names, sizes, want, strict=True):
        assert {(r.source_size, r.target) for r in by[s]} == {(n, t)}
        assert abs(sum(r.taken for r in by[s]) - t) <= max(r.size for r in by[s]) / 2 + 1


def test_mix_overlapping_sources(shipped):
    docs = shipped.createDataFrame(
        [(i, "w " * 10, ["a"] if i < 50 else ["a", "b"] if i < 60 else ["b", None] if i < 70 else []) for i in range(80)],
        "doc_id long, text string, source array<string>")
    found = mixing.mix(docs, lambda names: [1.0] * len(names))
    assert [s for s, *_ in found.sources] == ["a", "b", None]
    assert [n for _, n, *_ in found.sources] == [600, 200, 100]
    for _, _, target, routed in found.sources:
        assert abs(target - routed) <= 1
    copies = {r.doc_id: r[f"{found.prefix}copies"] for r in found.rows.collect()}
    assert max(copies.values()) <= 3 and all(copies[i] == 0 for i in range(70, 80))
    assert sum(copies.values()) * 10 == pytest.approx(sum(r for *_, r in found.sources), abs=30)


def test_mix_odd_rows(shipped):
    docs = odd_documents(shipped)
    out = mixing.mix_report(docs, mixing.cyclic_weights(5, 2, 1))
    assert out.count() == docs.count()
    clash = docs.withColumnRenamed("digest", "_mix_size").withColumnRenamed("token", "target")
    assert mixing.mixed_documents(clash, mixing.cyclic_weights(5, 2, 1)).columns == clash.columns
    mixed = mixing.mixed_documents(docs, mixing.cyclic_weights(5, 2, 1))
    assert mixed.columns == docs.columns
    assert mixing.mixed_documents(empty_documents(shipped), mixing.cyclic_weights(5, 2, 1)).count() == 0
