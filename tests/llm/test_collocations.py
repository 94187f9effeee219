import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from facets.llm import collocations as c
from tests.llm.helpers import empty_documents, odd_documents


def brute(rows, min_count, most):
    """The contract in plain Python, with counts of all phrases in dictionaries."""
    f, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            total[lang] += len(w)
            for n in (1, 2, 3):
                for i in range(len(w) - n + 1):
                    f[lang][tuple(w[i:i + n])] += 1
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        inside = {q for p, a in candidates.items() if len(p) == 3 for q in (p[:2], p[1:]) if 100 * a >= 50 * counts[q]}
        scored = []
        for p, a in candidates.items():
            if p not in inside:
                score, _, left, right = min((1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(scored)[:most], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


def prose(rng, n, words):
    return [("en" if rng.random() < 0.7 else None if rng.random() < 0.3 else "é", "".join(
        rng.choice(words) + rng.choice([" ", " ", "\t", "  ", ". ", ",", "\n", " A "]) for _ in range(rng.randrange(60)))) for _ in range(n)]


@pytest.mark.parametrize(("most_words", "longest"), [(c.MOST_WORDS, c.LONGEST_WORD), (6, 3), (0, 48)])
def test_against_plain_counts(shipped, most_words, longest):
    """With ids for all words, for some of them (the others as text), and for none."""
    rng = random.Random(11)
    rows = prose(rng, 300, ["the", "of", "Ünd", "x", "long-word", "aB", "漢字", "q" * 70, "one", "two", *[f"r{i}" for i in range(40)]])
    docs = shipped.createDataFrame(rows, "lang string, text string").repartition(5)
    want = brute(rows, 4, 25)
    got = c.collocations(docs, min_count=4, most=25, most_words=most_words, longest_word=longest)
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 40


def test_odd_and_empty_tables(shipped):
    docs = odd_documents(shipped).withColumn("f", docs_clash()).withColumn("phrase", docs_clash())
    rows = [(r.lang, r.text) for r in docs.select("lang", "text").collect()]
    assert sorted(tuple(r) for r in c.collocations(docs, min_count=2).collect()) == brute(rows, 2, 2000)
    assert c.collocations(empty_documents(shipped)).count() == 0
    assert c.collocations(shipped.createDataFrame([(None, None)] * 20, "lang string, text string")).count() == 0


def docs_clash():
    from pyspark.sql import functions as F

    return F.lit("clash")


def test_a_text_longer_than_a_chunk(shipped):
    rng = random.Random(5)
    text = " ".join(rng.choice(["alpha", "beta", "gamma.", "delta", "eps"]) for _ in range(1_000_000))
    rows = [("en", text), ("en", "alpha beta")]
    docs = shipped.createDataFrame(rows, "lang string, text string")
    assert len(text) > c.CHUNK
    assert sorted(tuple(r) for r in c.collocations(docs).collect()) == brute(rows, 10, 2000)


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 64), st.data())
def test_permutation_and_filter_lose_nothing(width, data):
    top = (1 << width) - 1
    found = data.draw(st.dictionaries(st.integers(0, top), st.integers(1, 100_000), max_size=60))
    raw = np.array(sorted(found), np.uint64)
    there = c.permute(raw, width)
    assert len(set(there.tolist())) == len(found) and all(v <= top for v in there.tolist())
    assert c.permute(there, width, back=True).tolist() == raw.tolist()
    counts = np.array([found[v] for v in raw.tolist()], np.int64)
    values, again = c.entries(c.filter_of(raw, counts, width), width) if len(raw) else (raw, counts)
    assert values.tolist() == raw.tolist() and again.tolist() == counts.tolist()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.dictionaries(st.integers(0, 300), st.integers(1, 500), min_size=1, max_size=30), min_size=1, max_size=5))
def test_merging_filters_adds_counters(shards):
    parts = []
    for s in shards:
        keys = np.array(sorted(s), np.uint64)
        parts.append(c.entries(c.filter_of(keys, np.array([s[k] for k in sorted(s)], np.int64), 9), 9))
    values, counts = c.merged(parts)
    want = sum((Counter(s) for s in shards), Counter())
    assert dict(zip(values.tolist(), counts.tolist(), strict=True)) == dict(want) and (np.diff(values.astype(np.int64)) > 0).all()


def test_a_filter_is_compact():
    """An entry of 60 bits takes about half of a plain key and counter of 16 bytes."""
    rng = np.random.default_rng(0)
    values = np.unique(rng.integers(0, 1 << 50, 100_000, dtype=np.uint64))
    assert len(c.filter_of(values, np.ones(len(values), np.int64), 50)) < 7 * len(values)


def test_ids_are_checked_by_the_word_itself():
    langs, words = pa.array(["a", "a", "b"], pa.large_string()), pa.array([b"x", b"y", b"x"], pa.large_binary())
    keys = c._keys(langs, words)
    order = np.argsort(keys)
    d = c.Dictionary(keys[order], langs.take(pa.array(order)), words.take(pa.array(order)), np.ones(3, np.int64), np.zeros(0, np.uint64))
    ids = d.ids(pa.array(["a", "b", "b", "c"], pa.large_string()), pa.array([b"x", b"x", b"y", b"x"], pa.large_binary()))
    assert ids[0] and ids[1] and ids[0] != ids[1] and ids[2] == ids[3] == 0
    d.words = pa.array([b"other"] * 3, pa.large_binary())  # the same hash, another word
    assert d.ids(langs, words).tolist() == [0, 0, 0]
