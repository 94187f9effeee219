import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from facets.llm import hard_negatives as h


def brute(rows, every, positives=5, negatives=3, low=50, high=95, scale=256):
    """The contract, all scores in whole numbers of any size."""
    seen = {}
    for i, vec, label in rows:
        if i is None or vec is None or label is None or any(c is None or not math.isfinite(c) for c in vec):
            continue
        x = [math.floor(scale * float(c)) for c in vec]
        seen[i] = min(seen.get(i, (label, x)), (label, x))
    out = []
    for a in (i for i in seen if i % every == 0):
        label, x = seen[a]
        scored = [(-sum(p * q for p, q in zip(x, seen[i][1], strict=False)), i) for i in seen if i != a]
        for p, pid in sorted(s for s in scored if seen[s[1]][0] == label)[:positives]:
            fits = sorted(s for s in scored if seen[s[1]][0] != label and low * -p <= 100 * -s[0] <= high * -p)
            out += [(a, pid, rank, nid, -p, -n) for rank, (n, nid) in enumerate(fits[:negatives], 1)]
    return sorted(out)


def vectors(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")


def clustered(rng, n, dims=12):
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(6)]
    rows = []
    for i in range(n):
        c = centres[min(rng.randrange(9), 5)]
        rows.append((i, [float(np.float32(x + rng.gauss(0, 0.15))) for x in c], rng.randrange(4)))
    return rows


@pytest.mark.parametrize(("anchors", "size"), [(1024, 8192), (16, 70)])
def test_against_all_scores(shipped, monkeypatch, anchors, size):
    """Also with blocks so small that there are many of them."""
    monkeypatch.setattr(h, "ANCHORS", anchors)
    monkeypatch.setattr(h, "ROWS", size)
    rows = clustered(random.Random(4), 500)
    rows += [(1000 + k, rows[10][1], k % 3) for k in range(60)]  # ties
    got = h.hard_negatives(vectors(shipped, rows).repartition(4), F.col("id") % 5 == 0).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 5) and len(got) > 300


def test_odd_rows(shipped):
    rng = random.Random(2)
    rows = clustered(rng, 80, 4)
    rows += [(None, [1.0] * 4, 1), (200, None, 1), (205, [1.0, None, 1.0, 1.0], 1), (210, [1.0, math.nan, 1.0, 1.0], 2),
             (215, [math.inf, 0.0, 0.0, 0.0], 2), (220, [1.0, 1.0, 1.0, 1.0], None), (225, [], 1), (230, [0.5], 1), (235, [0.0] * 4, 2),
             (-5, [1.0, -1.0, 0.5, 2.0, 3.0], 1), rows[3], rows[3], (5, [9.0, 9.0, 9.0, 9.0], 3), (5, [9.0, 9.0, 9.0, 8.0], 3)]
    docs = vectors(shipped, rows, "double").withColumn("id", F.lit("clash")).withColumn("x", F.lit("clash")).withColumn("block", F.lit(1))
    got = h.hard_negatives(docs, F.col("id") % 5 == 0).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 5)
    assert h.hard_negatives(vectors(shipped, []), F.col("id") % 5 == 0).count() == 0
    assert h.hard_negatives(vectors(shipped, rows), F.col("id") > 10**6).count() == 0


def test_scores_beyond_doubles_are_exact(shipped):
    rng = random.Random(8)
    rows = [(i, [float(rng.randrange(-10**6, 10**6)) for _ in range(8)], rng.randrange(3)) for i in range(120)]
    got = h.hard_negatives(vectors(shipped, rows, "double"), F.col("id") % 4 == 0).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 4)
    assert max(abs(r.positive_score) for r in got) > 1 << 53


def test_tree_saves_scores_and_bounds_hold(monkeypatch):
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 300, (5, 32))
    x = (centres[rng.integers(0, 5, 200)] + rng.normal(0, 2, (200, 32))).astype(np.int64)
    y = (centres[rng.integers(0, 5, 900)] + rng.normal(0, 2, (900, 32))).astype(np.int64)
    parent = h.spanning_tree(x)
    assert (parent < 0).sum() == 1
    tree = h.TreeScores(x, parent)
    full = h.dots(x, y)
    for at, low, high, exact in tree.rows(y):
        assert (low <= full[at]).all() and (full[at] <= high).all()
        exact(rng.random(low.shape) < 0.1)
    labels, other = rng.integers(0, 3, 200), rng.integers(0, 3, 900)
    windows = [(i, -1, 0, int(0.9 * (x[i] @ x[i])), int(x[i] @ x[i])) for i in range(200)]
    found, scored = h.best_negatives(x, labels, np.arange(200), parent, windows, y, other, np.arange(900), 3)
    assert scored < 0.5 * 200 * 900
    first, _ = h.best_positives(x, labels, np.arange(200), parent, y, other, np.arange(900) + 200, 5)
    monkeypatch.setattr(h, "SLICE", 70)  # what earlier slices hold raises the bar for later ones
    again, _ = h.best_negatives(x, labels, np.arange(200), parent, windows, y, other, np.arange(900), 3)
    second, _ = h.best_positives(x, labels, np.arange(200), parent, y, other, np.arange(900) + 200, 5)
    assert sorted(found) == sorted(again) and sorted(first) == sorted(second)


def test_dots_of_any_size():
    rng = np.random.default_rng(3)
    for most in (100, 1 << 30):
        a, b = rng.integers(-most, most, (7, 5)), rng.integers(-most, most, (9, 5))
        assert h.dots(a, b).tolist() == [[sum(int(p) * int(q) for p, q in zip(r, s, strict=True)) for s in b] for r in a]
    big = np.array([[1 << 40, 1 << 40]])
    assert h.dots(big, np.array([[1 << 40, -(1 << 40) + 1]])).tolist() == [[1 << 40]]
    with pytest.raises(OverflowError):
        h.dots(big, big)
