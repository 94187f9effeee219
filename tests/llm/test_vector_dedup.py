import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from facets.llm import vector_dedup as d


def brute(rows, least=0.9):
    """(id, number of links, component) of each row, by all pairs in double precision."""
    good = [k for k, (i, v) in enumerate(rows)
            if i is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(c != 0 for c in v)]
    links = {k: set() for k in range(len(rows))}
    for size in {len(rows[k][1]) for k in good}:
        at = [k for k in good if len(rows[k][1]) == size]
        m = np.array([rows[k][1] for k in at], float)
        m /= abs(m).max(1)[:, None]
        m /= np.linalg.norm(m, axis=1)[:, None]
        for a, b in np.argwhere(m @ m.T >= least).tolist():
            if a != b:
                links[at[a]].add(at[b])
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    first = {}
    for k in good:
        for o in [*links[k], first.setdefault(rows[k][0], k)]:
            root[find(o)] = find(k)
    low = {}
    for k in good:
        low[find(k)] = min(low.get(find(k), rows[k][0]), rows[k][0])
    return sorted(((i, len(links[k]), low[find(k)] if k in low or find(k) in low else i) for k, (i, _) in enumerate(rows)),
                  key=lambda r: (r[0] is None, r))


def result(df):
    rows = df.collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in rows)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in rows), key=lambda r: (r[0] is None, r))


def turned(rng, v, cosine):
    """A random unit vector at the given cosine of ``v``."""
    u = rng.normal(size=len(v))
    u -= (u @ v) * v / (v @ v)
    return cosine * v / np.linalg.norm(v) + math.sqrt(1 - cosine * cosine) * u / np.linalg.norm(u)


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v]) for i, v in rows],
                                 "vec_id long, embedding array<double>")


@pytest.mark.parametrize(("dims", "seed"), [(64, 1), (20, 2)])
def test_against_all_pairs(shipped, dims, seed):
    """Pairs at every cosine, a large tight group, a loose one around it, equal vectors and strangers."""
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(size=dims)) for i in range(300)]
    for k in range(300):
        rows.append((len(rows), turned(rng, rows[k][1], rng.uniform(0.85, 1))))
    centre = rng.normal(size=dims)
    rows += [(1000 + k, turned(rng, centre, 0.995)) for k in range(300)]
    rows += [(2000 + k, turned(rng, centre, rng.uniform(0.88, 0.99))) for k in range(150)]
    rows += [(3000 + k, rows[5][1] * (1 if k % 2 else 3)) for k in range(40)]
    order = rng.permutation(len(rows))
    rows = [(rows[k][0], rows[k][1].tolist()) for k in order]
    want = brute(rows)
    got = result(d.near_vectors(frame(shipped, rows).repartition(4)))
    missed = [(g, w) for g, w in zip(got, want, strict=True) if g != w]
    assert not missed
    assert sum(w[1] for w in want) > 90_000


def test_odd_rows(shipped):
    nan, inf = math.nan, math.inf
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.01]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [-0.0, 1.0]), (7, [0.0, 1.0]), (8, [nan, 1.0]),
            (9, [inf, 1.0]), (10, [None, 1.0]), (None, [1.0, 0.0]), (None, None), (2, [1.0, 0.01]), (11, [1.0]), (12, [5.0]), (13, [-1.0]),
            (14, [1.0, 0.0, 0.0]), (6, [-1.0, 0.0]), (15, [-1.0, 0.001]), (16, [1e-300, 0.0]), (17, [1e150, 1e150])]
    docs = frame(shipped, rows)
    for name in ("id", "v", "h", "c", "centre", "bucket", "component"):
        docs = docs.withColumn(name, F.lit("clash"))
    got, want = result(d.near_vectors(docs)), brute(rows)
    assert got == want
    assert d.near_vectors(frame(shipped, [])).count() == 0
    assert result(d.near_vectors(frame(shipped, [(3, None)]))) == [(3, 0, 3)]


def test_copies_stand_in_few_rows(shipped):
    """A third of all rows near one vector: groups, not pairs, are compared."""
    rng = np.random.default_rng(6)
    centre = rng.normal(size=64)
    rows = [(i, (turned(rng, centre, 0.99) if i % 3 == 0 else rng.normal(size=64)).tolist()) for i in range(1500)]
    classes = frame(shipped, rows).select(F.col("vec_id").alias("c"), F.col("embedding").alias("v"))
    hashed = classes.mapInArrow(d._hashed(d.tables_for(64, 2, 0.9), 2), "c long, v array<double>, own array<long>, looks array<long>, s0 long, s1 long")
    placed = d.grouped(hashed, math.acos(0.9) / 2 - d.SLACK, d.ROUNDS).collect()
    assert len(placed) == 1500
    sizes = {}
    for r in placed:
        sizes[r.centre] = sizes.get(r.centre, 0) + 1
    assert len(sizes) < 1010 and max(sizes.values()) > 450


def test_hadamard_keeps_lengths_and_tables_find_links():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(50, 32))
    assert np.allclose(np.linalg.norm(d.hadamard(x), axis=1), np.linalg.norm(x, axis=1))
    assert np.allclose(d.hadamard(d.hadamard(x)), x)
    tables = d.tables_for(64, 2, 0.9)
    a = rng.normal(size=(4000, 64))
    b = np.array([turned(rng, v, 0.9) for v in a])
    (own_a, look_a), (own_b, look_b) = d.buckets(a, tables, 2), d.buckets(b, tables, 2)
    missed = sum(not (set(p.tolist()) & set(q.tolist()) or set(p.tolist()) & set(s.tolist()) or set(q.tolist()) & set(r.tolist()))
                 for p, q, r, s in zip(own_a, own_b, look_a, look_b, strict=True))
    assert missed <= 8
    assert d.parts_for(1000, 64) == 2 and d.parts_for(10**6, 64) == 3 and d.parts_for(10**9, 64) == 4


def test_sketch_allows_links():
    rng = np.random.default_rng(3)
    a = rng.normal(size=(3000, 64))
    b = np.array([turned(rng, v, 0.9) for v in a])
    differ = np.unpackbits((d.sketches(a) ^ d.sketches(b)).view(np.uint8), axis=1).sum(1)
    share = math.acos(0.9) / math.pi
    assert (differ <= d.BITS * share + 6 * math.sqrt(d.BITS * share * (1 - share))).all()


