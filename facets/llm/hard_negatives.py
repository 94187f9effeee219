"""Hard negatives: for each anchor and each of its positives, the best rows of
another label that score a given share of what the positive scores.

Every anchor is compared with every row, block by block: a block of anchors
that lie near each other meets a block of rows in one task. Inside it a minimum
spanning tree over the anchors saves scores. If a row scores s with an anchor,
it scores between s - e * |row| and s + e * |row| with a neighbour in the tree
at distance e, and so on from bound to bound. Only rows whose bounds reach into
a window that still matters are scored exactly, and exact scores bound the next
anchors more tightly. Bounds are widened by more than floating point can lose.

Scores are whole numbers: components are scaled and rounded down, products are
summed exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from facets.llm.common import materialize

#: Anchors of a block, rows of a block (about), rows compared at once, most cells of near anchors.
ANCHORS, ROWS, SLICE, CELLS = 1024, 8192, 2048, 64

_BLOCK = "block long, ids array<long>, labels array<long>, x array<long>, windows array<long>, parents array<long>"


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-number rows."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    most = a.shape[1] * int(abs(a).max()) * int(abs(b).max())
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most < 1 << 63:
        return a @ b.T
    return (a.astype(object) @ b.astype(object).T).astype(np.int64)


def _pair_dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner product of each row of ``a`` with the row of ``b`` beside it."""
    if not a.size or a.shape[1] * int(abs(a).max()) * int(abs(b).max()) < 1 << 63:
        return np.einsum("ij,ij->i", a, b)
    return (a.astype(object) * b.astype(object)).sum(1).astype(np.int64)


def spanning_tree(x: np.ndarray) -> np.ndarray:
    """Parent of each row in a minimum spanning tree by distance; the root's is -1."""
    v = x.astype(np.float64)
    n = len(v)
    square = (v * v).sum(1)
    parent = np.full(n, -1)
    near = np.full(n, np.inf)
    left = np.ones(n, bool)
    now = 0
    for _ in range(n - 1):
        left[now] = False
        d = square + square[now] - 2 * (v @ v[now])
        closer = left & (d < near)
        near[closer] = d[closer]
        parent[closer] = now
        now = int(np.argmin(np.where(left, near, np.inf)))
    return parent


def _levels(parent: np.ndarray) -> list[np.ndarray]:
    out, level = [], np.flatnonzero(parent < 0)
    children = np.argsort(parent, kind="stable")
    of = parent[children]
    while len(level):
        out.append(level)
        level = np.concatenate([children[np.searchsorted(of, i):np.searchsorted(of, i, "right")] for i in level])
    return out


class TreeScores:
    """Scores of anchors with some rows, exact where asked for and bounded
    elsewhere, anchors in the order of the tree."""

    def __init__(self, x: np.ndarray, parent: np.ndarray):
        self.x, self.parent, self.levels = x, parent, _levels(parent)
        v = x.astype(np.float64)
        self.norm = np.sqrt((v * v).sum(1))
        up = np.where(parent < 0, np.arange(len(x)), parent)
        self.edge = np.sqrt(((v - v[up]) ** 2).sum(1))
        self.exact_scores = 0

    def rows(self, y: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, object]]:
        """For each level: its anchors, lower and upper bounds of their scores
        with the rows ``y``, and a function that makes the marked ones exact
        (bounds included) and returns the scores."""
        w = y.astype(np.float64)
        norm = np.sqrt((w * w).sum(1))
        low, high = np.empty((len(self.x), len(y))), np.empty((len(self.x), len(y)))
        scores = np.zeros((len(self.x), len(y)), np.int64)
        for depth, at in enumerate(self.levels):
            limit = self.norm[at][:, None] * norm
            if depth:
                step = self.edge[at][:, None] * norm
                below, above = low[self.parent[at]] - step, high[self.parent[at]] + step
                slack = 1 + 1e-9 * limit
                low[at], high[at] = np.maximum(below, -limit) - slack, np.minimum(above, limit) + slack
            else:
                low[at], high[at] = -limit - 1 - 1e-9 * limit, limit + 1 + 1e-9 * limit

            def exact(marked: np.ndarray, at=at, depth=depth) -> np.ndarray:
                marked = marked if depth else np.ones_like(marked)  # bounds start at exact scores
                i, j = np.nonzero(marked)
                if not len(i):
                    return scores[at]
                self.exact_scores += len(i)
                if len(i) * 8 > marked.size:
                    found = dots(self.x[at], y)[i, j]
                else:
                    found = np.concatenate([_pair_dots(self.x[at[i[s:s + 65536]]], y[j[s:s + 65536]]) for s in range(0, len(i), 65536)])
                scores[at[i], j] = found
                low[at[i], j] = high[at[i], j] = found
                return scores[at]

            yield at, low[at], high[at], exact


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, smaller ids first among equal ones."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= least)
        return some[np.lexsort((ids[some], -scores[some]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def best_positives(x, labels, ids, parent, y, y_labels, y_ids, k: int) -> tuple[list, int]:
    """(anchor, row, score) of the k best other rows of each anchor's label,
    and how many scores were computed."""
    tree = TreeScores(x, parent)
    kept = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in ids]
    for s in range(0, len(y), SLICE):
        own_ids, own_labels = y_ids[s:s + SLICE], y_labels[s:s + SLICE]
        for at, low, high, exact in tree.rows(y[s:s + SLICE]):
            fits = (labels[at][:, None] == own_labels) & (ids[at][:, None] != own_ids)
            least = np.full(len(at), -np.inf)  # what a row must reach: k others surely score as much
            if low.shape[1] >= k:
                least = np.partition(np.where(fits, low, -np.inf), low.shape[1] - k, axis=1)[:, low.shape[1] - k]
            least = np.maximum(least, [float(kept[i][0][-1]) - 1 if len(kept[i][0]) == k else -np.inf for i in at])
            need = fits & (high >= least[:, None])
            scores = exact(need)
            for r in np.flatnonzero(need.any(1)):
                i, j = at[r], np.flatnonzero(need[r])
                a, b = np.concatenate((kept[i][0], scores[r, j])), np.concatenate((kept[i][1], own_ids[j]))
                top = _best(a, b, k)
                kept[i] = (a[top], b[top])
    return [(i, b, a) for i, (sa, sb) in zip(ids.tolist(), kept, strict=True) for a, b in zip(sa.tolist(), sb.tolist(), strict=True)], tree.exact_scores


def best_negatives(x, labels, ids, parent, windows, y, y_labels, y_ids, k: int) -> tuple[list, int]:
    """(anchor, positive, positive's score, row, score): the k best rows of
    another label within each window (anchor's place, positive, its score,
    least, most), and how many scores were computed."""
    tree = TreeScores(x, parent)
    of = [[] for _ in ids]
    for n, w in enumerate(windows):
        of[w[0]].append(n)
    kept = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in windows]
    for s in range(0, len(y), SLICE):
        own_ids, own_labels = y_ids[s:s + SLICE], y_labels[s:s + SLICE]
        for at, low, high, exact in tree.rows(y[s:s + SLICE]):
            other = labels[at][:, None] != own_labels
            need = np.zeros_like(other)
            for r, i in enumerate(at):
                for n in of[i]:
                    _, _, _, least, most = windows[n]
                    least = max(least, int(kept[n][0][-1])) if len(kept[n][0]) == k else least
                    need[r] |= (high[r] >= least) & (low[r] <= most)
            need &= other
            scores = exact(need)
            for r in np.flatnonzero(need.any(1)):
                j = np.flatnonzero(need[r])
                found, found_ids = scores[r, j], own_ids[j]
                for n in of[at[r]]:
                    _, _, _, least, most = windows[n]
                    inside = (found >= least) & (found <= most)
                    if inside.any():
                        a, b = np.concatenate((kept[n][0], found[inside])), np.concatenate((kept[n][1], found_ids[inside]))
                        top = _best(a, b, k)
                        kept[n] = (a[top], b[top])
    id_list = ids.tolist()
    return [(id_list[w[0]], w[1], w[2], b, a) for w, (sa, sb) in zip(windows, kept, strict=True)
            for a, b in zip(sa.tolist(), sb.tolist(), strict=True)], tree.exact_scores


# --- Spark ---------------------------------------------------------------------------------

def whole_vectors(vectors: DataFrame, id_col: str, label_col: str, vec_col: str, scale: int) -> DataFrame:
    """(id, label, x) of the rows that take part, one a id; x is floor(scale * component)."""
    usable = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vec_col).alias("v"))
    # a null component makes the test null, which is no pass either
    good = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    x = F.transform("v", lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long"))
    return (usable.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()).where(good)
            .groupBy("id").agg(F.min(F.struct("label", x.alias("x"))).alias("row")).select("id", "row.label", "row.x"))


def _padded(lists: pa.Array, dims: int) -> np.ndarray:
    """One row of whole numbers a list, filled up with zeros."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    out = np.zeros((len(lists), dims), np.int64)
    sizes = np.asarray(lists.value_lengths())
    flat = np.asarray(lists.flatten())
    if len(flat):
        out[np.repeat(np.arange(len(lists)), sizes), np.concatenate([np.arange(s) for s in sizes])] = flat
    return out


def _nearest(pivots: np.ndarray, dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _padded(batch.column(2), dims).astype(np.float64)
            d = (pivots * pivots).sum(1) - 2 * (v @ pivots.T)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(d.argmin(1))], names=[*batch.schema.names, "cell"])

    return run


def _packed(dims: int, tree: bool, low: int, high: int):
    """One row for all rows of a block. Anchors get their tree, and a window
    of scores for each positive."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        x = _padded(table["x"], dims)
        windows, parents = [], []
        if tree:
            parents = spanning_tree(x).tolist()
            if "positives" in table.column_names:
                for i, found in enumerate(table["positives"].to_pylist()):
                    for p in found:
                        s = p["score"]
                        windows += [i, p["id"], s, -(-low * s // 100), high * s // 100]
        return pa.table({"block": table["block"][:1], "ids": [table["id"].to_pylist()], "labels": [table["label"].to_pylist()],
                         "x": pa.ListArray.from_arrays([0, x.size], pa.array(x.ravel())),
                         "windows": pa.array([windows], pa.list_(pa.int64())), "parents": pa.array([parents], pa.list_(pa.int64()))})

    return run


def _compared(dims: int, k: int, positives: bool):
    names = ["anchor_id", "positive_id", "positive_score"] + ([] if positives else ["negative_id", "negative_score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids, labels, x, windows, parents, y_ids, y_labels, y = (np.asarray(c[row].values) for c in batch.columns)
                x, y = x.reshape(len(ids), dims), y.reshape(len(y_ids), dims)
                if positives:
                    found, _ = best_positives(x, labels, ids, parents, y, y_labels, y_ids, k)
                else:
                    five = [tuple(w) for w in windows.reshape(-1, 5).tolist()]
                    found, _ = best_negatives(x, labels, ids, parents, five, y, y_labels, y_ids, k)
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=names)

    return run


def _in_blocks(rows: DataFrame, dims: int, tree: bool, low: int = 0, high: int = 0) -> DataFrame:
    return rows.groupBy("block").applyInArrow(_packed(dims, tree, low, high), _BLOCK)


def hard_negatives(vectors: DataFrame, anchors: Column, id_col: str = "vec_id", label_col: str = "label", vec_col: str = "embedding",
                   scale: int = 256, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A score is the inner product of two vectors whose components are
    floor(scale * component). ``anchors`` is a condition on the column ``id``.
    An anchor's positives are its ``positives`` best other rows of its label;
    for each of them come the ``negatives`` best rows of another label with
    ``low`` * positive_score <= 100 * negative_score <= ``high`` *
    positive_score. Higher scores come first, then smaller ids.

    Rows with a null id, label or vector, or a null or non-finite component,
    take no part. Rows that repeat an id count once, as the least by label and
    vector. Shorter vectors are filled up with zeros. A score beyond 64 bits is
    an error. Other columns are ignored; an empty table gives no rows, nor does
    an anchor without a positive or a positive without a negative.
    """
    rows = materialize(whole_vectors(vectors, id_col, label_col, vec_col, scale))
    n, dims, n_anchors = rows.agg(F.count(F.lit(1)), F.max(F.size("x")), F.count_if(anchors)).first()
    dims = max(dims or 0, 1)
    cells = min(CELLS, -(-n_anchors // (ANCHORS // 2)))
    pivots = [r["x"] for r in rows.where(anchors).orderBy(F.xxhash64("id"), "id").limit(cells).select("x").collect()]
    centre = np.array([p + [0] * (dims - len(p)) for p in pivots] or [[0] * dims], np.float64)
    own = materialize(rows.where(anchors).mapInArrow(_nearest(centre, dims), "id long, label long, x array<long>, cell long"))
    of_cell = {r["cell"]: r["count"] for r in own.groupBy("cell").count().collect()}
    parts, first = F.lit(1), F.lit(0)
    at = 0
    for cell, count in sorted(of_cell.items()):  # at most CELLS
        many = -(-count // ANCHORS)
        parts = F.when(F.col("cell") == cell, many).otherwise(parts)
        first = F.when(F.col("cell") == cell, at).otherwise(first)
        at += many
    own = own.withColumn("block", (first + F.pmod(F.xxhash64("id"), parts)).cast("long")).drop("cell")

    blocks = max(1, -(-n // ROWS))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    others = materialize(_in_blocks(dealt, dims, False)).select(
        "block", F.col("ids").alias("y_ids"), F.col("labels").alias("y_labels"), F.col("x").alias("y"))

    def compared(packed: DataFrame, k: int, fields: str, want: bool) -> DataFrame:
        """Each block of anchors with each block of rows."""
        sent = packed.drop("block").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
        return (sent.join(others, "block").select("ids", "labels", "x", "windows", "parents", "y_ids", "y_labels", "y")
                .mapInArrow(_compared(dims, k, want), fields))

    fields = "anchor_id long, positive_id long, positive_score long"
    best = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    found = (compared(materialize(_in_blocks(own, dims, True)), positives, fields, True)
             .withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= positives))
    of_anchor = found.groupBy(F.col("anchor_id").alias("id")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("positive_id").alias("id"), F.col("positive_score").alias("score")))).alias("positives"))
    windowed = materialize(_in_blocks(own.join(of_anchor, "id"), dims, True, low, high))
    best = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return (compared(windowed, negatives, fields + ", negative_id long, negative_score long", False)
            .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), e AS (SELECT vec_id, label, unnest(x) AS c, generate_subscripts(x, 1) AS nth FROM v
), s AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS id, CAST(sum(a.c * b.c) AS BIGINT) AS score
  FROM e a JOIN e b USING (nth) WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id GROUP BY 1, 2, 3
), p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
), n AS (
  SELECT p.anchor_id, positive_id, s.id AS negative_id, positive_score, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS "rank"
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  WHERE 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
)
SELECT anchor_id, positive_id, "rank", negative_id, positive_score, negative_score FROM n WHERE "rank" <= 3
"""
