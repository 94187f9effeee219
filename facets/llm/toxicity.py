"""Toxicity by a classifier chain.

The categories are predicted one after the other by logistic regressions over
the presence of words and word beginnings; each later model also gets the
earlier categories' probabilities. In training these are out-of-fold
predictions, so that a later model learns from probabilities like those it
will see. The last category is the label itself.

A table of labels often has a single toxicity label. Categories before it may
then be told by term lists: an example belongs to such a category if it is
labelled toxic and has one of its terms. The label does not depend on the lists,
so what they do not name (other languages, say) is learned all the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facets.llm.boosting import sigmoid
from facets.llm.common import first_by_hash, lowered, materialize, mix64, text_chunks, word_hashes, word_spans

#: Labelled rows that a chain is fitted on at most, toxic and other, those first by hash of the id.
FIT_TOXIC, FIT_OTHER = 5_000, 10_000
#: Words and beginnings that models look at, and rows of the label that must have one.
MOST_FEATURES, LEAST_ROWS = 768, 5
#: Hash buckets of words and beginnings.
BITS = 20
#: Lengths in bytes of the beginnings.
BEGINNINGS = (3, 4, 5, 6, 7, 8, 9)
FOLDS = 4
PENALTY = 0.1

#: Terms of the categories before the label.
CATEGORIES = {
    "insult": ("idiot", "moron", "clown", "loser", "stupid"),
    "contempt": ("worthless", "pathetic", "disgusting", "scum", "trash"),
}

_BREAKS = np.ones(256, bool)
_BREAKS[48:58] = _BREAKS[65:91] = _BREAKS[97:123] = _BREAKS[128:] = False


def word_features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash bucket) of each word of a chunk and of its beginnings, with
    repetitions. Words are runs of letters and digits, lower-cased."""
    low = lowered(data)
    starts, ends, row = word_spans(low, offs, _BREAKS)
    rows, buckets = [row], [word_hashes(low, starts, ends, lower=False)]
    for n in BEGINNINGS:
        longer = ends - starts > n
        begin = starts[longer]
        rows.append(row[longer])
        buckets.append(mix64(word_hashes(low, begin, begin + n, lower=False) + np.uint64(n)))
    return np.concatenate(rows), (np.concatenate(buckets) >> np.uint64(64 - BITS)).astype(np.int64)


def _present(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, bucket) of a chunk."""
    row, bucket = word_features(data, offs)
    both = np.unique((row << BITS) | bucket)
    return both >> BITS, both & ((1 << BITS) - 1)


def term_buckets(terms: tuple[str, ...]) -> np.ndarray:
    raw = [t.lower().encode() for t in terms]
    data = np.frombuffer(b" ".join(raw), np.uint8)
    starts = np.cumsum([0] + [len(t) + 1 for t in raw[:-1]])
    h = word_hashes(lowered(data), starts, starts + np.array([len(t) for t in raw]), lower=False)
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


@dataclass
class Chain:
    categories: list[str]
    buckets: np.ndarray  # hash buckets that are features, ascending
    weights: list[np.ndarray]  # per category: features, earlier log-odds, constant
    threshold: float = 0.5  # probability of the last category from which a row has it

    def predict(self, rows: int, row: np.ndarray, feature: np.ndarray) -> np.ndarray:
        """Probability of each category (columns) from the present features."""
        odds = np.zeros((rows, 0))
        n = len(self.buckets)
        for w in self.weights:
            z = np.bincount(row, w[feature], rows) + odds @ w[n:-1] + w[-1]
            odds = np.column_stack([odds, np.clip(z, -8, 8)])
        return sigmoid(odds)


def _logistic(parts: list[tuple[np.ndarray, np.ndarray]], rounds: int = 200) -> np.ndarray:
    """Weights of an L2-penalised logistic regression whose first column is the
    constant, by accelerated gradient steps over all parts (rows, labels)."""
    parts = [(x, y) for x, y in parts if len(y)]
    w = np.zeros(parts[0][0].shape[1], np.float32)
    v, t = w.copy(), 1.0
    shrink = np.full(len(w), PENALTY, np.float32)
    shrink[0] = 0.0
    # step from a bound on the curvature: power iterations on x' x / 4
    u = np.ones(len(w), np.float32)
    for _ in range(8):
        u = sum(x.T @ (x @ u) for x, _ in parts) / 4
        norm = float(np.linalg.norm(u)) or 1.0
        u /= norm
    step = 1.0 / (1.1 * norm + PENALTY)
    for _ in range(rounds):
        g = sum(x.T @ (sigmoid(x @ v) - y).astype(np.float32) for x, y in parts) + shrink * v
        new = v - step * g
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        v = new + np.float32((t - 1) / t_new) * (new - w)
        w, t = new, t_new
    return w


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """Cut of out-of-fold probabilities with the best F-measure that weighs
    precision twice as much as recall, half way to the next lower probability;
    between 0.2 and 0.8."""
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    good = 1.25 * hits / (np.arange(1, len(y) + 1) + 0.25 * y.sum())
    good[:-1][p[order][:-1] == p[order][1:]] = 0  # equal probabilities fall on one side
    k = int(good.argmax())
    below = p[order][k + 1] if k + 1 < len(p) else p[order][k]
    return float(np.clip((p[order][k] + below) / 2, 0.2, 0.8))


def _sample(docs: DataFrame, labels: DataFrame, learn: Column | None, id_col: str, text_col: str, label_col: str,
            fit_toxic: int, fit_other: int) -> DataFrame:
    rows = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    rows = (rows.where(learn) if learn is not None else rows).select(
        F.col(id_col).alias("_id"), (F.col(label_col).cast("int") > 0).cast("int").alias("_label"))
    hashed = F.xxhash64(F.lit(3), "_id")
    # a bounded number of (id, label) pairs
    chosen = first_by_hash(rows.where("_label = 1"), fit_toxic, hashed, "_id").union(
        first_by_hash(rows.where("_label = 0"), fit_other, hashed, "_id"))
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .join(F.broadcast(chosen), F.col("id") == F.col("_id")).select("id", F.col("_label").alias("label"), "text"))


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, n): rows of the partition that have the bucket."""
    total = np.zeros(1 << BITS, np.int64)
    for batch in batches:
        for _, data, offs in text_chunks(batch.column(0)):
            total += np.bincount(_present(data, offs)[1], minlength=1 << BITS)
    found = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["bucket", "n"])


def _pick(buckets: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, label, features): places in ``buckets`` of what each row has."""
    for batch in batches:
        for first, data, offs in text_chunks(batch.column(2)):
            rows = len(offs) - 1
            row, bucket = _present(data, offs)
            at = np.minimum(np.searchsorted(buckets, bucket), max(len(buckets) - 1, 0))
            hit = buckets[at] == bucket if len(buckets) else np.zeros(len(bucket), bool)
            ends = np.concatenate(([0], np.cumsum(np.bincount(row[hit], minlength=rows)))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, rows), batch.column(1).slice(first, rows),
                 pa.ListArray.from_arrays(ends, pa.array(at[hit].astype(np.int32)))], names=["id", "label", "features"])


def fit(docs: DataFrame, labels: DataFrame, learn: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", categories: dict[str, tuple[str, ...]] = CATEGORIES, fit_toxic: int = FIT_TOXIC,
        fit_other: int = FIT_OTHER, most_features: int = MOST_FEATURES) -> Chain:
    """A chain over ``categories`` and then ``label_col`` (above 0: toxic), from
    a bounded number of labelled rows that meet ``learn``, a condition on
    ``labels``. Null ids, texts and labels are no examples; an id labelled
    twice is an example twice. Without any toxic example nothing is toxic."""
    sample = materialize(_sample(docs.where(F.col(text_col).isNotNull()), labels, learn, id_col, text_col, label_col, fit_toxic, fit_other))
    names = [*categories, label_col]

    # what toxic rows have often, then how often the other rows have it
    often = (sample.where("label = 1").select("text").mapInArrow(_count_features, "bucket long, n long")
             .groupBy("bucket").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_ROWS)
             .orderBy(F.desc("n"), "bucket").limit(16 * most_features).toArrow())
    told = np.unique(np.concatenate([term_buckets(t) for t in categories.values()])) if categories else np.zeros(0, np.int64)
    candidates = np.unique(np.concatenate([np.asarray(often["bucket"], dtype=np.int64), told]))
    id_type = docs.schema[id_col].dataType.simpleString()
    table = sample.mapInArrow(lambda batches: _pick(candidates, batches), f"id {id_type}, label int, features array<int>").toArrow()
    if not pc.sum(table["label"]).as_py():
        return Chain(names, np.zeros(0, np.int64), [np.append(np.zeros(i), -8.0) for i in range(len(names))])

    # rows in the order of (fold, id), whatever the order they came in; a fold is a slice
    rank = np.empty(len(table), np.int64)
    rank[np.asarray(pc.sort_indices(table.select(["id", "label"]), sort_keys=[("id", "ascending"), ("label", "ascending")]))] = np.arange(len(table))
    fold = (mix64(rank.astype(np.uint64) + np.uint64(1)) % np.uint64(FOLDS)).astype(int)
    spot = np.empty(len(table), np.int64)
    spot[np.lexsort((rank, fold))] = np.arange(len(table))
    y = np.empty(len(table), np.float32)
    y[spot] = np.asarray(table["label"])
    edges = np.concatenate(([0], np.cumsum(np.bincount(fold, minlength=FOLDS))))

    def batches() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row, candidate) of a few hundred rows at a time."""
        first = 0
        for batch in table.to_batches(max_chunksize=512):
            lists = batch.column(2)
            yield np.repeat(spot[first:first + len(lists)], np.diff(np.asarray(lists.offsets))), np.asarray(lists.flatten())
            first += len(lists)

    # features by how many more toxic than other rows have them, in standard deviations
    n_1, n_0 = np.zeros(len(candidates)), np.zeros(len(candidates))
    has = np.zeros((len(categories), len(y)), bool)
    named = [np.isin(candidates, term_buckets(terms)) for terms in categories.values()]
    for row, at in batches():
        n_1 += np.bincount(at, y[row], len(candidates))
        n_0 += np.bincount(at, 1 - y[row], len(candidates))
        for k, own in enumerate(named):
            has[k][row[own[at]]] = True
    others = max(len(y) - y.sum(), 1)
    p_1, p_0 = n_1 / y.sum(), n_0 / others
    z = (p_1 - p_0) / np.sqrt(p_1 * (1 - p_1) / y.sum() + (n_0 + 1) / others ** 2)
    best = np.sort(np.lexsort((candidates, -z))[:most_features])
    # columns: constant, log-odds of the earlier categories (0 until they are known), features
    x = np.zeros((len(y), 1 + len(names) + len(best)), np.float32)
    x[:, 0] = 1
    place = np.full(len(candidates), -1)
    place[best] = np.arange(1 + len(names), x.shape[1])
    for row, at in batches():
        x[row[place[at] >= 0], place[at[place[at] >= 0]]] = 1

    slices = [slice(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    weights = []
    for k in range(len(names)):
        target = y if k == len(categories) else (has[k] & (y > 0)).astype(np.float32)
        w = _logistic([(x, target)]).astype(float)
        weights.append(np.concatenate((w[1 + len(names):], w[1:1 + k], w[:1])))
        out = np.zeros(len(y), np.float32)
        for f in slices:
            rest = [(x[o], target[o]) for o in slices if o != f]
            if any(len(t) for _, t in rest):
                out[f] = x[f] @ _logistic(rest)
        x[:, 1 + k] = np.clip(out, -8, 8)
    return Chain(names, candidates[best], weights, best_threshold(sigmoid(x[:, len(names)]), y))


def _scored(chain: Chain, text: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    place = np.full(1 << BITS, -1, np.int32)
    place[chain.buckets] = np.arange(len(chain.buckets))
    for first, data, offs in text_chunks(text):
        rows = len(offs) - 1
        row, bucket = word_features(data, offs)
        at = place[bucket]
        both = np.unique(row[at >= 0] * (len(chain.buckets) + 1) + at[at >= 0])
        yield first, rows, chain.predict(rows, both // (len(chain.buckets) + 1), both % (len(chain.buckets) + 1))


def predict(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, one probability a category) for every row and whole text. A
    null text is an empty one; null and repeated ids stay rows of their own;
    other columns are ignored; an empty table gives an empty result."""
    id_type = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    names = [f"p_{c}" for c in chain.categories]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, rows, p in _scored(shared.value, batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, rows), *[pa.array(c) for c in p.T]], names=["doc_id", *names])

    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, f"doc_id {id_type}, " + ", ".join(f"`{n}` double" for n in names)))


def drop_toxic(docs: DataFrame, chain: Chain, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose probability of the last category reaches
    the chain's threshold; columns unchanged, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, rows, p in _scored(shared.value, batch.column(at)):
                yield batch.slice(first, rows).filter(pa.array(p[:, -1] < shared.value.threshold))

    return docs.mapInArrow(run, docs.schema)
