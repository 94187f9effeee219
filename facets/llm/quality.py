"""Quality classifier: a generalised additive model with pairwise interactions.

Features describe a whole text's letters, marks, words and lines. Boosted
shallow trees, one feature at a time, become lookup tables over binned
features; scoring adds up table entries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facets.llm.boosting import Additive, fit_additive
from facets.llm.common import first_by_hash, text_chunks, word_hashes, word_spans

#: Labelled rows that a model is fitted on at most, those first by hash of the id.
FIT_ROWS = 20_000

FEATURES = ("words", "upper", "digit", "other", "space", "newline", "mark", "bang", "bar", "high", "stop",
            "word_length", "distinct", "repeated", "line_length", "capital_words", "mark_words", "longest_run")

# Byte classes: each byte value belongs to one of them.
_LOWER, _UPPER, _DIGIT, _SPACE, _NEWLINE, _MARK, _BANG, _BAR, _HIGH, _STOP, _OTHER = range(11)
_CLASS = np.full(256, _OTHER, np.int64)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = _LOWER, _UPPER, _DIGIT, _HIGH
_CLASS[[32, 9, 11, 12, 13]], _CLASS[10] = _SPACE, _NEWLINE
_CLASS[[ord(c) for c in "#$%&*@^~=+<>\\{}[]_"]] = _MARK
_CLASS[[ord(c) for c in "!?"]], _CLASS[ord("|")], _CLASS[[ord(c) for c in ".,;:"]] = _BANG, _BAR, _STOP


def text_features(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Features of each row of a chunk of texts; an empty text has all zeros."""
    rows = len(offs) - 1
    size = np.diff(offs)
    row = np.repeat(np.arange(rows), size)
    n = np.bincount(row * 11 + _CLASS[data], minlength=rows * 11).reshape(rows, 11).astype(float)
    starts, ends, owner = word_spans(data, offs)
    words = np.bincount(owner, minlength=rows).astype(float)
    h = word_hashes(data, starts, ends)
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
    order = np.lexsort((h, owner))
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[order][1:] != h[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    distinct = np.bincount(owner[order][fresh], minlength=rows)
    first = _CLASS[data[starts]] if len(starts) else np.zeros(0, int)
    last = _CLASS[data[ends - 1]] if len(ends) else np.zeros(0, int)
    # longest run of equal neighbouring words
    runs = np.zeros(rows)
    if len(h):
        begin = np.flatnonzero(~same)
        length = np.diff(np.append(begin, len(h)))
        np.maximum.at(runs, owner[begin], length)
    some, w = np.maximum(size, 1), np.maximum(words, 1)
    return np.stack([
        np.log1p(words), n[:, _UPPER] / np.maximum(n[:, _UPPER] + n[:, _LOWER], 1), n[:, _DIGIT] / some, n[:, _OTHER] / some,
        n[:, _SPACE] / some, n[:, _NEWLINE] / some, n[:, _MARK] / some, n[:, _BANG] / some, n[:, _BAR] / some, n[:, _HIGH] / some,
        n[:, _STOP] / some, np.bincount(owner, ends - starts, rows) / w, distinct / w, np.bincount(owner, same, rows) / w,
        np.log1p(size / (n[:, _NEWLINE] + 1)), np.bincount(owner, first == _UPPER, rows) / w,
        np.bincount(owner, (last == _MARK) | (last == _BANG) | (last == _BAR), rows) / w, np.log1p(runs)], axis=1)


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, features array<double>) of every whole text."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offs in text_chunks(batch.column(1)):
                x = text_features(data, offs)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(x)), pa.ListArray.from_arrays(
                        np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel()))], names=["doc_id", "features"])

    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, f"doc_id {id_type}, features array<double>"))


def fit(docs: DataFrame, labels: DataFrame, learn: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", fit_rows: int = FIT_ROWS, **options) -> Additive:
    """A model of ``label_col`` (0 or 1) from at most ``fit_rows`` labelled
    rows that meet ``learn``, a condition on ``labels``. Null ids and labels
    are no examples; an id labelled twice is an example twice. Without any
    example every score is 0.5."""
    rows = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    rows = rows.where(learn) if learn is not None else rows
    # a bounded number of (id, label) pairs
    chosen = first_by_hash(rows.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label")),
                           fit_rows, F.xxhash64("_id"), "_id", "_label")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = features(texts.join(F.broadcast(chosen.select("_id").distinct()), F.col("doc_id") == F.col("_id"), "left_semi"))
    table = found.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("doc_id", "features", "_label").toArrow()
    x = np.asarray(table["features"].combine_chunks().flatten()).reshape(-1, len(FEATURES))
    y = np.asarray(table["_label"]).astype(float)
    order = np.lexsort((*x.T, y, np.asarray(table["doc_id"])))  # the same model whatever the rows' order
    return fit_additive(x[order], y[order], **options)


def score(docs: DataFrame, model: Additive, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) for every row: the probability of label 1. A null text
    is an empty one; null and repeated ids stay rows of their own; other
    columns are ignored; an empty table gives an empty result."""
    id_type = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for first, data, offs in text_chunks(batch.column(1)):
                s = m.score(text_features(data, offs))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(s)), pa.array(s)], names=["doc_id", "score"])

    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, f"doc_id {id_type}, score double"))
