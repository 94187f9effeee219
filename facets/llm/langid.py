"""Language identification by nearest centroid.

A text is a TF-IDF vector of hashed byte n-grams, scaled to length one. Each
language has several centroids, found by spherical k-means among its examples;
a text goes to the language of the centroid with the largest cosine, and is
marked as rejected if even that one is farther away than the language's own
examples are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facets.llm.common import lowered, text_chunks

#: Dimensions of a vector, as a power of two.
BITS = 11
#: Examples of each language that a model is fitted on, those first by hash of the id (about so many).
FIT_ROWS = 1000
#: Most languages that are accepted; more raise an error.
MOST_LANGUAGES = 200
CENTROIDS = 4
#: Share of a language's own examples that lie beyond its rejection distance.
REJECTED = 0.01
UNKNOWN = "und"


def gram_counts(data: np.ndarray, offs: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Counts of hashed 2- and 3-grams of the lower-cased bytes, row by row.
    White space counts as one blank; digits and ASCII marks are left out."""
    rows, size = len(offs) - 1, 1 << bits
    row = np.repeat(np.arange(rows), np.diff(offs))
    b = lowered(data)
    letter = ((b >= 97) & (b <= 122)) | (b >= 128)
    blank = (b == 32) | ((b >= 9) & (b <= 13))
    keep = letter | blank
    b, row, blank = np.where(blank, 32, b)[keep].astype(np.uint32), row[keep], blank[keep]
    if len(b) > 1:  # a run of blanks is one
        again = np.zeros(len(b), bool)
        again[1:] = blank[1:] & blank[:-1] & (row[1:] == row[:-1])
        b, row = b[~again], row[~again]
    out = np.zeros(rows * size)
    for n, salt in ((2, 0x9E3779B1), (3, 0x85EBCA6B)):
        if len(b) < n:
            continue
        code = b[:len(b) - n + 1].copy()
        for j in range(1, n):
            code = (code << np.uint32(8)) | b[j:len(b) - n + 1 + j]
        whole = row[:len(code)] == row[n - 1:]
        code, at = code[whole], row[:len(code)][whole]
        h = (code * np.uint32(salt)) ^ ((code * np.uint32(salt)) >> np.uint32(15))
        h = (h * np.uint32(0xC2B2AE35)) >> np.uint32(32 - bits)
        out += np.bincount(at * size + h, minlength=rows * size)
    return out.reshape(rows, size)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


@dataclass
class Centroids:
    languages: list[str]
    owner: np.ndarray
    idf: np.ndarray
    centers: np.ndarray
    least: np.ndarray  # smallest cosine that a language accepts

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        return _unit(np.log1p(counts) * self.idf)

    def nearest(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language number, cosine in 0 to 1, and whether it is rejected."""
        near = self.vectors(counts) @ self.centers.T
        top = near.argmax(1)
        score = np.clip(near[np.arange(len(near)), top], 0.0, 1.0)
        return self.owner[top], score, score < self.least[self.owner[top]]


def _k_means(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; each new start is the row farthest from those before."""
    centers = _unit(x.mean(0, keepdims=True))
    start = [int((x @ centers[0]).argmax())]
    while len(start) < min(k, len(x)):
        start.append(int((x @ x[start].T).max(1).argmin()))
    centers = x[start]
    for _ in range(rounds):
        own = (x @ centers.T).argmax(1)
        centers = _unit(np.stack([x[own == c].mean(0) if (own == c).any() else centers[c] for c in range(len(centers))]))
    return centers


def _counted(docs: DataFrame, columns: list[Column], schema: str, handle) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for first, data, offs in text_chunks(texts, 1 << 19):
                for a in range(0, len(offs) - 1, 512):  # so many dense vectors at once
                    z = min(a + 512, len(offs) - 1)
                    counts = gram_counts(data[offs[a]:offs[z]], offs[a:z + 1] - offs[a])
                    yield handle(batch.slice(first + a, z - a), counts)

    return docs.select(*columns, F.col("text")).mapInArrow(run, schema)


def fit(docs: DataFrame, learn: Column | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        fit_rows: int = FIT_ROWS, centroids: int = CENTROIDS) -> Centroids | None:
    """Centroids of each language from about ``fit_rows`` of its rows that meet
    ``learn``; None without any. Rows without an id, text or language are no
    examples."""
    rows = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    rows = (rows.where(learn) if learn is not None else rows).select(
        F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    sizes = rows.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not sizes:
        return None
    place = F.pmod(F.xxhash64(F.lit(11), F.col("id").cast("string")), F.lit(1 << 40)) / float(1 << 40)
    share = F.lit(0.0)
    for s in sizes:
        share = F.when(F.col("lang") == s["lang"], F.lit(fit_rows / s["count"])).otherwise(share)

    def handle(batch: pa.RecordBatch, counts: np.ndarray) -> pa.RecordBatch:
        raw = [x.tobytes() for x in counts.astype(np.uint32)]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(raw, pa.binary())], names=["id", "lang", "counts"])

    id_type = docs.schema[id_col].dataType.simpleString()
    table = _counted(rows.where(place < share), [F.col("id"), F.col("lang")], f"id {id_type}, lang string, counts binary", handle).toArrow()
    table = table.sort_by([("lang", "ascending"), ("id", "ascending"), ("counts", "ascending")])
    if not len(table):
        return None
    counts = np.frombuffer(b"".join(table["counts"].to_pylist()), np.uint32).reshape(len(table), -1)
    langs = np.asarray(table["lang"].to_pylist(), object)
    idf = (np.log((1 + len(counts)) / (1 + (counts > 0).sum(0))) + 1).astype(np.float32)
    names = sorted(set(langs))
    model = Centroids(names, np.zeros(0, int), idf, np.zeros((0, counts.shape[1]), np.float32), np.zeros(len(names)))
    x = model.vectors(counts.astype(np.float32)).astype(np.float32)
    centers, owner = [], []
    for i, name in enumerate(names):
        own = x[(langs == name) & (counts.any(1))]
        if len(own):
            found = _k_means(own, centroids)
            centers.append(found)
            owner += [i] * len(found)
            model.least[i] = np.quantile((own @ found.T).max(1), REJECTED)
    if not centers:
        return None
    model.centers, model.owner = np.concatenate(centers).astype(np.float32), np.array(owner)
    return model


def identify(docs: DataFrame, model: Centroids | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, rejected) for every whole text: the nearest
    centroid's language and its cosine. A text that is null or has no letter,
    and every text if there is no model, is ``und`` with score 0 and rejected.
    Null and repeated ids stay rows of their own; other columns are ignored;
    an empty table gives an empty result."""
    id_type = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def handle(batch: pa.RecordBatch, counts: np.ndarray) -> pa.RecordBatch:
        m = shared.value
        letters = np.asarray(pc.match_substring_regex(batch.column(1), r"\p{L}").fill_null(False).cast(pa.int8())) > 0
        if m is None:
            names, score, far = [UNKNOWN] * len(letters), np.zeros(len(letters)), np.ones(len(letters), bool)
        else:
            lang, score, far = m.nearest(counts)
            names = [m.languages[i] if ok else UNKNOWN for i, ok in zip(lang, letters, strict=True)]
            score, far = np.where(letters, score, 0.0), far | ~letters
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(score.astype(float)), pa.array(far)],
                                          names=["doc_id", "lang_pred", "score", "rejected"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return _counted(rows, [F.col("doc_id")], f"doc_id {id_type}, lang_pred string, score double, rejected boolean", handle)
