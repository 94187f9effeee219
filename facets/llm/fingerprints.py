"""Bottom-k sketches of word shingles.

A document's sketch has the ``k`` smallest hashes of its distinct shingles, in
ascending order (all of them if there are fewer). Sketches of parts merge into
the sketch of the whole, and two sketches estimate resemblance, containment
and distinct counts.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from facets.llm.common import CHUNK_BYTES, shingles, text_chunks

K = 128
#: Hashes are 63 bits wide, so that they order alike signed and unsigned.
SPACE = float(1 << 63)


def sketch_texts(texts: list[str] | pa.Array, width: int = 5, k: int = K) -> list[np.ndarray]:
    texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
    out = []
    for _, data, offs in text_chunks(texts):
        h, bounds = shingles(data, offs, width)
        h = (h >> np.uint64(1)).astype(np.int64)
        # halving can make two neighbours equal once in 2**63 cases; a set stays a set
        out.extend(np.unique(h[a:min(b, a + k + 1)])[:k] for a, b in zip(bounds[:-1], bounds[1:], strict=True))
    return out


def _lowest(a: np.ndarray, b: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k smallest of the union, and which of them are in both."""
    both = np.concatenate((a, b))
    both.sort()
    twice = np.zeros(len(both), bool)
    twice[:-1] = both[1:] == both[:-1]
    first = np.ones(len(both), bool)
    first[1:] = ~twice[:-1]
    return both[first][:k], twice[first][:k]


def merged(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """Sketch of the union of two sets."""
    return _lowest(a, b, k)[0]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated |A and B| / |A or B|; exact if both have fewer than k
    shingles; 1 for two empty sets."""
    lowest, common = _lowest(a, b, k)
    return float(common.mean()) if len(lowest) else 1.0


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated |A and B| / |A|; 1 for an empty A."""
    lowest, common = _lowest(a, b, k)
    own = np.isin(lowest, a)
    return float(common[own].mean()) if own.any() else float(not len(a))


def distinct_count(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles; exact below k."""
    return float(len(a)) if len(a) < k else (k - 1) * SPACE / float(a[-1])


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, k: int = K) -> DataFrame:
    """(doc_id, sketch array<long>, distinct double) of every whole text. A
    null or empty text has an empty sketch and the count 0. Null and repeated
    ids stay rows of their own; other columns are ignored."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = sketch_texts(batch.column(1), width, k)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.int64())), pa.array([distinct_count(x, k) for x in found])],
                names=["doc_id", "sketch", "distinct"])

    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, f"doc_id {id_type}, sketch array<long>, distinct double"))


def merge_sketches(sketched: DataFrame, key: str, k: int = K, spread: int = 64) -> DataFrame:
    """(key, sketch, distinct) of the union of each key's documents.

    Hashes are first cut to the k smallest within ``spread`` shares of a key,
    so a hot key is merged by many tasks; its last step sees ``spread * k``
    hashes at most. A null key is a key of its own."""
    rows = sketched.select(key, F.explode("sketch").alias("h")).distinct()
    share = Window.partitionBy(key, F.pmod(F.xxhash64("h"), F.lit(spread))).orderBy("h")
    few = rows.withColumn("nth", F.row_number().over(share)).where(F.col("nth") <= k)
    lowest = F.slice(F.array_sort(F.collect_list("h")), 1, k)
    return (few.groupBy(key).agg(lowest.alias("sketch"))
            .withColumn("distinct", F.when(F.size("sketch") < k, F.size("sketch").cast("double"))
                        .otherwise((k - 1) * F.lit(SPACE) / F.element_at("sketch", -1))))


def text_of(sketch: np.ndarray) -> str:
    """A sketch as text: its hashes in 16 hexadecimal digits each."""
    return sketch.astype(">u8").tobytes().hex()


def _with_next(k: int, width: int):
    """Rows come in ring order; a row's next document is the row after it. The
    rows marked ``tail`` only end a bucket."""

    def rows_of(texts: list[str], skip: list[bool], ids: list) -> pa.RecordBatch:
        edited = []
        for this, after in zip(texts, texts[1:], strict=False):
            half = len(this) // 2
            edited.append(this[:len(this) - half] + after[:half])
        own, other = sketch_texts(texts, width, k), sketch_texts(edited, width, k)
        out = [i for i in range(len(texts) - 1) if not skip[i]]
        return pa.RecordBatch.from_pydict({
            "doc_id": pa.array([ids[i] for i in out], pa.int64()),
            "n_chars": pa.array([len(texts[i]) for i in out], pa.int64()),
            "edited_sha256": pa.array([hashlib.sha256(edited[i].encode()).hexdigest() for i in out], pa.string()),
            "fingerprint": pa.array([text_of(own[i]) for i in out], pa.string()),
            "edited_fingerprint": pa.array([text_of(other[i]) for i in out], pa.string()),
            "near_edited": pa.array([resemblance(own[i], other[i], k) for i in out], pa.float64()),
            "near_next": pa.array([resemblance(own[i], own[i + 1], k) for i in out], pa.float64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, skip, ids, size = [], [], [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                ids.append(batch.column(0)[i].as_py())
                texts.append(batch.column(1)[i].as_py())
                skip.append(batch.column(2)[i].as_py())
                size += len(texts[-1])
                if size > CHUNK_BYTES // 2 and len(texts) > 1:
                    yield rows_of(texts, skip, ids)
                    texts, skip, ids = texts[-1:], skip[-1:], ids[-1:]
                    size = len(texts[0])
        if len(texts) > 1:
            yield rows_of(texts, skip, ids)

    return run


def _reached(cuts: list[int], value: Column) -> Column:
    """How many of the ascending cuts are at most the value: first by blocks,
    then within one block, so about 2 * sqrt(cuts) comparisons a row."""
    if not cuts:
        return F.lit(0)
    m = math.isqrt(len(cuts)) + 1
    listed = F.array(*[F.lit(c) for c in cuts]).cast("array<long>")
    ends = F.array(*[F.lit(c) for c in cuts[m - 1::m]]).cast("array<long>")
    blocks = F.size(F.filter(ends, lambda c: c <= value))
    return blocks * m + F.size(F.filter(F.slice(listed, blocks * m + 1, m), lambda c: c <= value))


def edited_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                      k: int = K) -> DataFrame:
    """Fingerprints of every whole text and of its edited text, whose last
    floor(n / 2) code points are those at the start of the next document's text.

    The next document is the one after in the order of falling ids; after the
    last comes the first. The rows are dealt into ranges of ids, one sort each;
    the first row of every range is added to the end of the range before it,
    so no task needs more than its own rows. Ids must be whole numbers; equal
    ids are ordered by their texts, and null ids come last. A null text is an
    empty one. A single document is its own next document; an empty table gives
    an empty result. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    tasks = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = 4 * tasks  # several short ranges a task even out what hashing deals to it
    cuts = sorted(set(rows.approxQuantile("doc_id", [i / ranges for i in range(1, ranges)], 0.1 / ranges)))
    # ranges are numbered in ring order from 0, null ids in the last one
    rows = rows.withColumn("part", F.when(F.col("doc_id").isNull(), F.lit(len(cuts) + 1))
                           .otherwise(F.lit(len(cuts)) - _reached([int(c) for c in cuts], F.col("doc_id"))))

    # one row per range: its first id, and the range before it on the ring
    heads = rows.groupBy("part").agg(F.max("doc_id").alias("head"))
    ring = Window.orderBy("part")
    last = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.withColumn("goes_to", F.coalesce(F.lag("part").over(ring), F.max("part").over(last)))
    tails = (rows.join(F.broadcast(heads), "part").where(F.col("doc_id").eqNullSafe(F.col("head")))
             .groupBy("goes_to").agg(F.min(F.struct("doc_id", "text")).alias("row"))
             .select(F.col("row.doc_id").alias("doc_id"), F.col("row.text").alias("text"),
                     F.col("goes_to").alias("part"), F.lit(True).alias("tail")))
    dealt = (rows.withColumn("tail", F.lit(False)).unionByName(tails)
             .repartition(tasks, "part")
             .sortWithinPartitions("part", "tail", F.col("doc_id").desc_nulls_last(), "text"))
    return (dealt.select("doc_id", "text", "tail").mapInArrow(
        _with_next(k, width), "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                              "edited_fingerprint string, near_edited double, near_next double")
            .withColumnRenamed("doc_id", id_col))
