"""Exact duplicates with a heavy-hitter split.

Every text gets a digest. A Misra-Gries pass over the digests finds those that
make up a large share of the rows; a second pass counts these few candidates
exactly and takes their winners (smallest id), which are broadcast, so copies
of frequent texts are resolved on the map side and never meet in one task.
The remaining digests, none of which is frequent, go through an ordinary
shuffled aggregation and join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from facets.llm.common import is_space, materialize, spare_name, text_chunks

#: Counters of a Misra-Gries summary: the bound on broadcast winners.
COUNTERS = 1024


def _digests(texts: pa.Array) -> list[str]:
    """SHA-256 of each text with each run of white space as one space."""
    out = []
    for _, data, offs in text_chunks(texts):
        space = is_space(data)
        keep = np.ones(len(data), bool)
        keep[1:] = ~(space[1:] & space[:-1])
        keep[offs[:-1][offs[:-1] < len(data)]] = True  # a text's first byte
        plain = memoryview(np.where(space, np.uint8(32), data)[keep])
        ends = np.concatenate(([0], np.cumsum(keep)))[offs]
        out.extend(hashlib.sha256(plain[a:b]).hexdigest() for a, b in zip(ends[:-1], ends[1:], strict=True))
    return out


def with_digest(rows: DataFrame, text_col: str, name: str) -> DataFrame:
    """``rows`` with a further column that stands for the text: SHA-256, in
    lowercase hexadecimal digits, of the text with each run of white space as
    one space. A null text is an empty one."""
    at = rows.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_digests(batch.column(at)), pa.string())],
                                             names=[*batch.schema.names, name])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(name, T.StringType())]))


def _summaries(column: str, counters: int):
    """Per partition: at most ``counters`` values with counts that fall short
    of the true ones by at most rows / (counters + 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}
        for batch in batches:
            for x in pc.value_counts(batch.column(column)).to_pylist():
                held[x["values"]] = held.get(x["values"], 0) + x["counts"]
            if len(held) > counters:
                cut = sorted(held.values(), reverse=True)[counters]
                held = {k: n - cut for k, n in held.items() if n > cut}
        yield pa.RecordBatch.from_pydict({"value": pa.array(list(held), pa.string()),
                                          "n": pa.array(list(held.values()), pa.int64())})

    return run


def frequent_values(df: DataFrame, column: str, counters: int = COUNTERS) -> DataFrame:
    """At most ``counters`` values of a text column, among them every value
    that makes up at least 2 / (counters + 1) of the rows.

    The partitions' summaries are added up by value. A sum falls short of the
    true count by at most rows / (counters + 1), and all sums together do not
    exceed the rows, so no more than ``counters`` of them exceed that share.
    The column must not hold nulls; an empty table has no such value.
    """
    rows = df.count()
    return (df.select(column).mapInArrow(_summaries(column, counters), "value string, n long")
            .groupBy("value").agg(F.sum("n").alias("n"))
            .where(F.col("n") * (counters + 1) > rows)
            .select(F.col("value").alias(column)))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     counters: int = COUNTERS) -> DataFrame:
    """One row per input row: its id, ``keep_id`` (smallest id of the rows with
    an equal text), ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal when they are identical after replacing each run of white
    space by one space; SHA-256 of that text stands for it. A null text is an
    empty one. Rows that repeat both id and text share their verdict. A null id
    comes after all others: such a row stays only in a group without any id,
    where all rows stay and ``keep_id`` is null. Other columns are ignored;
    an empty table gives an empty result.
    """
    _, resolved = _resolve(docs, id_col, text_col, counters)
    return resolved.select(F.col("doc_id").alias(id_col), "keep_id", "group_size",
                           F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                           F.col("digest").alias("text_sha256"))


def _resolve(docs: DataFrame, id_col: str, text_col: str, counters: int) -> tuple[DataFrame, DataFrame]:
    """Winners of the frequent digests (at most ``counters`` short rows), and
    (doc_id, digest, keep_id, group_size) of all rows."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    marked = materialize(with_digest(rows, "text", "digest").select("doc_id", "digest"))
    winner = (F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    # At most `counters` rows of a digest, an id and a count: a fixed bound.
    frequent = F.broadcast(frequent_values(marked, "digest", counters))
    verified = materialize(marked.join(frequent, "digest").groupBy("digest").agg(*winner))
    split = marked.join(F.broadcast(verified), "digest", "left")
    rest = split.where(F.col("group_size").isNull()).select("doc_id", "digest")
    return verified, (split.where(F.col("group_size").isNotNull())
                      .unionByName(rest.join(rest.groupBy("digest").agg(*winner), "digest")))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          counters: int = COUNTERS) -> DataFrame:
    """``docs`` with one row of each group of equal texts, columns unchanged.

    Rows that repeat both id and text are reduced to one as well. Copies of
    frequent texts are removed on the map side, by the broadcast winners; what
    is left meets the list of rows that stay."""
    names = docs.columns
    sha, keep, kept_sha, nth = (spare_name(docs, n) for n in ("sha", "keep", "kept_sha", "nth"))
    verified, resolved = _resolve(docs, id_col, text_col, counters)
    kept = (resolved.where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
            .select(F.col("doc_id").alias(keep), F.col("digest").alias(kept_sha)).distinct())
    own = F.col(f"`{id_col}`")
    copies = F.broadcast(verified.select(F.col("keep_id").alias(keep), F.col("digest").alias(kept_sha)))
    rows = with_digest(docs, text_col, sha)
    rows = rows.join(copies, (F.col(sha) == F.col(kept_sha)) & ~own.eqNullSafe(F.col(keep)), "left_anti")
    rows = rows.join(kept, own.eqNullSafe(F.col(keep)) & (F.col(sha) == F.col(kept_sha)), "left_semi")
    order = Window.partitionBy(own, sha).orderBy(
        F.xxhash64(*[f"`{c}`" for c, kind in docs.dtypes if "map<" not in kind]))
    return rows.withColumn(nth, F.row_number().over(order)).where(F.col(nth) == 1).select(*[f"`{c}`" for c in names])


ORACLE_SQL = """
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS digest FROM documents
), g AS (SELECT digest, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY digest)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, t.digest AS text_sha256
FROM t JOIN g USING (digest)
"""
