"""Near-duplicates by min-max hashing of word shingles.

One pass over the texts hashes every distinct shingle under each permutation
and keeps both the minimum and the maximum, so ``2 * permutations`` signature
lanes cost ``permutations`` evaluations. Bands of lanes give bucket keys.

Documents with the same shingle set form a class and go on as one; sets move
as hashes, texts do not. Links are found in two steps, both confirmed on the
full shingle sets:

1. In every bucket each member is compared with the class of the smallest id. This
   joins large groups of near copies without forming all pairs of them.
2. What may still be linked shares a bucket but not a component. Within those
   buckets an exact prefix filter finds the candidates: shingles are ordered
   by how many of these documents hold them, and a pair can only reach the
   threshold if its first common shingle comes early enough in both. It takes
   the place of comparing all pairs of a bucket and loses none.

Components of the confirmed links come from distributed star contraction.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facets.llm.common import hot_join, hot_keys, materialize, mix64, shingles, spare_name, text_chunks
from facets.llm.components import connected_components

#: 32 bands of 5 lanes, from 80 evaluations of a hash: a link at a similarity
#: of exactly 0.8 shares no bucket with a chance of (1 - 0.8**5)**32 = 3e-6.
BANDS, LANES = 32, 5
SEED = 20240229


def signatures(hashes: np.ndarray, bounds: np.ndarray, lanes: int, seed: int = SEED) -> np.ndarray:
    """Min-max signature of each row of shingle hashes, one row per non-empty
    set and ``lanes`` (an even number) columns: lane 2k has the minimum and
    lane 2k+1 the maximum under permutation k of the 32-bit hash space."""
    first = bounds[:-1][np.diff(bounds) > 0]
    out = np.empty((len(first), lanes), np.uint32)
    h = (hashes >> np.uint64(32)).astype(np.uint32)
    rng = np.random.default_rng(seed)
    flips = rng.integers(0, 1 << 32, lanes // 2, dtype=np.uint64).astype(np.uint32)
    factors = rng.integers(0, 1 << 31, lanes // 2, dtype=np.uint64).astype(np.uint32) * np.uint32(2) + np.uint32(1)
    for k in range(lanes // 2):
        v = (h ^ flips[k]) * factors[k]
        out[:, 2 * k] = np.minimum.reduceat(v, first)
        out[:, 2 * k + 1] = np.maximum.reduceat(v, first)
    return out


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit bucket key per band, different bands having different keys."""
    rows, lanes = signature.shape
    per = lanes // bands
    keys = np.empty((rows, bands), np.uint64)
    for j in range(bands):
        k = np.full(rows, j + 1, np.uint64)
        for lane in range(j * per, (j + 1) * per):
            k = mix64(k * np.uint64(0x9FB21C651E98DF25) + signature[:, lane].astype(np.uint64))
        keys[:, j] = k
    return keys


def _set_id(hashes: np.ndarray) -> bytes | None:
    """SHA-256 of an ascending set; null if it is empty."""
    return hashlib.sha256(hashes.tobytes()).digest() if len(hashes) else None


def _set_column(width: int):
    """The id of each text's shingle set."""

    @F.pandas_udf("binary")
    def ids(texts: pd.Series) -> pd.Series:
        out = []
        for _, data, offs in text_chunks(pa.array(texts, pa.large_string(), from_pandas=True)):
            h, bounds = shingles(data, offs, width)
            out += [_set_id(h[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        return pd.Series(out, dtype=object)

    return ids


def _sketcher(width: int, bands: int, lanes: int):
    total = bands * lanes + (bands * lanes) % 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offs in text_chunks(batch.column(1)):
                rows = len(offs) - 1
                h, bounds = shingles(data, offs, width)
                sizes = np.diff(bounds)
                full = np.flatnonzero(sizes)
                keys = np.zeros((0, bands), np.uint64)
                if len(full):
                    keys = band_keys(signatures(h, bounds, total)[:, :bands * lanes], bands)
                ids = [_set_id(h[bounds[r]:bounds[r + 1]]) for r in range(rows)]
                list_offs = np.concatenate(([0], np.cumsum((sizes > 0) * bands))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, rows), pa.array(sizes.astype(np.int64)), pa.array(ids, pa.binary()),
                     pa.ListArray.from_arrays(list_offs, pa.array(keys.ravel().view(np.int64)))],
                    names=["doc_id", "n_shingles", "set_id", "buckets"])

    return run


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
             bands: int = BANDS, lanes: int = LANES) -> DataFrame:
    """(doc_id, n_shingles, set_id, buckets): size of the shingle set, SHA-256
    of the ordered set (null if it is empty), and its bucket key in each band."""
    id_type = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(_sketcher(width, bands, lanes),
                        f"doc_id {id_type}, n_shingles long, set_id binary, buckets array<long>"))


def _hashed_sets(width: int, matched: bool):
    """(c, tokens) of (c, text), or (c, tokens, times) of (c, text, set_id,
    times) where the text's set has that id; a set is its shingle hashes,
    ascending as unsigned numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column(2).to_pylist() if matched else None
            for first, data, offs in text_chunks(batch.column(1)):
                h, bounds = shingles(data, offs, width)
                rows = np.arange(len(offs) - 1)
                if matched:
                    rows = np.array([r for r in rows if _set_id(h[bounds[r]:bounds[r + 1]]) == wanted[first + r]], np.int64)
                taken = np.concatenate([h[bounds[r]:bounds[r + 1]] for r in rows] or [h[:0]]).view(np.int64)
                list_offs = np.concatenate(([0], np.cumsum(np.diff(bounds)[rows]))).astype(np.int32)
                at = pa.array(first + rows)
                times = [batch.column(3).take(at)] if matched else []
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), pa.ListArray.from_arrays(list_offs, pa.array(taken)), *times],
                                                 names=["c", "tokens", "times"][:2 + len(times)])

    return run


def hashed_sets(texts: DataFrame, width: int) -> DataFrame:
    """(c, tokens): the shingle set of each row of ``texts`` (c, text)."""
    kind = texts.schema["c"].dataType.simpleString()
    return texts.select("c", "text").mapInArrow(_hashed_sets(width, False), f"c {kind}, tokens array<long>")


def _overlap(a: np.ndarray, b: np.ndarray) -> int:
    both = np.concatenate((a, b))
    both.sort()
    return int((both[1:] == both[:-1]).sum())


def _confirm(percent: int):
    """Keeps the (a, b) whose sets reach the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets = [np.asarray(c.offsets) for c in batch.columns[2:]]
            values = [np.asarray(c.values) for c in batch.columns[2:]]
            good = []
            for i in range(batch.num_rows):
                a, b = (v[o[i]:o[i + 1]] for v, o in zip(values, offsets, strict=True))
                common = _overlap(a, b)
                union = len(a) + len(b) - common
                if union and 100 * common >= percent * union:
                    good.append(i)
            picked = pa.array(good, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(picked), batch.column(1).take(picked)], names=["a", "b"])

    return run


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the distinct (a, b) whose sets in ``sets`` (c, tokens) reach
    ``percent``; many pairs may have one a."""
    kind = sets.schema["c"].dataType.simpleString()
    pairs = materialize(pairs)
    hot = hot_keys(pairs.groupBy("a").agg(F.count(F.lit(1)).alias("k")), "a", "k", pairs.count())
    rows = hot_join(pairs.join(sets.select(F.col("c").alias("b"), F.col("tokens").alias("b_tokens")), "b"),
                    sets.select(F.col("c").alias("a"), F.col("tokens").alias("a_tokens")), "a", hot)
    return rows.select("a", "b", "a_tokens", "b_tokens").mapInArrow(_confirm(percent), f"a {kind}, b {kind}")


def _size_fits(m: Column, n: Column, percent: int) -> Column:
    return 100 * F.least(m, n) >= percent * F.greatest(m, n)


def prefix_pairs(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Distinct candidate pairs (a < b) of different components among
    ``members`` (c, n, component); exact for any similarity of at least
    ``percent`` among them.

    A pair of sets of m and n shingles reaches the threshold only with
    ``need = ceil(percent * (m + n) / (100 + percent))`` common ones, so in a
    common order of shingles the first common one has no more than m - need
    others before it in one set and n - need in the other. With rare shingles
    first, passages that many documents share come too late to matter.
    """
    tokens = sets.join(members.select("c"), "c", "left_semi").select("c", F.explode("tokens").alias("token"))
    shared = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    lists = (tokens.join(shared, "token").groupBy("c")
             .agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("common")))
    # shingles of one document alone come first in the order: n - size(common) of them
    early = (lists.join(members, "c")
             .withColumn("alone", F.col("n") - F.size("common"))
             .select("c", "n", "component", "alone",
                     F.posexplode(F.expr(f"slice(common, 1, greatest(0, cast(n - ceil({percent} * n / 100.0) + 1 - alone as int)))"))
                     .alias("nth", "entry"))
             .select("c", "n", "component", F.col("entry.token").alias("token"), (F.col("alone") + F.col("nth")).alias("before")))
    early = materialize(early)
    side = ("c", "n", "component", "before")
    x = early.select("token", *[F.col(c).alias(f"x_{c}") for c in side])
    y = early.select("token", *[F.col(c).alias(f"y_{c}") for c in side])
    need = f"ceil({percent} * (x_n + y_n) / {100 + percent}.0)"
    near = x.join(y, "token").where(F.expr(
        f"x_c < y_c and x_component <> y_component and x_before <= x_n - {need} and y_before <= y_n - {need}")
        & _size_fits(F.col("x_n"), F.col("y_n"), percent))
    return near.select(F.col("x_c").alias("a"), F.col("y_c").alias("b")).distinct()


def linked_sets(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int, bands: int,
                lanes: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(doc_id, n_shingles, set_id) of each row; (c, set_id, doc_id, k) of each
    distinct set, with the smallest of its ids and the number of its rows; links
    (a, b) of sets."""
    marked = materialize(sketches(docs, id_col, text_col, width, bands, lanes))
    usable = marked.where(F.col("set_id").isNotNull() & F.col("doc_id").isNotNull())
    classes = materialize(usable.groupBy("set_id").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("k"), F.first("n_shingles").alias("n"),
                                                       F.first("buckets").alias("buckets")).withColumn("c", F.monotonically_increasing_id()))
    rows = classes.select("c", "n", "doc_id", F.explode("buckets").alias("bucket"))
    # of many edited copies the one with the smallest id is likeliest to be what the others were made from
    lead = materialize(rows.groupBy("bucket").agg(
        F.min(F.struct("doc_id", F.col("c").alias("lead"), F.col("n").alias("lead_n"))).alias("first"), F.count(F.lit(1)).alias("size"))
        .where("size > 1").select("bucket", "first.lead", "first.lead_n", "size"))
    members = materialize(hot_join(rows.drop("doc_id"), lead.drop("size"), "bucket", hot_keys(lead, "bucket", "size", bands * classes.count())))

    # one row of each set that shares a bucket; an id may have several rows, so the set is checked
    again = usable.groupBy("doc_id").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    crowd = (classes.join(members.select("c").distinct(), "c", "left_semi").select("c", "set_id", "doc_id")
             .join(again, "doc_id", "left"))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = materialize(texts.join(crowd, "doc_id").select("c", "text", "set_id", "times")
                        .mapInArrow(_hashed_sets(width, True), "c long, tokens array<long>, times long"))
    sets = found.where("times is null").select("c", "tokens").union(found.where("times is not null").select("c", "tokens").dropDuplicates(["c"]))
    star = (members.where("c <> lead").where(_size_fits(F.col("n"), F.col("lead_n"), percent))
            .select(F.col("lead").alias("a"), F.col("c").alias("b")).distinct())
    links = materialize(confirmed(star, sets, percent))

    joined = connected_components(links)
    placed = members.select("bucket", "c", "n").join(joined.withColumnRenamed("id", "c"), "c", "left").select(
        "bucket", "c", "n", F.coalesce("component", "c").alias("component"))
    open_buckets = (placed.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
                    .where("lo < hi").select("bucket"))
    left = materialize(placed.join(open_buckets, "bucket", "left_semi").groupBy("c")
                       .agg(F.min("n").alias("n"), F.min("component").alias("component")))
    more = confirmed(prefix_pairs(left, sets, percent), sets, percent)
    return marked.select("doc_id", "n_shingles", "set_id"), classes.select("c", "set_id", "doc_id", "k"), materialize(links.union(more))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                    percent: int = 80, bands: int = BANDS, lanes: int = LANES) -> DataFrame:
    """One row per input row: its id, ``n_shingles``, ``component_id`` (smallest
    id that links reach, itself included) and ``kept`` (it has that id).

    Texts are lower-cased (A-Z) and cut into words at white space; a set holds
    the distinct shingles of ``width`` words, or the whole sequence if there are
    fewer. Sets are linked when 100 * intersection >= ``percent`` * union.

    A null or empty text, or one without words, has an empty set, which is
    linked with nothing. A row with a null id is linked with nothing either: its
    component is null and it is kept. Rows with one id are one node, linked by
    all their sets: they share a component, and each keeps its own set size.
    Other columns are ignored; an empty table gives an empty result.
    """
    marked, classes, links = linked_sets(docs, id_col, text_col, width, percent, bands, lanes)
    known = marked.where("doc_id is not null")
    of_id = known.groupBy("doc_id").agg(F.min("set_id").alias("lo"), F.max("set_id").alias("hi"), F.count_if(F.col("set_id").isNull()).alias("empty"))
    odd = materialize(of_id.where("lo is not null and (lo <> hi or empty > 0)"))  # ids with several sets, or one and an empty text
    by_id = (known.join(odd, "doc_id").where("set_id <> lo").select("lo", "set_id").distinct()
             .join(classes.select(F.col("set_id").alias("lo"), F.col("c").alias("a")), "lo")
             .join(classes.select("set_id", F.col("c").alias("b")), "set_id").select("a", "b"))

    placed = _placed(classes, links.union(by_id))
    lowest = placed.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    by_set = placed.select("set_id", "component").join(lowest, "component").select(F.col("set_id").alias("node"), "component_id")
    common = hot_keys(classes, "set_id", "k", marked.count())
    rows = marked.join(odd.where("empty > 0").select("doc_id", "lo"), "doc_id", "left").withColumn("node", F.coalesce("set_id", "lo"))
    linked = hot_join(rows.where("node is not null and doc_id is not null").select("doc_id", "n_shingles", "node"), by_set, "node", common)
    alone = rows.where("node is null or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    found = linked.select("doc_id", "n_shingles", "component_id").union(alone)
    return found.select(F.col("doc_id").alias(id_col), "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def _placed(classes: DataFrame, links: DataFrame) -> DataFrame:
    """``classes`` with the component of each set."""
    return (classes.join(connected_components(links).withColumnRenamed("id", "c"), "c", "left")
            .withColumn("component", F.coalesce("component", "c")))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80,
                         bands: int = BANDS, lanes: int = LANES) -> DataFrame:
    """``docs`` with one document of each group of linked texts, that with the
    smallest id, columns unchanged.

    Here each text counts on its own: if an id carries several texts, each
    group of texts keeps a row, whatever ids they share. Rows with a null id or
    without words stay; rows that repeat an id and a set of shingles stay or go
    together.
    """
    marked, classes, links = linked_sets(docs, id_col, text_col, width, percent, bands, lanes)
    placed = _placed(classes, links)
    winner = placed.groupBy("component").agg(F.min(F.struct("doc_id", "set_id")).alias("w")).select(F.col("w.set_id").alias("set_id"), F.col("w.doc_id").alias("keep"))
    of_set = classes.select("set_id").join(winner, "set_id", "left")
    known = marked.where("doc_id is not null")
    decided = hot_join(known.where("set_id is not null").select("doc_id", "set_id"), of_set, "set_id",
                       hot_keys(classes, "set_id", "k", marked.count())).select(
        "doc_id", "set_id", F.coalesce(F.col("keep") == F.col("doc_id"), F.lit(False)).alias("stays"))
    decided = materialize(decided.union(known.where("set_id is null").select("doc_id", "set_id", F.lit(True))))
    of_id = decided.groupBy(F.col("doc_id").alias(id_col)).agg(F.bool_or("stays").alias("some"), F.bool_and("stays").alias("every"))
    columns = [f"`{c}`" for c in docs.columns]
    kept = docs.join(of_id.where("not some").select(id_col), id_col, "left_anti").select(*columns)
    split = of_id.where("some and not every").select(id_col)
    if split.isEmpty():
        return kept
    # some rows of these ids stay: told apart by their sets
    tag = spare_name(docs, "_set")
    parted = kept.join(split, id_col, "left_semi").select(*columns, _set_column(width)(F.col(text_col).cast("string")).alias(tag))
    stay = decided.where("stays").select(F.col("doc_id").alias(id_col), F.col("set_id").alias(tag)).distinct()
    some = parted.where(F.col(tag).isNull()).union(parted.join(stay, [id_col, tag], "left_semi").select(*columns, tag))
    return kept.join(split, id_col, "left_anti").select(*columns).union(some.select(*columns))


ORACLE_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM documents
), x AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS nth FROM w
), y AS (
  SELECT doc_id, word || ' ' || lead(word) OVER p || ' ' || lead(word, 2) OVER p || ' ' || lead(word, 3) OVER p AS token
  FROM x WINDOW p AS (PARTITION BY doc_id ORDER BY nth)
), u AS (
  SELECT DISTINCT doc_id, token FROM y WHERE token IS NOT NULL
  UNION ALL SELECT doc_id, array_to_string(words, ' ') FROM w WHERE len(words) BETWEEN 1 AND 3
), n AS (SELECT d.doc_id, count(u.token) AS n_shingles FROM documents d LEFT JOIN u USING (doc_id) GROUP BY d.doc_id
), c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM u x JOIN u y USING (token)
  WHERE x.doc_id <> y.doc_id GROUP BY 1, 2
), l AS (SELECT a, b FROM c JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
  WHERE 100 * common >= 80 * (p.n_shingles + q.n_shingles - common)
), r(id, reach) AS (
  SELECT doc_id, doc_id FROM n UNION SELECT r.id, l.b FROM r JOIN l ON l.a = r.reach
)
SELECT n.doc_id, n.n_shingles, min(r.reach) AS component_id, n.doc_id = min(r.reach) AS kept
FROM n JOIN r ON r.id = n.doc_id GROUP BY n.doc_id, n.n_shingles
"""
