"""Near-duplicate vectors by cross-polytope hashing.

A vector is turned by a pseudo-random rotation (sign flips and fast Hadamard
transforms, three times); the hash is the axis it then lies nearest to, sign
included. A bucket is the hash under ``PARTS`` rotations together; each of
``TABLES`` tables has its own. A vector lies in one bucket of each table and
looks into those with its second nearest axes as well (multiprobe).

Pairs of a group of copies are never listed. Equal vectors are one class. In
rounds, classes join a centre: the first class of one of their buckets, if it
is within half the angle of the threshold, so that any two members of a group
are linked for sure. Groups that meet in a bucket are candidates, unless bit
sketches of their centres show that they are too far apart. Each class of the
smaller group is compared with the other group's centre: by the angle between
them and the members' own angles to their centre, some members are linked for
sure and others cannot be; these are counted by steps of the angle. Only
members in between are compared one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facets.llm.common import hot_join, hot_keys, materialize, mix64
from facets.llm.components import connected_components

SEED = 20250711
#: Chance that a link just at the threshold is missed; vectors that a bucket holds by chance, about.
MISSED, CROWD = 3e-4, 8
#: Bits of the sketch that is compared before vectors are moved.
BITS = 128
#: Rounds of joining centres; what is left after them stands alone.
ROUNDS = 4
#: Steps in which a group's members are counted by their angle to the centre.
STEPS = 64
#: Angles are trusted up to this error (radians).
SLACK = 1e-6


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row, a power of two wide."""
    n, width = x.shape
    h = 1
    while h < width:
        x = x.reshape(n, -1, 2, h)
        x = np.stack((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), 2).reshape(n, width)
        h *= 2
    return x / np.sqrt(width)


def axes(x: np.ndarray, signs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest and second nearest signed axis of each row after rotation."""
    for s in signs:
        x = hadamard(x * s)
    size = np.abs(x)
    rows = np.arange(len(x))
    first = size.argmax(1)
    size[rows, first] = -1
    second = size.argmax(1)
    return 2 * first + (x[rows, first] < 0), 2 * second + (x[rows, second] < 0)


def buckets(v: np.ndarray, tables: int, parts: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(rows x tables) keys of the buckets that vectors lie in, and (rows x
    tables * (2**parts - 1)) keys of the others that they look into."""
    n, dims = v.shape
    width = max(2, 1 << (max(dims, 1) - 1).bit_length())
    x = np.zeros((n, width))
    x[:, :dims] = v
    rng = np.random.default_rng(seed)
    own, looks = [], []
    for t in range(tables):
        choices = [axes(x, rng.choice([-1.0, 1.0], (3, width))) for _ in range(parts)]
        for which in range(1 << parts):
            key = np.full(n, (dims << 16) + t + 1, np.uint64)  # vectors of different length share no bucket
            for p in range(parts):
                key = mix64(key * np.uint64(0x9FB21C651E98DF25) + choices[p][which >> p & 1].astype(np.uint64) + np.uint64(1))
            (looks if which else own).append(key.view(np.int64))
    return np.stack(own, 1), np.stack(looks, 1)


def sketches(v: np.ndarray, seed: int = SEED + 1) -> np.ndarray:
    """BITS signs of each rotated row, as whole numbers of 64 bits."""
    n, dims = v.shape
    width = max(2, 1 << (max(dims, 1) - 1).bit_length())
    rng = np.random.default_rng(seed)
    signs = []
    while sum(s.shape[1] for s in signs) < BITS:
        x = np.zeros((n, width))
        x[:, :dims] = v
        for s in rng.choice([-1.0, 1.0], (3, width)):
            x = hadamard(x * s)
        signs.append(x[:, :BITS] < 0)
    return np.packbits(np.concatenate(signs, 1)[:, :BITS], axis=1).view(np.int64)


def parts_for(n: int, dims: int) -> int:
    """Rotations of a bucket, so that about CROWD of n random vectors share one."""
    width = max(2, 1 << (max(dims, 1) - 1).bit_length())
    parts = 2
    while n > CROWD * (2 * width) ** parts:
        parts += 1
    return parts


def tables_for(dims: int, parts: int, least: float, missed: float = MISSED) -> int:
    """Tables that miss a link at a cosine of ``least`` with a chance of
    ``missed``, from hashing some thousand random pairs once."""
    rng = np.random.default_rng(SEED + 2)
    pairs = max(200, min(4000, (1 << 21) // max(dims, 1)))
    a, b = rng.normal(size=(2, pairs, max(dims, 2)))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b -= (a * b).sum(1)[:, None] * a
    b /= np.linalg.norm(b, axis=1)[:, None]
    (own_a, look_a), (own_b, look_b) = (buckets(x, 2, parts) for x in (a, least * a + np.sqrt(1 - least * least) * b))
    each = (1 << parts) - 1
    found = 0.0
    for t in range(2):
        looks = slice(t * each, (t + 1) * each)
        x, y = own_a[:, t, None], own_b[:, t, None]
        found += ((x == y) | (x == look_b[:, looks]).any(1, keepdims=True) | (y == look_a[:, looks]).any(1, keepdims=True)).mean() / 2
    return max(1, int(np.ceil(np.log(missed) / np.log1p(-min(max(found, 1e-3), 0.999)))))


def _matrix(lists: pa.Array) -> np.ndarray:
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    flat = np.asarray(lists.flatten())
    return flat.reshape(len(lists), -1) if len(lists) else flat.reshape(0, 0)


def _angles(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cosine and angle of each row of ``a`` with the row of ``b`` beside it.
    Components are brought near one first, so that squares stay in range."""
    a, b = (x * 2.0 ** -np.floor(np.log2(abs(x).max(1)))[:, None] for x in (a, b))
    cosine = np.einsum("ij,ij->i", a, b) / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))
    return cosine, np.arccos(np.clip(cosine, -1, 1))


def _hashed(tables: int, parts: int):
    """(c, v, own, looks, s0, s1): keys of a vector's own buckets and of those
    it looks into, and its sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.asarray(batch.column(1).value_lengths())
            for size in np.unique(sizes):
                some = batch.filter(pa.array(sizes == size))
                for s in range(0, some.num_rows, 2048):
                    part = some.slice(s, 2048)
                    v = _matrix(part.column(1))
                    v = v / abs(v).max(1)[:, None]
                    keys = buckets(v, tables, parts, SEED + int(size))
                    lists = [pa.ListArray.from_arrays(np.arange(0, k.size + 1, k.shape[1], dtype=np.int32), pa.array(k.ravel())) for k in keys]
                    bits = sketches(v)
                    yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *lists, pa.array(bits[:, 0].copy()), pa.array(bits[:, 1].copy())],
                                                     names=["c", "v", "own", "looks", "s0", "s1"])

    return run


def _with_angle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(..., v, w) with the cosine and angle of v and w in their place."""
    for batch in batches:
        sizes = np.asarray(batch.column(batch.num_columns - 2).value_lengths())
        for size in np.unique(sizes):
            some = batch.filter(pa.array(sizes == size))
            cosine, angle = _angles(_matrix(some.column(some.num_columns - 2)), _matrix(some.column(some.num_columns - 1)))
            yield pa.RecordBatch.from_arrays([*some.columns[:-2], pa.array(cosine), pa.array(angle)],
                                             names=[*some.schema.names[:-2], "cosine", "angle"])


def _angled(rows: DataFrame) -> DataFrame:
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-2])
    return rows.mapInArrow(_with_angle, f"{fields}, cosine double, angle double")


def _may_be_within(angle: Column, *sides: str) -> Column:
    """Whether two sketches allow an angle: the bits that differ are at most
    six standard deviations more than expected."""
    a, b = sides
    differ = sum(F.bit_count(F.col(f"{a}{i}").bitwiseXOR(F.col(f"{b}{i}"))) for i in range(BITS // 64))
    share = F.least(angle / np.pi, F.lit(0.5))
    return differ <= BITS * share + 6 * F.sqrt(BITS * share * (1 - share))


def _counted(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("k"))


def grouped(classes: DataFrame, angle: float, rounds: int) -> DataFrame:
    """(c, centre, angle) of each row of ``classes`` (c, v, own, s0, s1): its
    group and the angle to the group's centre, at most ``angle``."""
    left = classes.select("c", "own", "s0", "s1")
    vectors = classes.select("c", "v")
    done, total = None, classes.select(F.sum(F.size("own"))).first()[0] or 0
    for _ in range(rounds):
        rows = left.select("c", "s0", "s1", F.explode("own").alias("bucket"))
        lead = (rows.groupBy("bucket").agg(F.min(F.struct(F.col("c").alias("lead"), F.col("s0").alias("t0"), F.col("s1").alias("t1"))).alias("first"),
                                           F.max("c").alias("last"), F.count(F.lit(1)).alias("k")).where("first.lead < last").select("bucket", "first.*", "k"))
        lead = materialize(lead)
        tries = materialize(hot_join(rows, lead.drop("k"), "bucket", hot_keys(lead, "bucket", "k", total)).where("c <> lead")
                            .where(_may_be_within(F.lit(angle), "s", "t")).select("c", "lead").distinct())
        with_v = hot_join(tries.join(vectors, "c"), vectors.select(F.col("c").alias("lead"), F.col("v").alias("w")), "lead",
                          hot_keys(_counted(tries, "lead"), "lead", "k", tries.count()))
        near = materialize(_angled(with_v.select("c", "lead", "v", "w")).where(F.col("angle") <= angle).select("c", "lead", "angle"))
        taken = near.select(F.col("c").alias("lead")).distinct()  # each has an earlier class near it, so it is no centre
        own = materialize(near.join(taken, "lead", "left_anti").groupBy("c").agg(F.min(F.struct("lead", "angle")).alias("to"))
                          .select("c", F.col("to.lead").alias("centre"), F.col("to.angle").alias("angle")))
        if own.isEmpty():
            break
        centres = own.select(F.col("centre").alias("c")).distinct().select("c", F.col("c").alias("centre"), F.lit(0.0).alias("angle"))
        fixed = own.union(centres)
        done = fixed if done is None else done.union(fixed)
        left = materialize(left.join(fixed.select("c"), "c", "left_anti"))
    alone = left.select("c", F.col("c").alias("centre"), F.lit(0.0).alias("angle"))
    return materialize(alone if done is None else done.union(alone))


def _candidates(classes: DataFrame, members: DataFrame, groups: DataFrame, hot: list, limit: float) -> DataFrame:
    """Distinct pairs (small, big) of centres whose groups meet in a bucket
    and may hold a link; big has at least as many classes."""
    placed = hot_join(classes.select("c", "own", "looks").join(members.select("c", "centre"), "c"), groups, "centre", hot)
    side = ["centre", "n", "radius", "s0", "s1"]

    def entries(column: Column, prefix: str) -> DataFrame:
        rows = placed.select(*side, F.explode(column).alias("bucket")).distinct()
        return rows.select("bucket", *[F.col(c).alias(prefix + c) for c in side])

    met = entries(F.col("own"), "a_").join(entries(F.concat("own", "looks"), "b_"), "bucket").where("a_centre <> b_centre")
    far = F.lit(limit) + F.col("a_radius") + F.col("b_radius")
    order = F.struct("a_n", "a_centre") < F.struct("b_n", "b_centre")
    return (met.where(_may_be_within(far, "a_s", "b_s"))
            .select(F.when(order, F.col("a_centre")).otherwise(F.col("b_centre")).alias("small"),
                    F.when(order, F.col("b_centre")).otherwise(F.col("a_centre")).alias("big")).distinct())


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", least: float = 0.9, rounds: int = ROUNDS) -> DataFrame:
    """One row per input row: its id, ``n_links`` (other vectors found with a
    cosine of ``least`` or more), ``component_id`` (smallest id that links
    reach, itself included) and ``kept`` (it has that id).

    A null vector, one without components, of length zero, or with a null or
    non-finite component is linked with nothing, nor are vectors of different
    numbers of components with each other. A row with a null id is linked with
    nothing either: its component is null and it is kept. Rows that repeat an
    id are vectors of their own that share a component. Other columns are
    ignored; an empty table gives an empty result.

    A link at a cosine of exactly ``least`` is missed with a chance of
    ``MISSED`` if both vectors stand alone; closer ones, and links between
    groups, less often. Nothing below ``least`` is linked.
    """
    limit = float(np.arccos(least))
    width = limit / 2 / STEPS
    rows = vectors.select(F.col(id_col).alias("id"), F.transform(F.col(vec_col).cast("array<double>"), lambda c: c + F.lit(0.0)).alias("v"))  # -0.0 is 0.0
    good = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists("v", lambda c: c != 0)
    rows = rows.select("id", F.when(F.col("id").isNotNull() & F.coalesce(good, F.lit(False)), F.col("v")).alias("v")).withColumn("h", F.xxhash64("v"))
    # one class for all rows with one vector
    classes = materialize(rows.where("v is not null").groupBy("h", "v").agg(F.count(F.lit(1)).alias("weight"), F.min("id").alias("first_id"))
                          .withColumn("c", F.monotonically_increasing_id()))
    n, dims = classes.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    parts = parts_for(n, dims or 1)
    hashed = materialize(classes.select("c", "v").mapInArrow(
        _hashed(tables_for(dims or 1, parts, least), parts), "c long, v array<double>, own array<long>, looks array<long>, s0 long, s1 long"))

    placed = grouped(hashed, limit / 2 - SLACK, rounds)
    step = F.when(F.col("c") == F.col("centre"), -1).otherwise(F.floor(F.col("angle") / width).cast("int"))
    members = materialize(placed.withColumn("step", step).join(classes.select("c", "v", "weight"), "c"))
    groups = members.groupBy("centre").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("radius"), F.sum("weight").alias("group_weight"))
    hot = hot_keys(groups, "centre", "n", n)
    sketched = groups.select("centre", "n", "radius").join(hashed.select(F.col("c").alias("centre"), "s0", "s1"), "centre")
    pairs = materialize(_candidates(hashed, members, sketched, hot, limit))

    # each class of the smaller group with the centre of the larger one
    of_small = members.select(F.col("centre").alias("small"), "c", "weight", "v")
    of_big = members.where("c = centre").select(F.col("centre").alias("big"), F.col("weight").alias("big_weight"), F.col("v").alias("w"))
    sent = (pairs.join(groups.select(F.col("centre").alias("small"), "n"), "small").groupBy("big").agg(F.sum("n").alias("k")))
    bigs = pairs.groupBy("small").agg(F.collect_set("big").alias("bigs"))
    met_small = hot_join(of_small, bigs, "small", hot).select("small", "c", "weight", "v", F.explode("bigs").alias("big"))
    tries = hot_join(met_small, of_big, "big", hot_keys(sent, "big", "k", sent.agg(F.sum("k")).first()[0] or 0))
    reached = materialize(_angled(tries.select("small", "c", "weight", "big", "big_weight", "v", "w")).join(
        groups.select(F.col("centre").alias("big"), "n", "radius"), "big").where(F.col("angle") <= limit + F.col("radius") + SLACK))
    sure = F.floor((limit - SLACK - F.col("angle")) / width).cast("int") - 1  # members up to this step are linked
    reached = reached.select("*", F.least(sure, F.lit(STEPS)).alias("sure"), (F.col("cosine") >= least).alias("hit"))
    at_steps = members.where("step >= 0").groupBy("centre", "step").agg(F.sum("weight").alias("step_weight"))
    counted = reached.where("sure >= 0 and n > 1").select("small", "c", "weight", "big", F.explode(F.sequence(F.lit(0), "sure")).alias("step")).join(
        at_steps.select(F.col("centre").alias("big"), "step", "step_weight"), ["big", "step"])
    # neither surely linked nor surely apart: these steps of the group are looked through
    first = F.greatest(F.col("sure") + 1, F.floor((F.col("angle") - limit - SLACK) / width).cast("int"), F.lit(0))
    last = F.floor(F.col("radius") / width).cast("int")
    open_ = (reached.where("n > 1").withColumn("first", first).withColumn("last", last).where("first <= last")
             .select("small", "c", "weight", "big", F.explode(F.sequence("first", "last")).alias("step"))
             .join(members.where("step >= 0").select(F.col("centre").alias("big"), "step", F.col("c").alias("other"), F.col("weight").alias("other_weight")),
                   ["big", "step"]))
    own_v = members.select("c", "v")
    checked = open_.select("small", "big", "c", "weight", "other", "other_weight").join(own_v, "c").join(
        own_v.select(F.col("c").alias("other"), F.col("v").alias("w")), "other")
    checked = materialize(_angled(checked.select("small", "big", "c", "weight", "other", "other_weight", "v", "w")).where(F.col("cosine") >= least))

    # what each class gains, and what all members at a step gain
    gains = (reached.where("hit").select("c", F.col("big_weight").alias("gain"))
             .union(reached.where("hit").select(F.col("big").alias("c"), F.col("weight").alias("gain")))
             .union(counted.select("c", F.col("step_weight").alias("gain")))
             .union(checked.select("c", F.col("other_weight").alias("gain")))
             .union(checked.select(F.col("other").alias("c"), F.col("weight").alias("gain"))).groupBy("c").agg(F.sum("gain").alias("gain")))
    for_steps = counted.groupBy(F.col("big").alias("centre"), "step").agg(F.sum("weight").alias("step_gain"))
    met = (reached.where("hit").select("small", "big").union(counted.select("small", "big")).union(checked.select("small", "big"))).distinct()

    # rows that share an id share a component
    classed = rows.where("v is not null").select("id", "h", "v")
    several = (classed.join(classed.groupBy("id").agg(F.count_distinct("h").alias("k")).where("k > 1").select("id"), "id", "left_semi")
               .join(classes.select("h", "v", "c"), ["h", "v"]).join(members.select("c", "centre"), "c"))
    by_id = several.select("centre", "id").join(several.groupBy("id").agg(F.min("centre").alias("low")), "id").select("centre", "low")
    joined = connected_components(met.union(by_id), "small", "big")
    first_ids = members.select("c", "centre").join(classes.select("c", "first_id"), "c").groupBy("centre").agg(F.min("first_id").alias("first_id"))
    whole = (groups.select("centre", "group_weight").join(first_ids, "centre")
             .join(joined.select(F.col("id").alias("centre"), "component"), "centre", "left").withColumn("component", F.coalesce("component", "centre")))
    lowest = whole.groupBy("component").agg(F.min("first_id").alias("component_id"))
    of_group = whole.select("centre", "group_weight", "component").join(lowest, "component").drop("component")
    of_class = (hot_join(members.select("c", "centre", "step"), of_group, "centre", hot).join(for_steps, ["centre", "step"], "left")
                .join(gains, "c", "left").select("c", "component_id", (
                    F.col("group_weight") - 1 + F.coalesce("gain", F.lit(0)) + F.coalesce("step_gain", F.lit(0))).alias("n_links")))
    of_vector = classes.select("h", "c", F.col("v").alias("w")).join(of_class, "c").drop("c")
    copies = hot_keys(classes.groupBy("h").agg(F.sum("weight").alias("k")), "h", "k", classes.agg(F.sum("weight")).first()[0] or 0)
    linked = hot_join(rows.where("v is not null"), of_vector, "h", copies).where(F.col("v") == F.col("w")).select("id", "n_links", "component_id")
    found = linked.union(rows.where("v is null").select("id", F.lit(0).cast("long"), "id"))
    return found.select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


ORACLE_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.9
), r(id, reach) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.id, l.b FROM r JOIN l ON l.a = r.reach
), c AS (SELECT id, min(reach) AS component_id FROM r GROUP BY id
), n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT c.id AS vec_id, CAST(coalesce(n.n_links, 0) AS BIGINT) AS n_links, c.component_id, c.id = c.component_id AS kept
FROM c LEFT JOIN n ON n.a = c.id
"""
