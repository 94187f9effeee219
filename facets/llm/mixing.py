"""Mixing sources to target weights as a min-cost flow.

Documents that belong to the same sources form one membership pattern. A flow
routes each pattern's words to its sources' quotas; every further repetition of
a pattern's words costs more than the one before, so repetition is spread as
evenly as the memberships allow. What the flow takes from a pattern is then
turned into copies of its documents: as many whole rounds as fit, and one more
copy of documents in a seeded order until the rest is reached.

Only the table of patterns, whose length is checked, comes to the driver.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from facets.llm.common import WORD, materialize

#: Shares of the seeded order for which sizes are added up: a document's place
#: is found from these sums, and exactly only within the one share where a
#: pattern's quota ends.
SHARES = 4096
#: Most patterns that are accepted; more raise an error.
MOST_PATTERNS = 100_000
SEED = 7


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cyclic_weights(*weights: float) -> Callable[[list[str | None]], list[float]]:
    """Weights in turn for the sources in the order of code points, null last."""
    return lambda sources: [weights[i % len(weights)] for i in range(len(sources))]


def capped_targets(sizes: list[int], weights: list[float], cap: float, total: float) -> list[float]:
    """``total`` shared by weight; a share stops at ``cap`` times its source's
    size, and what is left over is shared among the others, again by weight."""
    targets = [0.0] * len(sizes)
    free = [i for i, n in enumerate(sizes) if n and weights[i] > 0]
    left = float(total)
    while free:
        unit = left / sum(weights[i] for i in free)
        over = [i for i in free if weights[i] * unit > cap * sizes[i]]
        if not over:
            for i in free:
                targets[i] = weights[i] * unit
            break
        for i in over:
            targets[i] = float(cap * sizes[i])
            left -= targets[i]
        free = [i for i in free if i not in set(over)]
    return targets


def route(capacity: list[int], members: list[list[int]], quotas: list[int], copies: int) -> list[dict[int, int]]:
    """Words that each pattern gives to each of its sources: the largest flow,
    and of those the cheapest, when the n-th copy of a word costs n.

    Successive shortest paths with potentials over patterns and sources."""
    n_p, n_s = len(capacity), len(quotas)
    start, end = n_p + n_s, n_p + n_s + 1
    arcs: list[list[int]] = []  # target, room, cost; an arc's reverse is its neighbour
    out: list[list[int]] = [[] for _ in range(n_p + n_s + 2)]

    def arc(a: int, b: int, room: int, cost: int) -> None:
        out[a].append(len(arcs))
        arcs.append([b, room, cost])
        out[b].append(len(arcs))
        arcs.append([a, 0, -cost])

    for p, n in enumerate(capacity):
        for c in range(copies if n else 0):
            arc(start, p, n, c + 1)
    links = {}
    for p, own in enumerate(members):
        for s in own:
            links[p, s] = len(arcs)
            arc(p, n_p + s, capacity[p] * copies, 0)
    for s, q in enumerate(quotas):
        arc(n_p + s, end, q, 0)

    potential = [0] * len(out)
    while True:
        reach, by = {start: 0}, {}
        heap, done = [(0, start)], set()
        while heap:
            d, a = heapq.heappop(heap)
            if a in done:
                continue
            done.add(a)
            for i in out[a]:
                b, room, cost = arcs[i]
                to = d + cost + potential[a] - potential[b]
                if room and to < reach.get(b, 1 << 60):
                    reach[b], by[b] = to, i
                    heapq.heappush(heap, (to, b))
        if end not in reach:
            break
        for v, d in reach.items():
            potential[v] += min(d, reach[end])
        for v in range(len(out)):
            if v not in reach:
                potential[v] += reach[end]
        path, v = [], end
        while v != start:
            path.append(by[v])
            v = arcs[by[v] ^ 1][0]
        amount = min(arcs[i][1] for i in path)
        for i in path:
            arcs[i][1] -= amount
            arcs[i ^ 1][1] += amount
    flows: list[dict[int, int]] = [{} for _ in capacity]
    for (p, s), i in links.items():
        if arcs[i ^ 1][1]:
            flows[p][s] = arcs[i ^ 1][1]
    return flows


@dataclass
class Mix:
    """``rows``: the input rows with ``key`` (pattern), ``size`` (words) and
    ``copies``, all three after ``prefix``; ``sources``: (source, size, target,
    routed) of each source in code-point order."""

    rows: DataFrame
    prefix: str
    sources: list[tuple[str | None, int, float, int]]


def _order_key(source: str | None) -> tuple[bool, str]:
    return source is None, source or ""


def mix(docs: DataFrame, weights: Callable[[list[str | None]], list[float]], id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source", copies: int = 3, seed: int = SEED) -> Mix:
    """Copies of each document such that the sources' words come near targets.

    ``source_col`` holds a document's source, or an array of the sources it
    belongs to. All sources together are to have as many words as all
    documents; ``weights`` tells how the sources share them, and a source's
    target stops at ``copies`` times its size. No document is taken more than
    ``copies`` times. A null source is a source of its own; an empty array
    belongs to none and is not taken. Null or empty texts have size 0. The
    order in which documents get a further copy depends on ``seed`` and the id
    alone, so reruns agree; repeated ids are ordered by size and text, null ids
    share one place. An empty table gives no rows and no sources.
    """
    spark = docs.sparkSession
    p = "_mix_"
    while any(c.lower().startswith(p) for c in docs.columns):
        p = "_" + p
    own = F.col(f"`{source_col}`")
    is_list = docs.schema[source_col].dataType.typeName() == "array"
    pattern = F.array_sort(F.array_distinct(own.cast("array<string>"))) if is_list else F.array(own.cast("string"))
    key = F.to_json(F.struct(F.coalesce(pattern, F.array(F.lit(None).cast("string"))).alias("s")), {"ignoreNullFields": "false"})
    place = F.xxhash64(F.lit(seed), F.col(f"`{id_col}`").cast("string"))
    rows = docs.withColumns({f"{p}key": key, f"{p}size": word_count(F.col(f"`{text_col}`").cast("string")),
                             f"{p}place": place, f"{p}share": F.shiftrightunsigned(place, 52)})

    sums = materialize(rows.groupBy(f"{p}key", f"{p}share").agg(F.sum(f"{p}size").alias("words")))
    per_pattern = sums.groupBy(f"{p}key").agg(F.sum("words").alias("words")).limit(MOST_PATTERNS + 1).collect()
    if len(per_pattern) > MOST_PATTERNS:
        raise ValueError(f"more than {MOST_PATTERNS} membership patterns")
    patterns = sorted(((json.loads(r[f"{p}key"])["s"], r[f"{p}key"], int(r["words"])) for r in per_pattern), key=lambda x: x[1])
    names = sorted({s for own, _, _ in patterns for s in own}, key=_order_key)
    at = {s: i for i, s in enumerate(names)}
    sizes = [0] * len(names)
    for own, _, n in patterns:
        for s in own:
            sizes[at[s]] += n
    targets = capped_targets(sizes, weights(names), copies, sum(n for own, _, n in patterns if own))
    flows = route([n for _, _, n in patterns], [[at[s] for s in own] for own, _, _ in patterns],
                  [round(t) for t in targets], copies)

    # whole rounds of a pattern, and the words to be had from one more copy of some documents
    wanted = [(k, *divmod(sum(f.values()), n)) if n else (k, 0, 0) for (_, k, n), f in zip(patterns, flows, strict=True)]
    plan = spark.createDataFrame(wanted, f"{p}key string, {p}whole long, {p}rest long")
    so_far = F.sum("words").over(Window.partitionBy(f"{p}key").orderBy(f"{p}share"))
    ends = (sums.join(F.broadcast(plan), f"{p}key").withColumn("upto", so_far)
            .where((F.col("upto") >= F.col(f"{p}rest")) & (F.col("upto") - F.col("words") < F.col(f"{p}rest"))))
    # one row for each pattern: no more than MOST_PATTERNS short rows
    plan = materialize(plan.join(ends.groupBy(f"{p}key").agg(F.min(f"{p}share").alias(f"{p}end"), F.min(F.col("upto") - F.col("words")).alias(f"{p}before")),
                                 f"{p}key", "left"))
    placed = rows.join(F.broadcast(plan.withColumnRenamed(f"{p}key", f"{p}plan")), F.col(f"{p}key") == F.col(f"{p}plan")).drop(f"{p}plan")
    at_end = F.col(f"{p}share").eqNullSafe(F.col(f"{p}end"))
    early = F.when(F.col(f"{p}end").isNotNull() & (F.col(f"{p}share") < F.col(f"{p}end")), 1).otherwise(0)
    order = (Window.partitionBy(f"{p}key").orderBy(f"{p}place", f"{p}size", f"`{text_col}`")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    middle = F.col(f"{p}before") + F.sum(f"{p}size").over(order) - F.col(f"{p}size") / 2
    done = placed.where(~at_end).withColumn(f"{p}copies", F.col(f"{p}whole") + early).unionByName(
        placed.where(at_end).withColumn(f"{p}copies", F.col(f"{p}whole") + F.when(middle <= F.col(f"{p}rest"), 1).otherwise(0)))
    routed = [0] * len(names)
    for f in flows:
        for s, n in f.items():
            routed[s] += n
    return Mix(done.drop(f"{p}place", f"{p}share", f"{p}whole", f"{p}rest", f"{p}end", f"{p}before"), p,
               list(zip(names, sizes, targets, routed, strict=True)))


def mixed_documents(docs: DataFrame, weights: Callable[[list[str | None]], list[float]], **options) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as it has copies,
    columns unchanged."""
    names = docs.columns
    found = mix(docs, weights, **options)
    p = found.prefix
    return found.rows.where(F.col(f"{p}copies") > 0).withColumn(f"{p}nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col(f"{p}copies")))).select(
        *[f"`{c}`" for c in names])


def mix_report(docs: DataFrame, weights: Callable[[list[str | None]], list[float]], id_col: str = "doc_id",
               source_col: str = "source", **options) -> DataFrame:
    """(doc_id, size, source_size, target, taken, source) of documents with
    one source each: a row per document, those not taken included."""
    spark = docs.sparkSession
    found = mix(docs, weights, id_col=id_col, source_col=source_col, **options)
    p = found.prefix
    table = spark.createDataFrame([(s, n, t) for s, n, t, _ in found.sources], f"{p}s string, {p}source_size long, {p}target double")
    # one short row for each source: no more than there are patterns
    rows = found.rows.join(F.broadcast(table), F.col(f"`{source_col}`").cast("string").eqNullSafe(F.col(f"{p}s")), "left")
    return rows.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"{p}size").alias("size"),
                       F.col(f"{p}source_size").alias("source_size"), F.col(f"{p}target").alias("target"),
                       (F.col(f"{p}copies") * F.col(f"{p}size")).alias("taken"), F.col(f"`{source_col}`").alias("source"))
