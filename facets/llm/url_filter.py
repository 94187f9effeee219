"""URL filter: rules, and gradient-boosted trees on lexical features where no
rule fits.

The trees learn from labelled URLs. Where there is no table of labels, the URLs
that a rule decides serve as labelled ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facets.llm.boosting import Trees, fit_trees
from facets.llm.common import first_by_hash, text_chunks

#: Labelled URLs that a model is fitted on at most, those first by hash of the URL.
FIT_ROWS = 20_000
#: Suffix statistics are kept for so many hash buckets of suffixes.
SUFFIXES = 1024

#: The rules of the registered query, as (verdict, host/path).
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))

FEATURES = ("length", "host_length", "path_length", "depth", "labels", "digits", "entropy", "parameters", "hyphens",
            "fragment", "secure", "suffix_rate", "suffix_rows")


def split_url(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path; both empty without ``://``."""
    form = "(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url.cast("string"), F.lit(""))
    host = F.translate(F.regexp_extract(text, form, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(text, form, 2)


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    """The longest rule that fits: its host is the URL's or a parent domain,
    and the URL's path starts with its path; else null."""
    found = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        cut = rule.index("/")
        fits = ((host == rule[:cut]) | host.endswith("." + rule[:cut])) & path.startswith(rule[cut:])
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def _suffix(host: Column) -> Column:
    """Hash bucket of the host's last label."""
    return F.pmod(F.xxhash64(F.substring_index(host, ".", -1)), F.lit(SUFFIXES)).cast("int")


def url_features(data: np.ndarray, offs: np.ndarray, hosts: np.ndarray, paths: np.ndarray, labels: np.ndarray,
                 suffix: np.ndarray, rates: np.ndarray, rows_of: np.ndarray) -> np.ndarray:
    """Lexical features of each URL of a chunk: counts over its bytes, lengths
    of its parts, and the statistics of its host's suffix."""
    rows = len(offs) - 1
    size = np.diff(offs).astype(float)
    out = np.zeros((rows, len(FEATURES)))
    for a in range(0, rows, 2048):
        z = min(rows, a + 2048)
        part = data[offs[a]:offs[z]]
        row = np.repeat(np.arange(z - a), np.diff(offs[a:z + 1]))
        n = np.bincount(row * 256 + part, minlength=(z - a) * 256).reshape(z - a, 256).astype(float)
        share = n / np.maximum(size[a:z, None], 1)
        entropy = -(share * np.log2(np.where(share > 0, share, 1))).sum(1)
        digits = n[:, 48:58].sum(1)
        out[a:z] = np.stack([size[a:z], hosts[a:z], paths[a:z], n[:, 47], labels[a:z], digits / np.maximum(size[a:z], 1), entropy,
                             n[:, 38] + n[:, 63], n[:, 45], n[:, 35], np.zeros(z - a), rates[suffix[a:z]], rows_of[suffix[a:z]]], axis=1)
    heads = np.array([bytes(data[o:o + 8]).lower().startswith(b"https://") for o in offs[:-1]], float) if rows else np.zeros(0)
    out[:, FEATURES.index("secure")] = heads
    return out


def _inputs(urls: DataFrame, extra: list[str]) -> DataFrame:
    host, path = F.col("host"), F.col("path")
    return urls.select(*extra, F.coalesce(F.col("url"), F.lit("")).alias("url"), F.length(host).alias("host_length"),
                       F.length(path).alias("path_length"), F.size(F.split(host, "\\.")).alias("labels"), _suffix(host).alias("suffix"))


def _batch_features(batch: pa.RecordBatch, at: int, rates: np.ndarray, rows_of: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Features of a batch whose columns from ``at`` on are those of ``_inputs``."""
    hosts, paths, labels, suffix = (np.asarray(batch.column(at + i)) for i in range(1, 5))
    for first, data, offs in text_chunks(batch.column(at)):
        own = slice(first, first + len(offs) - 1)
        yield first, url_features(data, offs, hosts[own], paths[own], labels[own], suffix[own], rates, rows_of)


def fit(labelled: DataFrame, fit_rows: int = FIT_ROWS, **options) -> tuple[Trees, np.ndarray, np.ndarray]:
    """Trees and suffix statistics from (url, host, path, blocked): the
    statistics from all labelled rows, as a table of ``SUFFIXES`` entries; the
    trees from ``fit_rows`` of them at most. Without rows, every score is 0.5."""
    stats = (labelled.groupBy(_suffix(F.col("host")).alias("suffix"))
             .agg(F.count(F.lit(1)).alias("n"), F.sum("blocked").alias("b")).collect())
    rates, rows_of = np.full(SUFFIXES, 0.5), np.zeros(SUFFIXES)
    for s in stats:
        rates[s["suffix"]], rows_of[s["suffix"]] = (s["b"] + 1) / (s["n"] + 2), np.log1p(s["n"])
    few = first_by_hash(labelled, fit_rows, F.xxhash64("url"), "url")
    table = _inputs(few, ["blocked"]).toArrow()
    x, y = [np.zeros((0, len(FEATURES)))], [np.zeros(0)]
    for batch in table.to_batches():
        x.extend(f for _, f in _batch_features(batch, 1, rates, rows_of))
        y.append(np.asarray(batch.column(0)).astype(float))
    return fit_trees(np.concatenate(x), np.concatenate(y), **options), rates, rows_of


def judge(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, id_col: str = "page_id", url_col: str = "url",
          fit_rows: int = FIT_ROWS) -> DataFrame:
    """One row per input row: its id, host, path, rule, verdict (``allow`` or
    ``block``) and the trees' score (probability of ``block``).

    The longest fitting rule decides; without one, the trees do: ``block`` from
    a score of 0.5 on. A null URL, or one without ``://``, has an empty host
    and path and no rule. Null and repeated ids stay rows of their own; other
    columns are ignored; an empty table gives an empty result.
    """
    host, path = split_url(F.col(url_col))
    rows = (pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), host.alias("host"), path.alias("path"))
            .withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)))
    blocks = [r for verdict, r in rules if verdict == "block"]
    model = rows.sparkSession.sparkContext.broadcast(
        fit(rows.where("rule is not null").select("url", "host", "path", F.col("rule").isin(blocks).cast("int").alias("blocked")), fit_rows))
    id_type = pages.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, rates, rows_of = model.value
        for batch in batches:
            for first, x in _batch_features(batch, 4, rates, rows_of):
                own = [batch.column(i).slice(first, len(x)) for i in range(4)]
                yield pa.RecordBatch.from_arrays([*own, pa.array(trees.score(x))], names=["page_id", "host", "path", "rule", "score"])

    scored = _inputs(rows, ["page_id", "host", "path", "rule"]).mapInArrow(
        run, f"page_id {id_type}, host string, path string, rule string, score double")
    ruled = F.when(F.col("rule").isin(blocks), "block").otherwise("allow")
    verdict = F.when(F.col("rule").isNotNull(), ruled).otherwise(F.when(F.col("score") >= 0.5, "block").otherwise("allow"))
    return scored.select(F.col("page_id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), "score")
