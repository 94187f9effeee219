"""Registered queries of the ``llm`` operators, one per operator, each over
its whole table with production parameters, and their DuckDB twins."""

from __future__ import annotations

import functools
import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facets.llm import bpe, collocations, exact_dedup, fingerprints, hard_negatives, langid, line_dedup, minhash, mixing, quality, toxicity, url_filter, vector_dedup
from facets.llm.common import documents, in_fold, read_table, ship_package


def default_vocabulary() -> str:
    """Path of the installed public vocabulary of lower-cased words."""
    return str(importlib.import_module("public_tokenizers").path("word_bpe_49k.json"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    chain = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    score = F.col("p_toxic")
    return toxicity.predict(docs, chain).select(
        "doc_id", score.alias("score"), (score >= chain.threshold).cast("int").alias("toxic"), (score < chain.threshold).alias("kept"),
        "p_insult", "p_contempt")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(documents(spark, sf_dir), default_vocabulary(), result=bpe.DIGESTS)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_boilerplate(documents(spark, sf_dir))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(documents(spark, sf_dir), mixing.cyclic_weights(5, 2, 1))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality.fit(docs, read_table(spark, sf_dir, "labels"), learn=~in_fold("doc_id", 3, 1))
    return quality.score(docs, model).select(
        "doc_id", in_fold("doc_id", 3, 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read_table(spark, sf_dir, "pages").select("page_id", "url"))


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = langid.fit(docs, learn=~in_fold("doc_id", 5, 0))
    return langid.identify(docs, model).select("doc_id", in_fold("doc_id", 5, 0).alias("held_out"), "lang_pred", "score", "rejected")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_neighbours(documents(spark, sf_dir))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), width=4, percent=80)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best phrases of each language of all documents."""
    return collocations.collocations(documents(spark, sf_dir))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hard negatives for each of five positives of every 50th vector;
    every seventh vector has a label of its own making."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", label.alias("label"), "embedding")
    return hard_negatives.hard_negatives(vectors, anchors=F.col("id") % 50 == 0)


def op13_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors at a cosine of 0.9."""
    return vector_dedup.near_vectors(read_table(spark, sf_dir, "embeddings"))


Query = Callable[[SparkSession, str], DataFrame]


def _ready(query: Query) -> Query:
    """The query on a session whose workers can import this package."""

    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {q.__name__: _ready(q) for q in (
    op1_toxicity, op2_bpe, op3_line_dedup, op4_mixing, op5_quality, op6_url_filter, op7_langid, op8_exact_dedup, op9_fingerprints,
    op10_minhash, op11_collocations, op12_hard_negatives, op13_vector_dedup)}

ORACLE: dict[str, str] = {
    "op3_line_dedup": line_dedup.oracle_sql(),
    "op8_exact_dedup": exact_dedup.ORACLE_SQL,
    "op10_minhash": minhash.ORACLE_SQL,
    "op11_collocations": collocations.ORACLE_SQL,
    "op12_hard_negatives": hard_negatives.ORACLE_SQL,
    "op13_vector_dedup": vector_dedup.ORACLE_SQL,
}
