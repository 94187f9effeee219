"""From raw documents to tokens: five stages, each a Spark job over all rows
that the stage before kept.

``run`` applies ``STAGES`` to the table of documents, writing each stage's rows
as Parquet into the shared folder that the cluster names in
``spark.checkpoint.dir`` and reading them again, so that no stage depends on
the executors that ran an earlier one. A stage takes (spark, docs, sf_dir) and
returns a DataFrame; all but the last return the columns of ``docs``.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from facets.llm import bpe, exact_dedup, minhash, mixing, toxicity
from facets.llm.common import documents, read_table, ship_package
from facets.llm.queries import default_vocabulary
from facets.sources.parquet import shared_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not call toxic. It is fitted on
    the labelled documents of ``sf_dir``."""
    ship_package(spark)
    chain = toxicity.fit(documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, chain)


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that with the smallest id."""
    ship_package(spark)
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates (five-word shingles,
    similarity of 0.8 or more), that with the smallest id."""
    ship_package(spark)
    return minhash.drop_near_duplicates(docs, width=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: sources weigh 5, 2, 1 in turn,
    no document is taken more than three times."""
    ship_package(spark)
    return mixing.mixed_documents(docs, mixing.cyclic_weights(5, 2, 1), copies=3)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each row's whole text."""
    ship_package(spark)
    return bpe.encode_decode(docs, default_vocabulary(), result=bpe.DIGESTS)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact),
    ("near_dedup", drop_near),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: Classifier, flow and byte-pair encoding have no SQL form; tests compare the
#: stages with plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    folder = os.path.join(shared_dir(spark), f"corpus-pipeline-{uuid.uuid4().hex}")
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
