"""A filter of bits as a small table, so that the test stays a join in the JVM.

``bit_words`` folds hashes into at most ``WORDS`` rows of 64 bits, whatever the
number of hashes: that is the bound of what is broadcast (2**20 rows of two
longs, about 40 MB in memory). ``with_bit`` keeps the rows whose hash has its
bit set. Hashes that share a bit let a few rows too many through, never one too
few; a full filter lets all through, and what follows must count exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 1 << 20


def key_hash(keys: Sequence[str], bits: int = 64) -> Column:
    """The top ``bits`` bits of the keys' hash; NULL is a value like others."""
    h = F.xxhash64(*keys)
    return h if bits == 64 else F.shiftrightunsigned(h, 64 - bits)


def _word_and_bit(h: Column, words: int) -> tuple[Column, Column]:
    spread = F.xxhash64(h, F.lit(64))
    return F.pmod(F.shiftrightunsigned(spread, 6), F.lit(words)), F.pmod(spread, F.lit(64)).cast("int")


def bit_words(hashes: DataFrame, column: str, words: int = WORDS) -> DataFrame:
    """(word, mask): at most ``words`` rows, one bit set for each hash."""
    word, bit = _word_and_bit(F.col(column), words)
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    return hashes.select(word.alias("word"), one.alias("mask")).groupBy("word").agg(F.bit_or("mask").alias("mask"))


def _marked(df: DataFrame, h: Column, filter_: DataFrame, words: int) -> tuple[DataFrame, Column]:
    word, bit = _word_and_bit(h, words)
    rows = df.withColumn("_word", word).withColumn("_bit", bit)
    rows = rows.join(F.broadcast(filter_.select(F.col("word").alias("_word"), F.col("mask").alias("_mask"))), "_word", "left")
    return rows, F.coalesce(F.call_function("shiftrightunsigned", F.col("_mask"), F.col("_bit")).bitwiseAND(F.lit(1).cast("long")) == 1, F.lit(False))


def with_bit(df: DataFrame, h: Column, filter_: DataFrame, words: int = WORDS) -> DataFrame:
    """Rows of ``df`` whose hash ``h`` has its bit set; no shuffle of ``df``."""
    rows, is_set = _marked(df, h, filter_, words)
    return rows.where(is_set).select(*df.columns)


def without_bit(df: DataFrame, h: Column, filter_: DataFrame, words: int = WORDS) -> DataFrame:
    """The other rows."""
    rows, is_set = _marked(df, h, filter_, words)
    return rows.where(~is_set).select(*df.columns)
