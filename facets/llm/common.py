"""Shared helpers of the ``llm`` operators: column handling, staged tables and
vectorised hashing of words and word shingles.

The hashing works on the raw UTF-8 bytes of an Arrow text column with numpy,
a few MB at a time, so a task's memory does not depend on the batch that Spark
hands it, and a very long text is processed whole.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from facets.sources.parquet import materialize, read_table


#: White space between words, as in the regular expression class [\x20\x09-\x0D].
SPACES = bytes([0x20, *range(0x09, 0x0E)])
WORD = "[^\\x20\\x09-\\x0D]+"
#: Bytes of text hashed at once (a longer text is a chunk of its own).
CHUNK_BYTES = 1 << 20

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_P = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_P_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


_shipped: set[str] = set()


#: Bytes of an Arrow batch that Spark hands to a task, in place of its default of 64 MB.
BATCH_BYTES = "8m"


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once per Spark
    application, as ``--py-files`` would: Spark serves the archive to them.
    Batches of text are also kept small (unless the session has a limit of its
    own): they are held outside the heap, by the JVM and by each worker."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "67108864b":
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="facets-ship-"), "facets_package.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def in_fold(id_col: str, folds: int, fold: int) -> Column:
    """True where crc32 of the id's decimal text modulo ``folds`` is ``fold``."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(kind: str, n: int) -> np.ndarray:
    have = _powers[kind]
    if len(have) < n:
        base = np.full(max(n, CHUNK_BYTES + 1), _P if kind == "up" else _P_INV)
        base[0] = 1
        have = _powers[kind] = np.cumprod(base, dtype=np.uint64)
    return have[:n]


def is_space(data: np.ndarray) -> np.ndarray:
    return _IS_SPACE[data]


def spare_name(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def first_by_hash(rows: DataFrame, n: int, hashed: Column, *order: str) -> DataFrame:
    """The first ``n`` rows by ``hashed`` (evenly spread whole numbers of 64
    bits), then by ``order``. Tasks hand on only what lies under a threshold
    that leaves about 2 n rows of the whole table, not n rows each."""
    total = rows.count()
    if total > 4 * n:
        rows = rows.where(hashed < F.lit(min((1 << 64) * 2 * n // total, (1 << 64) - 1) - (1 << 63)))
    return rows.orderBy(hashed, *order).limit(n)


#: A key is hot if it has more than one in HOT of all rows, so there are at most as many hot keys.
HOT, SALTS = 4096, 32


def hot_keys(counted: DataFrame, key: str, count: str, total: int) -> list:
    """The hot keys of ``counted``, a table with the number of rows of each
    key; keys of up to a hundred rows are not. At most HOT values."""
    return [r[0] for r in counted.where((F.col(count) > 100) & (F.col(count) * HOT > total)).select(key).collect()]


def hot_join(many: DataFrame, few: DataFrame, key: str, hot: list) -> DataFrame:
    """``many`` joined with ``few`` (one row a key). Rows of the keys in ``hot``
    are dealt over several tasks, each of which gets the key's row of ``few``."""
    if not hot:
        return many.join(few, key)
    is_hot = F.col(key).isin(hot)
    left = many.withColumn("_salt", F.when(is_hot, F.pmod(F.xxhash64(*many.columns), F.lit(SALTS)).cast("int")).otherwise(0))
    right = few.withColumn("_salt", F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))))
    return left.join(right, [key, "_salt"]).drop("_salt")


def text_chunks(texts: pa.Array, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows of about ``chunk_bytes``.
    A null text is an empty one. Offsets start at 0 and have one entry more than rows."""
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if not n:
        return
    _, off, data = texts.buffers()
    offs = np.frombuffer(off, np.int64)[texts.offset:texts.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offs, offs[first] + chunk_bytes, "right")) - 1)
        last = min(last, n)
        yield first, raw[offs[first]:offs[last]], offs[first:last + 1] - offs[first]
        first = last


def word_spans(data: np.ndarray, offs: np.ndarray,
               breaks: np.ndarray = _IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the row it belongs to. ``breaks``
    tells for each byte value whether it separates words."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    word = ~breaks[data]
    edge = np.zeros(n + 1, bool)  # a text starts here
    edge[offs] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = word[:-1]
    starts = np.flatnonzero(word & (~before | edge[:n]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = word[1:]
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offs, starts, "right") - 1


def lowered(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with A-Z and the capitals U+00C0 to U+00DE lower-cased."""
    out = _LOWER[data]
    if len(out) > 1:
        latin = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        out[1:][latin] += 0x20
    return out


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hash of each word's bytes (A-Z lower-cased): a polynomial over
    the bytes taken from prefix sums, then mixed."""
    b = (_LOWER[data] if lower else data).astype(np.uint64) + np.uint64(1)
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(b * _power("up", len(b)), out=sums[1:])
    return mix64((sums[ends] - sums[starts]) * _power("down", len(b) + 1)[starts])


def shingles(data: np.ndarray, offs: np.ndarray, width: int, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Distinct word-shingle hashes of each row, ascending within the row, and
    their row boundaries (rows + 1 entries).

    A row with fewer than ``width`` words has one shingle, its whole word
    sequence; a row without words has none."""
    rows = len(offs) - 1
    starts, ends, row = word_spans(data, offs)
    n_words = np.bincount(row, minlength=rows) if len(row) else np.zeros(rows, np.int64)
    w = word_hashes(data, starts, ends, lower)
    n_sh = np.where(n_words >= width, n_words - width + 1, np.minimum(n_words, 1))
    first_word = np.concatenate(([0], np.cumsum(n_words)))
    bounds = np.concatenate(([0], np.cumsum(n_sh)))
    total = int(bounds[-1])
    owner = np.repeat(np.arange(rows), n_sh)
    at = np.arange(total) - bounds[owner] + first_word[owner]
    length = np.minimum(n_words[owner], width)
    h = length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for j in range(width):
        multiplier = np.uint64(pow(0xA0761D6478BD642F, j + 1, 1 << 64) | 1)
        inside = j < length
        h += np.where(inside, w[np.minimum(at + j, max(len(w) - 1, 0))] if len(w) else 0, np.uint64(0)) * multiplier
    h = mix64(h)
    for r in np.flatnonzero(n_sh > 1):
        h[bounds[r]:bounds[r + 1]].sort()
    if not total:
        return h, bounds
    keep = np.ones(total, bool)
    keep[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    kept = np.bincount(owner[keep], minlength=rows)
    return h[keep], np.concatenate(([0], np.cumsum(kept)))
