"""Collocations: phrases whose words occur together more than their parts do.

Phrases are counted in counting quotient filters. Words get dense ids, the ids
of a phrase are packed into one integer of ``3 * bits`` bits and an invertible
permutation spreads these integers evenly. The high bits of the result are the
quotient, which a filter holds implicitly by position; only the remainder is
stored, with a counter of one byte that grows where needed. Nothing is lost:
quotient and remainder give the phrase back. Each task sorts its phrases into
filters, one for each range of quotients; the filters of a range meet in one
task, which merges them in order and adds their counters. The permutation makes
ranges equally large however uneven the phrases are, and a frequent phrase has
one entry a filter, so there is no hot range. The number of ranges grows with
the number of words.

Only words that occur ``min_count`` times can be part of a phrase that does, so
only these get ids: the most frequent ones, at most ``MOST_WORDS`` of at most
``LONGEST_WORD`` bytes (a bound for what is broadcast). Phrases with one of the
others are counted by Spark as text; a Bloom filter of fixed size tells those
words from the rare ones, so that phrases of rare words are not moved.
"""

from __future__ import annotations

import struct
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from facets.llm.common import materialize, mix64, text_chunks, word_hashes, word_spans

#: Words with an id: at most so many, none with more bytes.
MOST_WORDS = (1 << 20) - 1
LONGEST_WORD = 48
#: Phrases that a task counts at once; entries of a filter range, about.
FLUSH = 3_000_000
RANGE = 2_000_000
#: Bits of the Bloom filter of frequent words without an id, and bits set for each word.
BLOOM_BITS, BLOOM_HASHES = 1 << 25, 4
#: Slices in which a language's phrases are ranked first.
SLICES = 64
CHUNK = 1 << 21

_BREAK = np.zeros(256, bool)
_BREAK[list(b" \t.,;:!?\n\x0b\x0c\r")] = True
_PIECE_END = np.zeros(256, bool)
_PIECE_END[list(b".,;:!?\n\x0b\x0c\r")] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# --- words -------------------------------------------------------------------------------

@dataclass
class ChunkWords:
    """Words of some texts: the distinct ones, and for each word in order its
    number among them, its language and the piece it is in."""

    langs: pa.Array
    words: pa.Array
    lang: np.ndarray
    word: np.ndarray
    piece: np.ndarray


def chunk_words(data: np.ndarray, offs: np.ndarray, langs: pa.Array) -> ChunkWords:
    starts, ends, row = word_spans(data, offs, _BREAK)
    lengths = np.concatenate(([0], np.cumsum(ends - starts)))
    packed = np.ascontiguousarray(_LOWER[data[~_BREAK[data]]])
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(lengths.astype(np.int64)), pa.py_buffer(packed)])
    coded = words.dictionary_encode()
    named = langs.cast(pa.large_string()).dictionary_encode()
    # a piece is told by its text and the number of piece ends before it
    piece = np.cumsum(_PIECE_END[data], dtype=np.int64)[starts] + row if len(starts) else row
    return ChunkWords(named.dictionary, coded.dictionary, named.indices.to_numpy(zero_copy_only=False)[row],
                      coded.indices.to_numpy(zero_copy_only=False), piece)


def combinations(c: ChunkWords) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (language, word) numbers as ``language * words + word``, how
    often each occurs, and for each word the place of its combination."""
    both = c.lang.astype(np.int64) * len(c.words) + c.word
    span = len(c.langs) * len(c.words)
    if span <= 8 * len(both):
        counts = np.bincount(both, minlength=span)
        found = np.flatnonzero(counts)
        place = np.zeros(span, np.int64)
        place[found] = np.arange(len(found))
        return found, counts[found], place[both]
    found, place, counts = np.unique(both, return_inverse=True, return_counts=True)
    return found, counts, place


def _word_counts():
    """(lang, word, f) of each task's texts, and (lang, null, number of words)."""

    names = ["lang", "word", "f"]

    def summed(parts: list[pa.Table]) -> pa.RecordBatch:
        t = pa.concat_tables(parts).group_by(["lang", "word"]).aggregate([("f", "sum")])
        return pa.RecordBatch.from_arrays([t["lang"].combine_chunks().cast(pa.string()),
                                           t["word"].combine_chunks().view(pa.large_string()).cast(pa.string()), t["f_sum"].combine_chunks()], names=names)

    def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for at in range(0, batch.num_rows, 1 << 16):
            yield batch.slice(at, 1 << 16)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for first, data, offs in text_chunks(batch.column(1), CHUNK):
                c = chunk_words(data, offs, batch.column(0).slice(first, len(offs) - 1))
                found, counts, _ = combinations(c)
                lang, word = np.divmod(found, max(len(c.words), 1))
                totals = np.bincount(c.lang, minlength=len(c.langs))
                parts.append(pa.table([c.langs.take(pa.array(lang)), c.words.take(pa.array(word)), pa.array(counts.astype(np.int64))], names=names))
                parts.append(pa.table([c.langs, pa.nulls(len(c.langs), pa.large_binary()), pa.array(totals.astype(np.int64))], names=names))
                held += len(found)
                if held >= 500_000:
                    yield from slices(summed(parts))
                    parts, held = [], 0
        if parts:
            yield from slices(summed(parts))
        pa.default_memory_pool().release_unused()  # a worker lives on after its task

    return run


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, f) of ``docs`` (lang, text); the row without a word has the
    number of all words of its language."""
    return (docs.mapInArrow(_word_counts(), "lang string, word string, f long")
            .groupBy("lang", "word").agg(F.sum("f").alias("f")))


# --- word ids ----------------------------------------------------------------------------

def _keys(langs: pa.Array, words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each (language, word)."""

    def hashes(texts: pa.Array) -> np.ndarray:
        texts = texts.cast(pa.large_binary())
        n = len(texts)
        offs = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1] if n else np.zeros(1, np.int64)
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[offs[0]:offs[-1]] if raw is not None and raw.size else np.zeros(0, np.uint8)
        out = np.empty(n, np.uint64)
        at = 0
        while at < n:  # hashing works on runs of bounded size
            end = min(max(at + 1, int(np.searchsorted(offs, offs[at] + CHUNK, "right")) - 1), n)
            part = offs[at:end + 1] - offs[at]
            out[at:end] = word_hashes(data[offs[at] - offs[0]:offs[end] - offs[0]], part[:-1], part[1:], lower=False)
            at = end
        return out

    named = langs.cast(pa.large_string()).dictionary_encode()
    of_lang = hashes(named.dictionary)[named.indices.to_numpy(zero_copy_only=False)] if len(langs) else np.zeros(0, np.uint64)
    return mix64(of_lang * np.uint64(0xA0761D6478BD642F) + hashes(words))


def _bloom_places(keys: np.ndarray) -> np.ndarray:
    steps = [np.uint64((j + 1) * 0x9E3779B97F4A7C15 % (1 << 64)) for j in range(BLOOM_HASHES)]
    return np.stack([mix64(keys + step) % np.uint64(BLOOM_BITS) for step in steps])


@dataclass
class Dictionary:
    """Ids (from 1) of frequent words, in the order of their hashes; the words
    themselves, by which a look-up is checked; and the other frequent words as
    a Bloom filter."""

    keys: np.ndarray
    langs: pa.Array
    words: pa.Array
    counts: np.ndarray
    bloom: np.ndarray

    @property
    def bits(self) -> int:
        return max(1, int(len(self.keys)).bit_length())

    def ids(self, langs: pa.Array, words: pa.Array) -> np.ndarray:
        """The id of each word, -1 for a word that may be frequent but has
        none, 0 for a rare word."""
        keys = _keys(langs, words)
        out = np.zeros(len(keys), np.int64)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            hit = np.flatnonzero(self.keys[at] == keys)
            where = pa.array(at[hit])
            same = pc.and_(pc.equal(self.words.take(where), words.take(pa.array(hit))),
                           pc.equal(self.langs.take(where), langs.take(pa.array(hit))))
            hit = hit[same.to_numpy(zero_copy_only=False).astype(bool)]
            out[hit] = at[hit] + 1
        rest = np.flatnonzero(out == 0)
        if len(self.bloom) and len(rest):
            places = _bloom_places(keys[rest])
            maybe = np.ones(len(rest), bool)
            for p in places:
                maybe &= (self.bloom[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63))) & np.uint64(1) == 1
            out[rest[maybe]] = -1
        return out


def _bloom_bits():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = _bloom_places(_keys(batch.column(0), batch.column(1))).ravel()
            masks = (np.uint64(1) << (p & np.uint64(63))).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((p >> np.uint64(6)).astype(np.int64)), pa.array(masks)], names=["slot", "mask"])

    return run


def word_ids(frequent: DataFrame, most: int = MOST_WORDS, longest: int = LONGEST_WORD) -> Dictionary:
    """Ids for the most frequent rows of (lang, word, f), as many as ``most``
    allows. The cut is a count that a histogram of counts gives, so no task
    sorts the words; all others go into the Bloom filter."""
    level = F.floor(F.log2("f") * 8).cast("int")
    short = (F.octet_length("word") <= longest) & (F.octet_length("lang") <= longest)
    rows = frequent.withColumn("level", level).withColumn("short", short)
    room, cut = most, None
    for r in sorted(rows.where("short").groupBy("level").count().collect(), key=lambda r: -r["level"]):
        if r["count"] > room:
            break
        room, cut = room - r["count"], r["level"]
    own = F.col("short") & (F.col("level") >= F.lit(cut if cut is not None else 1 << 30))
    t = rows.where(own).select("lang", "word", "f").toArrow()
    langs = t["lang"].cast(pa.large_string()).combine_chunks()
    words = t["word"].cast(pa.large_string()).combine_chunks().view(pa.large_binary())
    counts = t["f"].to_numpy()
    keys = _keys(langs, words)
    order = np.argsort(keys)
    keys = keys[order]
    twin = np.zeros(len(keys), bool)  # words of equal hash have no id
    twin[1:] |= keys[1:] == keys[:-1]
    twin[:-1] |= keys[1:] == keys[:-1]

    bloom = np.zeros(BLOOM_BITS // 64, np.uint64)
    other = rows.where(~own).select("lang", "word").mapInArrow(_bloom_bits(), "slot long, mask long")
    slots = other.groupBy("slot").agg(F.bit_or("mask").alias("mask")).toArrow()
    if slots.num_rows or twin.any():
        bloom[slots["slot"].to_numpy()] = slots["mask"].to_numpy().view(np.uint64)
        for p in _bloom_places(keys[twin]).ravel().tolist():
            bloom[p >> 6] |= np.uint64(1 << (p & 63))
    else:
        bloom = np.zeros(0, np.uint64)
    kept = pa.array(order[~twin])
    return Dictionary(keys[~twin], langs.take(kept), words.take(kept), counts[order[~twin]], bloom)


# --- counting quotient filters -----------------------------------------------------------------

_ODD = 0xD1342543DE82EF95


def permute(x: np.ndarray, width: int, back: bool = False) -> np.ndarray:
    """An invertible permutation of the integers of ``width`` bits."""
    mask, s = np.uint64((1 << width) - 1), np.uint64((width + 1) // 2)
    factor = np.uint64(pow(_ODD, -1, 1 << 64) if back else _ODD) & mask
    for _ in range(3):
        if back:
            x = x ^ (x >> s)  # undoes itself, as s is half the width or more
            x = (x * factor) & mask
        else:
            x = (x * factor) & mask
            x = x ^ (x >> s)
    return x


def filter_of(values: np.ndarray, counts: np.ndarray, rest: int) -> bytes:
    """A filter of ascending distinct ``values`` of ``rest`` bits and their
    counters: for each quotient a one for each of its entries and a zero, the
    remainders in whole bytes, the counters in a byte each, or eight more."""
    n = len(values)
    whole = max(0, -(-(rest - max(n, 1).bit_length()) // 8))
    low = min(8 * whole, rest)
    quotients = 1 << (rest - low)
    slots = np.zeros(n + quotients, np.uint8)
    slots[np.arange(n) + (values >> np.uint64(low)).astype(np.int64)] = 1
    remainders = (values & np.uint64((1 << low) - 1)).astype("<u8").view(np.uint8).reshape(n, 8)[:, :whole]
    large = counts[counts >= 255].astype("<i8")
    return (struct.pack("<qbbq", n, low, whole, len(large)) + np.packbits(slots).tobytes() + remainders.tobytes()
            + np.minimum(counts, 255).astype(np.uint8).tobytes() + large.tobytes())


def entries(filter_: bytes, rest: int) -> tuple[np.ndarray, np.ndarray]:
    """The values and counters of a filter, ascending."""
    n, low, whole, large = struct.unpack_from("<qbbq", filter_)
    at = struct.calcsize("<qbbq")
    size = n + (1 << (rest - low))
    slots = np.unpackbits(np.frombuffer(filter_, np.uint8, -(-size // 8), at), count=size)
    at += -(-size // 8)
    quotients = (np.flatnonzero(slots) - np.arange(n)).astype(np.uint64)
    remainders = np.zeros((n, 8), np.uint8)
    remainders[:, :whole] = np.frombuffer(filter_, np.uint8, n * whole, at).reshape(n, whole)
    at += n * whole
    counts = np.frombuffer(filter_, np.uint8, n, at).astype(np.int64)
    counts[counts == 255] = np.frombuffer(filter_, "<i8", large, at + n)
    return (quotients << np.uint64(low)) | remainders.reshape(-1).view("<u8").astype(np.uint64), counts


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """One ascending run of values from several, their counters added."""
    values = np.concatenate([p[0] for p in parts])
    counts = np.concatenate([p[1] for p in parts])
    order = np.argsort(values, kind="stable")  # merges the runs
    values, counts = values[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.zeros(0, np.int64)
    return values[first], np.add.reduceat(counts, first) if len(first) else counts


def _phrase_filters(shared, ranges: int):
    """Filters of each task's phrases, (part, filter), and beside them the
    phrases that hold a word without an id, (part, lang, words, a), where part
    is negative and only spreads them."""
    high = (ranges - 1).bit_length()
    names = ["part", "filter", "lang", "words", "a"]

    def flushed(parts: list[np.ndarray], width: int) -> Iterator[pa.RecordBatch]:
        values = np.sort(permute(np.concatenate(parts), width))
        first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
        counts = np.diff(np.concatenate((first, [len(values)])))
        values = values[first]
        rest = width - high
        bounds = np.searchsorted(values, np.arange(ranges + 1, dtype=np.uint64) << np.uint64(rest)) if high else np.array([0, len(values)])
        bounds[-1] = len(values)
        low = np.uint64((1 << rest) - 1)
        part, made, size = [], [], 0
        for r in np.flatnonzero(np.diff(bounds)):
            one = slice(bounds[r], bounds[r + 1])
            part.append(int(r))
            made.append(filter_of(values[one] & low, counts[one], rest))
            size += len(made[-1])
            if size >= 1 << 22:
                yield rows(part, made)
                part, made, size = [], [], 0
        if part:
            yield rows(part, made)

    def rows(part: list[int], made: list[bytes]) -> pa.RecordBatch:
        n = len(part)
        return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(made, pa.binary()), pa.nulls(n, pa.string()),
                                           pa.nulls(n, pa.list_(pa.string())), pa.nulls(n, pa.int64())], names=names)

    def texts(found: Counter) -> pa.RecordBatch:
        n = len(found)
        return pa.RecordBatch.from_arrays([pa.array(-1 - np.arange(n, dtype=np.int32) % ranges), pa.nulls(n, pa.binary()),
                                           pa.array([k[0] for k in found], pa.string()),
                                           pa.array([list(k[1:]) for k in found], pa.list_(pa.string())),
                                           pa.array(list(found.values()), pa.int64())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d: Dictionary = shared.value
        bits, width = d.bits, max(3 * d.bits, high)
        parts, held = [], 0
        for batch in batches:
            for first, data, offs in text_chunks(batch.column(1), CHUNK):
                c = chunk_words(data, offs, batch.column(0).slice(first, len(offs) - 1))
                if len(c.word) < 2:
                    continue
                found, _, place = combinations(c)
                lang, word = np.divmod(found, len(c.words))
                ids = d.ids(c.langs.take(pa.array(lang)), c.words.take(pa.array(word)))[place]
                together = c.piece[1:] == c.piece[:-1]
                pair = together & (ids[1:] != 0) & (ids[:-1] != 0)
                triple = pair[1:] & pair[:-1]
                with_id = ids > 0
                p = np.flatnonzero(pair & with_id[1:] & with_id[:-1])
                t = np.flatnonzero(triple & with_id[2:] & with_id[1:-1] & with_id[:-2])
                u = ids.astype(np.uint64)
                b = np.uint64(bits)
                for keys in ((u[p] << (b + b)) | (u[p + 1] << b), (u[t] << (b + b)) | (u[t + 1] << b) | u[t + 2]):
                    if len(keys):
                        parts.append(keys)
                        held += len(keys)
                other = Counter()
                for n, at in ((2, np.flatnonzero(pair & ~(with_id[1:] & with_id[:-1]))),
                              (3, np.flatnonzero(triple & ~(with_id[2:] & with_id[1:-1] & with_id[:-2])))):
                    for i in at.tolist():
                        other[(c.langs[int(c.lang[i])].as_py(), *(c.words[int(c.word[i + j])].as_py().decode() for j in range(n)))] += 1
                if other:
                    yield texts(other)
                if held >= FLUSH:
                    yield from flushed(parts, width)
                    parts, held = [], 0
        if parts:
            yield from flushed(parts, width)
        pa.default_memory_pool().release_unused()

    return run


def _merge_filters(shared, ranges: int, min_count: int):
    """(lang, words, a, f) of the phrases that occur ``min_count`` times, from
    rows sorted by part; rows with a phrase as text pass, without ``f``."""
    high = (ranges - 1).bit_length()
    names = ["lang", "words", "a", "f"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d: Dictionary = shared.value
        width = max(3 * d.bits, high)
        rest = width - high

        def phrases(part: int, parts) -> Iterator[pa.RecordBatch]:
            values, counts = merged(parts)
            keep = counts >= min_count
            values = permute(values[keep] | np.uint64(part << rest), width, back=True)
            mask = np.uint64((1 << d.bits) - 1)
            ids = [((values >> np.uint64(s * d.bits)) & mask).astype(np.int64) for s in (2, 1, 0)]
            counts = counts[keep]
            for at in range(0, len(values), 1 << 16):
                i = [x[at:at + (1 << 16)] for x in ids]
                n = len(i[0])
                three = i[2] > 0
                flat = np.stack(i, 1).ravel()
                offsets = np.concatenate(([0], np.cumsum(2 + three))).astype(np.int32)
                flat = flat[flat > 0] - 1
                words = pa.ListArray.from_arrays(offsets, d.words.take(pa.array(flat)).view(pa.large_string()).cast(pa.string()))
                parts_f = pa.ListArray.from_arrays(offsets, pa.array(d.counts[flat]))
                yield pa.RecordBatch.from_arrays([d.langs.take(pa.array(i[0] - 1)).cast(pa.string()), words,
                                                  pa.array(counts[at:at + n]), parts_f], names=names)

        now, parts, held = None, [], 0
        for batch in batches:
            text = batch.filter(pc.is_valid(batch.column(3)))
            if text.num_rows:
                yield pa.RecordBatch.from_arrays([*text.columns[2:], pa.nulls(text.num_rows, pa.list_(pa.int64()))], names=names)
            for part, one in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if part < 0:
                    continue
                if part != now:
                    if parts:
                        yield from phrases(now, parts)
                    now, parts, held = part, [], 0
                parts.append(entries(one.as_py(), rest))
                held += len(parts[-1][0])
                if held >= RANGE:
                    parts = [merged(parts)]
                    held = len(parts[0][0]) // 2  # merge again when it has doubled
        if parts:
            yield from phrases(now, parts)

    return run


# --- collocations -------------------------------------------------------------------------------

def phrase_counts(docs: DataFrame, frequent: DataFrame, n_words: int, min_count: int, ids: Dictionary) -> DataFrame:
    """(lang, words, a, f): phrases of two or three words in (lang, text) that
    occur ``min_count`` times, and the counts of their words."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(ids)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = 1 << (max(2 * partitions, 2 * n_words // RANGE, 1) - 1).bit_length()
    rows = docs.mapInArrow(_phrase_filters(shared, ranges), "part int, filter binary, lang string, words array<string>, a long")
    merged_rows = materialize(rows.repartition(partitions, "part").sortWithinPartitions("part").mapInArrow(
        _merge_filters(shared, ranges, min_count), "lang string, words array<string>, a long, f array<long>"))
    other = (merged_rows.where("f is null").groupBy("lang", "words").agg(F.sum("a").alias("a")).where(F.col("a") >= min_count))
    for i in range(3):
        of_word = frequent.select(F.col("lang").alias("_lang"), F.col("word").alias("_word"), F.col("f").alias(f"f{i}"))
        other = other.join(of_word, (F.col("lang") == F.col("_lang")) & (F.get("words", F.lit(i)) == F.col("_word")), "left").drop("_lang", "_word")
    return (merged_rows.where("f is not null")
            .union(other.select("lang", "words", "a", F.array_compact(F.array("f0", "f1", "f2")).alias("f"))))


def _score(left: str, right: str) -> str:
    """floor(1000000 * a * a / (left * right)), whole numbers of up to 38 digits."""
    whole = "cast({} as decimal(20,0))".format
    return f"(cast({whole('a')} * {whole('a')} * 1000000 as decimal(38,0))) div cast({whole(left)} * {whole(right)} as decimal(38,0))"


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", min_count: int = 10, covered: int = 50,
                 most: int = 2000, most_words: int = MOST_WORDS, longest_word: int = LONGEST_WORD) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``most`` best phrases of
    each language.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends
    and these into words at blanks and tabs. ``n`` is the language's number of
    words. A phrase of two or three words that occurs ``a`` >= ``min_count``
    times is cut where floor(1000000 * a * a / (l * r)) is least, the first of
    equal cuts; ``l`` and ``r`` are the counts of its two parts. A phrase in a
    longer one with 100 * a(longer) >= ``covered`` * a is left out. Order:
    score and a falling, then the phrase by its UTF-8 bytes.

    A null language is ``und``, a null text an empty one. Repeated rows count
    each time; other columns are ignored; an empty table, and texts without
    frequent phrases, give no rows.
    """
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    counts = materialize(word_counts(texts).where(F.col("word").isNull() | (F.col("f") >= min_count)))
    totals = counts.where("word is null").select("lang", F.col("f").alias("n"))
    frequent = counts.where("word is not null")
    n_words = totals.agg(F.sum("n")).first()[0] or 0
    ids = word_ids(frequent, most_words, longest_word)
    found = phrase_counts(texts, frequent, n_words, min_count, ids).withColumn("phrase", F.array_join("words", " "))

    pairs = found.where(F.size("words") == 2).select("lang", "phrase", "a", F.expr("f[0]").alias("l"), F.expr("f[1]").alias("r"))
    two = pairs.select("lang", F.col("phrase").alias("part"), F.col("a").alias("part_a"))
    triples = found.where(F.size("words") == 3)
    first, last = F.array_join(F.slice("words", 1, 2), " "), F.array_join(F.slice("words", 2, 2), " ")
    cuts = (triples.select("lang", "phrase", "a", F.inline(F.array(
                F.struct(F.lit(1).alias("k"), last.alias("part"), F.expr("f[0]").alias("word_f")),
                F.struct(F.lit(2).alias("k"), first.alias("part"), F.expr("f[2]").alias("word_f")))))
            .join(two, ["lang", "part"]))
    cuts = materialize(cuts.select("lang", "phrase", "a", "k", "part", "part_a",
                                   F.expr("if(k = 1, word_f, part_a)").alias("l"), F.expr("if(k = 1, part_a, word_f)").alias("r")))
    inside = cuts.where(100 * F.col("a") >= covered * F.col("part_a")).select("lang", F.col("part").alias("phrase")).distinct()
    best = (cuts.withColumn("score", F.expr(_score("l", "r"))).groupBy("lang", "phrase")
            .agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("best")).select("lang", "phrase", "best.a", "best.l", "best.r", "best.score"))
    all_ = pairs.join(inside, ["lang", "phrase"], "left_anti").withColumn("score", F.expr(_score("l", "r"))).unionByName(best)

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SLICES))).orderBy(*order)
    few = all_.withColumn("nth", F.row_number().over(part)).where(F.col("nth") <= most).drop("nth")
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= most)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), p AS (SELECT id, lang, regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]') AS pieces FROM d
), q AS (SELECT id, lang, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS nth FROM p
), v AS (SELECT id, lang, nth, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS words FROM q
), w AS (SELECT id, lang, nth, unnest(words) AS w1, generate_subscripts(words, 1) AS pos FROM v
), x AS (
  SELECT lang, w1, lead(w1) OVER o AS w2, lead(w1, 2) OVER o AS w3 FROM w WINDOW o AS (PARTITION BY id, nth ORDER BY pos)
), f1 AS (SELECT lang, w1, count(*) AS f FROM x GROUP BY ALL
), f2 AS (SELECT lang, w1, w2, count(*) AS f FROM x WHERE w2 IS NOT NULL GROUP BY ALL
), f3 AS (SELECT lang, w1, w2, w3, count(*) AS f FROM x WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10
), c AS (
  SELECT f2.lang, f2.w1 || ' ' || f2.w2 AS phrase, 1 AS k, f2.f AS a, p.f AS l, q.f AS r
  FROM f2 JOIN f1 p ON p.lang = f2.lang AND p.w1 = f2.w1 JOIN f1 q ON q.lang = f2.lang AND q.w1 = f2.w2
  WHERE f2.f >= 10 AND NOT EXISTS (SELECT 1 FROM f3 WHERE f3.lang = f2.lang AND 100 * f3.f >= 50 * f2.f
    AND f3.w1 = f2.w1 AND f3.w2 = f2.w2)
  AND NOT EXISTS (SELECT 1 FROM f3 WHERE f3.lang = f2.lang AND 100 * f3.f >= 50 * f2.f AND f3.w2 = f2.w1 AND f3.w3 = f2.w2)
  UNION ALL
  SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, 1, f3.f, p.f, q.f
  FROM f3 JOIN f1 p ON p.lang = f3.lang AND p.w1 = f3.w1 JOIN f2 q ON q.lang = f3.lang AND q.w1 = f3.w2 AND q.w2 = f3.w3
  UNION ALL
  SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, 2, f3.f, q.f, p.f
  FROM f3 JOIN f1 p ON p.lang = f3.lang AND p.w1 = f3.w3 JOIN f2 q ON q.lang = f3.lang AND q.w1 = f3.w1 AND q.w2 = f3.w2
), s AS (SELECT *, CAST((CAST(a AS HUGEINT) * a * 1000000) // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM c
), b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS cut FROM s
), t AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS "rank" FROM b WHERE cut = 1
), n AS (SELECT lang, count(*) AS n FROM w GROUP BY lang)
SELECT t.lang, t."rank", t.phrase, t.a, t.l, t.r, n.n, t.score FROM t JOIN n ON n.lang = t.lang WHERE t."rank" <= 2000
"""
