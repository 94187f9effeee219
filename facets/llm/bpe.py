"""Exact byte-pair encoding by dynamic programming over prefixes.

For every prefix of a word there is one encoding, so it is enough to store its
last token. The tokens that end at a position come from one run of an
Aho-Corasick automaton over the vocabulary; of these, the last token is the
one that is compatible with the stored last token of the prefix before it, or
that covers the whole prefix. Following the stored tokens back from the end
gives the ids. Words repeat, so each task keeps the ids of words it has seen in
a table of bounded size.

The vocabulary is read on the driver from a ``tokenizers`` JSON file, whose
path is a parameter, and shipped to the tasks.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words (and pairs of tokens) that a task remembers; a table starts anew beyond that.
REMEMBERED = 300_000
#: Characters of text after which a task hands over its rows.
BATCH_CHARS = 1 << 19

NEVER = 1 << 60


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level
    vocabularies: itself if it is printable, else the next one from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """A byte-level BPE vocabulary with an end-of-word suffix, as told by the
    file: NFC, white space and lower-case normaliser, one splitting pattern, no
    decoder. Another kind of file is refused."""

    def __init__(self, spec: dict):
        model = spec["model"]
        steps = [x["type"] for x in spec["normalizer"]["normalizers"]]
        split = spec["pre_tokenizer"]["pretokenizers"]
        if (model["type"], steps, [x["type"] for x in split], spec["decoder"], spec["post_processor"]) != (
                "BPE", ["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"], None, None) or not split[0]["invert"]:
            raise ValueError("this kind of tokenizer file is not supported")
        suffix = model["end_of_word_suffix"]
        self.texts: dict[int, str] = {i: t for t, i in model["vocab"].items()}
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.texts.update({i: t for t, i in self.special.items()})
        self.pattern = regex.compile(split[0]["pattern"]["Regex"].replace("\\s", "\\p{White_Space}"))
        self.cut = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None

        # A word is a string of symbols: U+0000.. for its bytes, U+0100.. for its last byte.
        byte_of = {c: b for b, c in enumerate(_byte_symbols())}

        def symbols(token: str) -> str:
            last = token.endswith(suffix) and len(token) > len(suffix)
            own = [byte_of[c] for c in (token[:-len(suffix)] if last else token)]
            return "".join(map(chr, own[:-1])) + chr(own[-1] + 256 * last)

        vocab = model["vocab"]
        self.rank: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], int] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            whole = vocab[left + right]
            a, b = vocab[left], vocab[right]
            self.joined.setdefault((a, b), rank)
            if whole not in self.parts:
                self.parts[whole], self.rank[whole] = (a, b), rank
        self.found = ahocorasick.Automaton()
        for token, i in vocab.items():
            word = symbols(token)
            if len(word) == 1 or i in self.parts:
                self.found.add_word(word, (i, len(word)))
        self.found.make_automaton()
        self._right: dict[int, list[tuple[int, int]]] = {}
        self._left: dict[int, list[tuple[int, int]]] = {}
        self._fits: dict[tuple[int, int], bool] = {}
        self._whole: dict[int, bool] = {}
        self.words: dict[str, tuple[int, ...]] = {}

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The pieces at one edge of a token while it is merged, first the
        single symbol: (piece, rank of the merge that ends it)."""
        held = self._left if side == 0 else self._right
        if token not in held:
            pieces, piece, until = [], token, NEVER
            while True:
                pieces.append((piece, until))
                if piece not in self.parts:
                    break
                until, piece = self.rank[piece], self.parts[piece][side]
            held[token] = pieces[::-1]
        return held[token]

    def _apart(self, left: int, right: int, before: int) -> bool:
        """No merge of a rank under ``before`` joins the two tokens' symbols
        across the border between them while both are built up.

        Merges happen in the order of rank, and a piece is only merged after it
        was made, so at each rank one pair of pieces faces each other. Of equal
        ranks the leftmost merge comes first.
        """
        a, b = self._edge(left, 1), self._edge(right, 0)
        i = j = 0
        while True:
            (x, x_ends), (y, y_ends) = a[i], b[j]
            rank = self.joined.get((x, y), NEVER)
            if rank < before and rank < x_ends and rank <= y_ends:
                return False
            if x_ends == NEVER and y_ends == NEVER:
                return True
            if x_ends <= y_ends:
                i += 1
            if y_ends <= x_ends:
                j += 1

    def compatible(self, left: int, right: int) -> bool:
        """The text of both tokens is encoded as just these two."""
        key = (left, right)
        if key not in self._fits:
            if len(self._fits) > REMEMBERED:
                self._fits.clear()
            self._fits[key] = self._apart(left, right, NEVER)
        return self._fits[key]

    def complete(self, token: int) -> bool:
        """The text of the token is encoded as the token."""
        if token not in self._whole:
            a, b = self.parts.get(token, (None, None))
            self._whole[token] = a is None or (self.complete(a) and self.complete(b) and self._apart(a, b, self.rank[token]))
        return self._whole[token]

    def encode_word(self, word: str) -> tuple[int, ...]:
        raw = word.encode()
        line = raw[:-1].decode("latin-1") + chr(raw[-1] + 256)
        last: list[tuple[int, int] | None] = [None] * (len(line) + 1)
        for at, (token, length) in self.found.iter(line):
            end = at + 1
            if last[end] is None and self.complete(token):
                before = last[end - length]
                if length == end or (before is not None and self.compatible(before[0], token)):
                    last[end] = (token, length)
        ids, end = [], len(line)
        while end:
            token, length = last[end]
            ids.append(token)
            end -= length
        return tuple(reversed(ids))

    def forget(self) -> None:
        """Give up the memory of words and pairs."""
        self.words.clear()
        self._fits.clear()

    def _segment(self, text: str) -> list[tuple[int, ...]]:
        text = unicodedata.normalize("NFC", text)
        # lower-casing goes by character: a final sigma is no special case
        text = "σ".join(part.lower() for part in text.split("Σ"))
        words = self.pattern.findall(text)
        if len(self.words) > REMEMBERED:
            self.words.clear()
        known = self.words
        for w in set(words):
            if w not in known:
                known[w] = self.encode_word(w)
        return [known[w] for w in words]

    def encode(self, text: str) -> np.ndarray:
        if self.cut is None or not any(t in text for t in self.special):
            found = self._segment(text)
        else:
            found = []
            for part in self.cut.split(text):
                found.extend([(self.special[part],)] if part in self.special else self._segment(part))
        return np.fromiter(chain.from_iterable(found), np.int32)

    def decode(self, ids: list[int]) -> str:
        """The tokens' texts joined by spaces, as the file names no decoder."""
        return " ".join(map(self.texts.__getitem__, ids))


_loaded: dict[str, Vocabulary] = {}


def _vocabulary(spec: str) -> Vocabulary:
    if spec not in _loaded:
        _loaded.clear()
        _loaded[spec] = Vocabulary(json.loads(spec))
    return _loaded[spec]


def read_spec(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def _runs(texts: pa.Array, most: int = BATCH_CHARS) -> Iterator[tuple[int, list[str]]]:
    first, held, chars = 0, [], 0
    for i in range(len(texts)):
        held.append(texts[i].as_py() or "")
        chars += len(held[-1])
        if chars >= most:
            yield first, held
            first, held, chars = i + 1, [], 0
    if held:
        yield first, held


def _ids(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(arrays) if arrays else np.zeros(0, np.int32)))


def _whole(ids: list[np.ndarray], decoded: list[str]) -> list[pa.Array]:
    return [_ids(ids), pa.array(decoded, pa.string())]


def digests(ids: list[np.ndarray], decoded: list[str]) -> list[pa.Array]:
    """Number of ids, SHA-256 of the decimal ids joined by one space, and
    SHA-256 of the decoded text in UTF-8."""
    def sha(texts: Iterator[str]) -> pa.Array:
        return pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string())

    return [pa.array([len(x) for x in ids], pa.int64()), sha(" ".join(map(str, x.tolist())) for x in ids), sha(iter(decoded))]


#: What ``encode_decode`` can return besides the id: columns and how they are made.
WHOLE = ("ids array<int>, decoded string", _whole)
DIGESTS = ("n_tokens long, ids_sha256 string, decoded_sha256 string", digests)


def encode_decode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", result=WHOLE) -> DataFrame:
    """(doc_id, ids array<int>, decoded string) of every whole text, without
    added special tokens; those that a text spells out are encoded as such.
    With ``result=DIGESTS`` only digests of both leave the task.

    ``vocabulary`` is the path of the tokenizer file, read on the driver. A
    null or empty text has no ids and decodes to an empty text. Null and
    repeated ids stay rows of their own; other columns are ignored; an empty
    table gives an empty result.
    """
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(vocabulary))
    id_type = docs.schema[id_col].dataType.simpleString()
    columns, made = result
    names = ["doc_id", *[c.split()[0] for c in columns.split(", ")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = _vocabulary(spec.value)
        for batch in batches:
            for first, texts in _runs(batch.column(1)):
                ids = [v.encode(t) for t in texts]
                out = made(ids, [v.decode(x.tolist()) for x in ids])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), *out], names=names)
        v.forget()  # Spark keeps the worker for other tasks, of other jobs too

    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, f"doc_id {id_type}, {columns}"))


def decode(tokens: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, decoded) of rows of token ids; null ids decode to an empty text."""
    spec = tokens.sparkSession.sparkContext.broadcast(read_spec(vocabulary))
    id_type = tokens.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = _vocabulary(spec.value)
        for batch in batches:
            texts = [v.decode(x.as_py() or []) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "decoded"])

    return tokens.select(F.col(id_col).alias("doc_id"), ids_col).mapInArrow(run, f"doc_id {id_type}, decoded string")
