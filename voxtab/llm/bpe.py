"""Byte-pair encoding and decoding with a given vocabulary.

``encode`` normalises a text, cuts it into pieces and merges each piece's
symbols: a priority queue of merge ranks over a doubly linked symbol list.
Queue entries whose symbols have changed since are stale and skipped.
``decode`` concatenates vocabulary strings with the separator that the
vocabulary's library puts between tokens.

Rows are encoded where they are read: no shuffle, and the vocabulary (a
fixed-size file, tens of thousands of entries) is broadcast. Each Python
worker keeps the ids of words it has seen (runs without white space), and
below them those of the words' pieces, so that a word with another mark at its
end is not merged again. Both are two tables of at most ``CACHE_WORDS`` or
``CACHE_PIECES`` entries of at most ``KEPT_CHARS`` characters, the older of
which goes when the newer is full; this bounds memory and never changes a
result. Ids of whole texts go into one Arrow column.

Character classes are those of Python's Unicode tables; the result equals the
vocabulary's own library for every character that both tables know.

Defined cases: a null text counts as empty; an empty text has no ids and
decodes to the empty string; texts of any length are encoded whole; repeated
rows are encoded alike; an empty table gives an empty result. Columns of the
input pass through, but one that has the new column's name is replaced.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from array import array
from collections.abc import Callable
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from voxtab.llm.common import add_columns

CACHE_WORDS, CACHE_PIECES, KEPT_CHARS = 75_000, 200_000, 64
#: What the split pattern's \\s matches.
WHITE_SPACE = " \\t-\\r\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_POS_BITS = 40


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level
    vocabularies: printable Latin-1 stands for itself, the others take the
    code points from 256 on, in order."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """What encoding needs from a tokenizer file: vocabulary, merges, special
    strings, and the split pattern."""

    def __init__(self, spec: dict):
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = [""] * (1 + max([*vocab.values(), *self.special.values()], default=0))
        for s, i in [*vocab.items(), *self.special.items()]:
            self.strings[i] = s
        suffix = model["end_of_word_suffix"] or ""
        signs = byte_symbols()
        self.inner = [vocab.get(c) for c in signs]
        self.last = [vocab.get(c + suffix) for c in signs]
        merges = [m if isinstance(m, (list, tuple)) else m.split(" ") for m in model["merges"]]
        self.left = [vocab[a] for a, _ in merges]
        self.right = [vocab[b] for _, b in merges]
        self.made = [vocab[a + b] for a, b in merges]
        self.ranks: dict[tuple[int, int], int] = {}
        for r, pair in enumerate(zip(self.left, self.right, strict=True)):
            self.ranks.setdefault(pair, r)
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = split["pattern"]["Regex"]

    @cached_property
    def encode(self) -> Callable[[str], bytes]:
        """The encoder of this process, so that the pieces it knows serve all
        tasks of a worker."""
        return encoder(self)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "encode"}

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            return cls(json.load(f))

    def merge(self, symbols: list[int]) -> list[int]:
        """Applies merges by rank, leftmost first among equal ranks."""
        n = len(symbols)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        ranks, queue = self.ranks, []
        for p in range(n - 1):
            r = ranks.get((symbols[p], symbols[p + 1]))
            if r is not None:
                queue.append(r << _POS_BITS | p)
        heapq.heapify(queue)
        while queue:
            top = heapq.heappop(queue)
            r, p = top >> _POS_BITS, top & ((1 << _POS_BITS) - 1)
            q = after[p]
            if q < 0 or symbols[p] != self.left[r] or symbols[q] != self.right[r]:
                continue  # stale: a neighbour or the symbol itself has merged since
            symbols[p], symbols[q] = self.made[r], -1
            after[p] = s = after[q]
            after[q] = -1
            if s >= 0:
                before[s] = p
                if (r := ranks.get((symbols[p], symbols[s]))) is not None:
                    heapq.heappush(queue, r << _POS_BITS | p)
            b = before[p]
            if b >= 0 and (r := ranks.get((symbols[b], symbols[p]))) is not None:
                heapq.heappush(queue, r << _POS_BITS | b)
        return [s for s in symbols if s >= 0]

    def piece(self, text: str) -> list[int]:
        raw = text.encode()
        symbols = [self.inner[b] for b in raw[:-1]] + [self.last[raw[-1]]]
        return self.merge([s for s in symbols if s is not None])


class Recent:
    """``make(key)`` of the short keys asked for last, at most twice ``most``."""

    def __init__(self, make: Callable[[str], bytes], most: int):
        self.make, self.most = make, most
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # the keys before; those seen again move up

    def __call__(self, key: str) -> bytes:
        found = self.known.get(key)
        if found is None:
            found = self.older.get(key)
            if found is None:
                found = self.make(key)
            if len(key) <= KEPT_CHARS:
                if len(self.known) >= self.most:
                    self.known, self.older = {}, self.known
                self.known[key] = found
        return found


def encoder(vocabulary: Vocabulary) -> Callable[[str], bytes]:
    """A function from a text to its ids as packed 32-bit integers."""
    pieces = regex.compile(vocabulary.pattern).findall
    special = vocabulary.special
    marks = re.compile("(" + "|".join(re.escape(s) for s in sorted(special, key=len, reverse=True)) + ")") if special else None
    piece = Recent(lambda p: array("i", vocabulary.piece(p)).tobytes(), CACHE_PIECES)
    chunk = Recent(lambda word: b"".join(map(piece, pieces(word))), CACHE_WORDS)  # a run of characters without white space

    def plain(text: str) -> bytes:
        if not text.isascii():
            # character by character, so that a final sigma is not special
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        if re.search("[\x1c-\x1f]", text):  # str.split would split there; the pattern's \s does not
            words = re.split("[" + WHITE_SPACE + "]+", text)
        else:
            words = text.split()
        return b"".join([chunk.known.get(w) or chunk(w) for w in words])

    def encode(text: str) -> bytes:
        if marks is None or not any(s in text for s in special):
            return plain(text)
        parts = (array("i", [special[x]]).tobytes() if x in special else plain(x) for x in marks.split(text))
        return b"".join(parts)

    return encode


def _lists(ids: list[bytes]) -> pa.ListArray:
    ends = np.zeros(len(ids) + 1, np.int64)
    np.cumsum([len(x) // 4 for x in ids], out=ends[1:])
    if ends[-1] >= 2**31:
        raise ValueError("too many tokens in one Arrow batch; lower spark.sql.execution.arrow.maxRecordsPerBatch")
    flat = pa.array(np.frombuffer(b"".join(ids), np.int32))
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), flat)


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` plus ``out``: the token ids of the whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def start():
        one = shared.value.encode
        return lambda texts: [_lists([one(t.as_py() or "") for t in texts])]

    return add_columns(docs, text, [T.StructField(out, T.ArrayType(T.IntegerType()))], start)


def round_trip(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encode`` and ``decode`` in one pass over the rows."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def start():
        one, back = shared.value.encode, decoder(shared.value.strings, " ")

        def run(texts: pa.Array) -> list[pa.Array]:
            tokens = _lists([one(t.as_py() or "") for t in texts])
            return [tokens, back(tokens)]

        return run

    fields = [T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(out, T.StringType())]
    return add_columns(docs, text, fields, start)


def decoder(strings: list[str], between: str) -> Callable[[pa.ListArray], pa.Array]:
    """A function from lists of ids to their vocabulary strings joined by
    ``between``; a null list gives an empty text."""
    table = pa.array(strings, pa.string())

    def run(rows: pa.ListArray) -> pa.Array:
        sizes = pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False)
        ends = pa.array(np.r_[0, np.cumsum(sizes)], pa.int32())
        return pc.binary_join(pa.ListArray.from_arrays(ends, table.take(rows.flatten())), between)

    return run


def decode(tokens: DataFrame, vocabulary: Vocabulary, ids: str = "ids", out: str = "decoded", between: str = " ") -> DataFrame:
    """``tokens`` plus ``out``: the vocabulary strings of ``ids`` joined by
    ``between``."""
    shared = tokens.sparkSession.sparkContext.broadcast(vocabulary.strings)

    def start():
        one = decoder(shared.value, between)
        return lambda rows: [one(rows)]

    return add_columns(tokens, ids, [T.StructField(out, T.StringType())], start)
