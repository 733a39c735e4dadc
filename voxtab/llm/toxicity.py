"""Toxicity by the nearest labelled examples.

Texts become TF-IDF vectors over all words of the examples and the first
letters of longer ones; the nearest examples by exact cosine come from an
inverted index whose postings are cut into tiles of like examples. What many
of a tile hold is kept as dense rows of that tile; texts near to the same
centre are multiplied with a tile at once, by the rows that any of them holds,
and all other postings are added one by one. All cosines are computed, so no
neighbour is missed. Neighbours vote
with weight 1 / (distance + ``SOFTEN``); an isotonic curve, fitted on the
examples' own votes, turns the vote into a probability. Examples with the very
words of a text, each as often, never vote on it, in the fit as in ``score``:
so no text is judged by its own label, and trained rows have no advantage over
others. The evidence is the neighbours, with their similarity and label.

The inverse document frequency is smoothed by a share of all documents
(``SMOOTH``): words below that share weigh much the same. Without it the
rarest words, which say the least of other texts, rule every cosine.

What is bounded: the examples (``MAX_TOXIC`` toxic and ``MAX_CLEAN`` clean
rows, picked by a hash of the id). The vocabulary is theirs, no term is left
out; the index grows with their texts only and is broadcast. Document
frequencies count all documents, and every document is scored whole, where it
lies: only term counts are shuffled, reduced in each task first.

Defined cases: a null text counts as empty. A text without any term of the
examples has no neighbours; its score is the share of toxic rows among
examples without terms, or among all where each has some. Without labelled rows every score is 0. Rows with a
null label never train; a document labelled twice is toxic if any label says
so; equal similarities are ordered by the example's number. Repeated rows are
scored alike; an empty table gives an empty result; other columns pass, but
``score`` and ``evidence`` are replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxtab.llm.common import add_columns, materialise

MAX_TOXIC, MAX_CLEAN = 4_000, 8_000
NEIGHBOURS = 15
SOFTEN = 0.05
SMOOTH = 0.01
STEMS = (4, 5)
WORD = re.compile(r"[^\W\d_]+")
#: Terms with dense rows: so many at most, each held by one in so many examples; and texts that are scored at once.
DENSE, DENSE_SHARE, BATCH = 1024, 16, 1024
#: Groups of like examples, dense rows of a tile, and vectors multiplied with it at once.
GROUPS, TILE_ROWS, CELL = 6, 2048, 256
#: Postings that are worked on at once when an index is made.
RUN = 1 << 18
#: Texts that are counted at once for the frequencies: each time, a table of the whole vocabulary is made.
LOOKED_UP = 2048
#: Bytes of texts whose words are looked up at once, about.
PIECE = 1 << 23
#: What a task keeps: neighbours of equal term counts.
CACHE_VECTORS = 5_000


#: Latin-1 with spaces for what is in no word.
PLAIN = bytes(i if WORD.fullmatch(chr(i)) else 32 for i in range(256))


def spaced(text: str | None) -> str:
    """The lower-cased words of a text, the matches of ``WORD``, with spaces
    between them."""
    if not text:
        return ""
    text = text.lower()
    try:
        return text.encode("latin-1").translate(PLAIN).decode("latin-1")
    except UnicodeEncodeError:
        return " ".join(WORD.findall(text))


def terms(text: str | None) -> set[str]:
    """Lower-cased words, and the first letters of longer ones."""
    words = set(spaced(text).split())
    return words | {w[:k] + "*" for w in words for k in STEMS if len(w) > k}


def count(texts: pa.Array, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, terms, counts): the terms of text i, ascending, and how often
    it counts for each are entries ``starts[i]:starts[i+1]``."""
    piece = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)) // PIECE
    cuts = np.r_[0, np.flatnonzero(np.diff(piece)) + 1, len(texts)].tolist()
    parts = [_count(texts.slice(s, e - s), vocabulary) for s, e in zip(cuts, cuts[1:], strict=False)]
    ends = np.cumsum(np.concatenate([np.diff(p[0]) for p in parts]))
    return np.r_[0, ends].astype(np.int64), np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])


def _count(texts: pa.Array, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``count``; each different word of the texts is looked up once."""
    lists = pc.ascii_split_whitespace(pa.array([spaced(t.as_py()) for t in texts], pa.large_string()))
    words = lists.flatten().dictionary_encode()
    owner = np.repeat(np.arange(len(texts), dtype=np.int64) * len(vocabulary), np.diff(lists.offsets.to_numpy()))
    del lists
    known, found = words.dictionary, []
    forms = [known]
    for k in STEMS:
        stem = pc.binary_join_element_wise(pc.utf8_slice_codeunits(known, 0, k), *(pa.scalar(x, known.type) for x in ("*", "")))
        forms.append(pc.if_else(pc.greater(pc.utf8_length(known), k), stem, pa.scalar(None, known.type)))
    at = pc.index_in(pa.concat_arrays(forms), value_set=vocabulary, skip_nulls=True).fill_null(-1).to_numpy(zero_copy_only=False)
    code = words.indices.to_numpy(zero_copy_only=False)
    for form in at.reshape(len(forms), len(known)):
        held = form[code]
        found.append((owner + held)[held >= 0])
    key, n = np.unique(np.concatenate(found), return_counts=True)
    ends = np.searchsorted(key, np.arange(len(texts) + 1) * len(vocabulary))
    return ends, key - np.repeat(np.arange(len(texts)) * len(vocabulary), np.diff(ends)), n


@dataclass
class Index:
    """Examples in tiles of like ones. Postings of term t are entries
    ``starts[t]:starts[t+1]`` of ``example`` and ``code``; their weight is
    ``value[code] * by_term[t] / norm[example]``, never negative."""

    ids: np.ndarray
    toxic: np.ndarray
    starts: np.ndarray
    example: np.ndarray
    code: np.ndarray
    value: np.ndarray
    by_term: np.ndarray
    norm: np.ndarray

    @classmethod
    def build(cls, ids, toxic, term: np.ndarray, example: np.ndarray, weight: np.ndarray, n_terms: int) -> Index:
        if (np.diff(term) < 0).any():
            order = np.lexsort((example, term))
            term, example, weight = term[order], example[order], weight[order]
        starts = np.searchsorted(term, np.arange(n_terms + 1))
        return cls(np.asarray(ids), np.asarray(toxic, float), starts, example, np.arange(len(weight)), weight, np.ones(n_terms), np.ones(len(ids)))

    def runs(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(term, example, weight) of the postings in order, some ``RUN`` of
        them at a time."""
        for a, b in _cuts(self.starts):
            s = slice(self.starts[a], self.starts[b])
            term = np.repeat(np.arange(a, b), np.diff(self.starts[a : b + 1]))
            example = self.example[s].astype(np.int64)
            yield term, example, self.value[self.code[s]] * self.by_term[term] / self.norm[example]

    @property
    def dense(self) -> tuple[np.ndarray, np.ndarray]:
        """The row of each term (-1: none), and the rows of the most frequent terms."""
        held = np.diff(self.starts)
        some = _frequent(held, len(self.ids), DENSE)
        row = np.full(len(held), -1, np.int16)
        row[some] = np.arange(len(some))
        rows = np.zeros((len(some), len(self.ids)), np.float32)
        for i, t in enumerate(some):
            at = slice(self.starts[t], self.starts[t + 1])
            rows[i, self.example[at]] = self.value[self.code[at]] * self.by_term[t] / self.norm[self.example[at]]
        return row, rows

    @cached_property
    def tiles(self) -> Tiles:
        """The examples by likeness, found by some rounds of k-means over the
        most frequent terms, and by length: the longest that hold half of the
        postings of like ones are apart. This decides what a search costs,
        never what it finds. Beside the tiles, no array of all postings is
        made: many workers build them at once."""
        n, n_terms = len(self.ids), len(self.starts) - 1
        frequent, x = self.dense
        x /= np.maximum(np.sqrt(np.einsum("ij,ij->j", x, x)), 1e-9)
        centre = x[:, np.linspace(0, n - 1, max(1, min(GROUPS, n // 256))).astype(int)].T.copy()
        for _ in range(6):
            group = (centre @ x).argmax(0)
            totals = (x @ (group[:, None] == np.arange(len(centre))).astype(np.float32)).T
            for g in np.unique(group):
                centre[g] = totals[g] / max(np.sqrt((totals[g] * totals[g]).sum()), 1e-9)
        del x
        size = sum((np.bincount(example, minlength=n) for _, example, _ in self.runs()), np.zeros(n, np.int64))
        group = 2 * group
        for g in np.unique(group):
            like = np.flatnonzero(group == g)
            like = like[np.argsort(-size[like], kind="stable")]
            group[like] += np.cumsum(size[like]) * 2 > size[like].sum()
        order = np.argsort(group, kind="stable")
        slot = np.empty(n, np.int32)
        slot[order] = np.arange(n, dtype=np.int32)
        tile, width = np.unique(group, return_inverse=True)[1], np.unique(group, return_counts=True)[1]
        lo = np.cumsum(width) - width
        held = np.zeros((len(width), n_terms), np.min_scalar_type(n))
        for term, example, _ in self.runs():
            first, last = term[0], term[-1] + 1
            held[:, first:last] = np.bincount(tile[example] * (last - first) + term - first, minlength=len(width) * (last - first)).reshape(len(width), -1)
        row = np.full(held.shape, -1, np.int16)
        for g, in_tile in enumerate(held):
            some = _frequent(in_tile.astype(np.int64), width[g], TILE_ROWS)
            row[g, some] = np.arange(len(some))
        n_sparse = (held * (row < 0)).sum(0, dtype=np.int64)
        del held
        ends = np.cumsum((row.max(1, initial=-1) + 1) * width)
        begin = ends - (row.max(1, initial=-1) + 1) * width
        flat = np.zeros(ends[-1])
        starts = np.r_[0, np.cumsum(n_sparse)]
        at, weights, done = np.empty(starts[-1], np.int32), np.empty(starts[-1]), 0
        for term, example, weight in self.runs():
            g = tile[example]
            of = row[g, term].astype(np.int64)
            hit = np.flatnonzero(of >= 0)
            g, of = g[hit], of[hit]
            flat[begin[g] + of * width[g] + slot[example[hit]] - lo[g]] = weight[hit]
            rest = np.flatnonzero(row[tile[example], term] < 0)
            at[done : done + len(rest)], weights[done : done + len(rest)] = slot[example[rest]], weight[rest]
            done += len(rest)
        blocks = [(int(a), int(a + w), row[g], flat[s:e].reshape(-1, w)) for g, (a, w, s, e) in enumerate(zip(lo, width, begin, ends, strict=True))]
        return Tiles(order, slot, frequent, centre, blocks, starts, at, weights)

    def nearest(self, term: np.ndarray, weight: np.ndarray, k: int, without: Sequence[int] = ()) -> tuple[np.ndarray, np.ndarray]:
        """``nearest_all`` of one vector."""
        return self.nearest_all(np.array([0, len(term)]), term, weight, k, [without])[0]

    def nearest_all(
        self, starts: np.ndarray, term: np.ndarray, weight: np.ndarray, k: int, without: Sequence[Sequence[int]]
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each vector i, entries ``starts[i]:starts[i+1]``, the k nearest
        examples with a positive cosine, nearest first (ties by number), and
        their similarity to nine digits. ``without``: examples it leaves out."""
        found = [(np.zeros(0, int), np.zeros(0))] * len(without)
        if not len(self.ids):
            return found
        order, slot = self.tiles.order, self.tiles.slot
        for i, sums in self.tiles.cosines(starts, term, weight):
            sums[slot[np.asarray(without[i], int)]] = 0
            least = np.partition(sums, len(sums) - k)[len(sums) - k] - 2e-9 if len(sums) > k else 0.0  # equal ones to nine digits stay
            some = np.flatnonzero((sums >= least) & (sums > 0))
            ids, s = order[some], np.round(sums[some], 9)
            top = np.lexsort((ids, -s))[:k]
            found[i] = ids[top], s[top]
        return found


@dataclass
class Tiles:
    """Like examples hold neighbouring slots. What many of a tile (``lo`` to
    ``hi``) hold lies in its dense rows (``row`` of a term, -1: none); all
    other postings of term t are entries ``starts[t]:starts[t+1]`` of ``at``
    (slots) and ``weight``."""

    order: np.ndarray  # the example of a slot
    slot: np.ndarray  # the slot of an example
    frequent: np.ndarray  # the place of a term among the most frequent (-1: none)
    centre: np.ndarray  # of each group of like examples, over these
    blocks: list[tuple[int, int, np.ndarray, np.ndarray]]  # lo, hi, row, rows
    starts: np.ndarray
    at: np.ndarray
    weight: np.ndarray

    def cosines(self, starts: np.ndarray, term: np.ndarray, weight: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """The number of each vector and its cosines with all slots. Vectors
        near to the same centre, ``CELL`` at most, are multiplied with a tile
        at once, by the rows that any of them holds."""
        n, lens = len(starts) - 1, np.diff(starts)
        owner = np.repeat(np.arange(n), lens)
        asked = np.zeros((n, self.centre.shape[1]))
        hit = np.flatnonzero(self.frequent[term] >= 0)
        asked[owner[hit], self.frequent[term[hit]]] = weight[hit]
        home = (asked @ self.centre.T).argmax(1)
        order = np.argsort(home, kind="stable")
        at = _ranges(starts[order], lens[order])
        term, weight, lens = term[at], weight[at], lens[order]
        owner, starts = np.repeat(np.arange(n), lens), np.r_[0, np.cumsum(lens)]
        cuts = np.r_[0, np.flatnonzero(np.diff(home[order])) + 1, n]
        cuts = np.concatenate([np.arange(s, e, CELL) for s, e in zip(cuts, cuts[1:], strict=False)] + [[n]]).astype(int).tolist()
        for first, last in zip(cuts, cuts[1:], strict=False):
            some = slice(starts[first], starts[last])
            sums = np.zeros((last - first, len(self.order)))
            for lo, hi, row, rows in self.blocks:
                at = row[term[some]]
                hit = np.flatnonzero(at >= 0)
                if not len(hit):
                    continue
                at, who, w = at[hit], owner[some][hit] - first, weight[some][hit]
                used = np.zeros(len(rows), bool)
                used[at] = True
                few = used.mean() < 0.6
                at = (np.cumsum(used) - 1)[at] if few else at
                asked = np.zeros((last - first, int(used.sum()) if few else len(rows)))
                asked[who, at] = w
                sums[:, lo:hi] = asked @ (rows[used] if few else rows)
            for i, part in enumerate(sums, first):
                s, e = starts[i], starts[i + 1]
                begin = self.starts[term[s:e]]
                size = self.starts[term[s:e] + 1] - begin
                rest = _ranges(begin, size)
                part += np.bincount(self.at[rest], self.weight[rest] * np.repeat(weight[s:e], size), len(self.order))
                yield int(order[i]), part


def _frequent(held: np.ndarray, n: int, most: int) -> np.ndarray:
    """At most so many terms, each held by one in ``DENSE_SHARE`` of ``n``
    examples, the most frequent first."""
    some = np.flatnonzero(held * DENSE_SHARE >= max(1, n))
    return some[np.argsort(-held[some], kind="stable")][:most]


def _cuts(starts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of terms that hold some ``RUN`` postings; terms without any
    belong to no run of their own."""
    cuts = np.unique(np.searchsorted(starts, np.r_[np.arange(0, starts[-1], RUN), starts[-1]])).tolist()
    return ((a, b) for a, b in zip(cuts, cuts[1:], strict=False) if starts[b] > starts[a])


def _ranges(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The numbers of all ranges ``starts[i] .. starts[i] + lens[i]``."""
    ends = np.cumsum(lens)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lens), lens)


@dataclass
class Model:
    """Postings of term t are entries ``starts[t]:starts[t+1]`` of
    ``example`` and ``times``. Each process makes the index from them, which
    is several times their size, so only they are sent."""

    vocabulary: pa.Array | None  # sorted
    idf: np.ndarray
    ids: np.ndarray
    toxic: np.ndarray
    starts: np.ndarray
    example: np.ndarray
    times: np.ndarray  # how often the example counts for the term
    base: float
    votes: np.ndarray  # knots of the calibration curve
    scores: np.ndarray
    alike: dict[bytes, list[int]]  # the examples with the same term counts, by their digest

    @cached_property
    def index(self) -> Index:
        value = np.r_[0.0, 1 + np.log(np.arange(1, int(self.times.max(initial=0)) + 1))]  # by how often
        index = Index(np.asarray(self.ids), np.asarray(self.toxic, float), self.starts, self.example, self.times, value, self.idf, np.ones(len(self.ids)))
        squares = sum((np.bincount(example, w * w, len(self.ids)) for _, example, w in index.runs()), np.zeros(len(self.ids)))
        index.norm = np.sqrt(squares)
        index.tiles  # noqa: B018  what they hold is not kept twice; a view would keep it
        index.example = index.code = np.zeros(0, np.int32)
        return index

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "index"}

    @property
    def number(self) -> dict[str, int]:
        return {t: i for i, t in enumerate(self.vocabulary.to_pylist())}

    def weights(self, starts: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The weights of texts' terms, given as ``count`` does."""
        w = (1 + np.log(n, dtype=float)) * self.idf[at]
        owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        return w / np.sqrt(np.bincount(owner, w * w, len(starts) - 1))[owner]

    def vote(self, near: np.ndarray, sims: np.ndarray) -> float:
        w = 1.0 / (np.maximum(1.0 - sims, 0.0) + SOFTEN)
        return float((w * self.index.toxic[near]).sum() / w.sum())

    def score(self, starts: np.ndarray, at: np.ndarray, n: np.ndarray, keys: list[bytes]) -> Iterator:
        """(score, neighbours, similarities) for each text's term counts, which ``keys`` name."""
        weight = self.weights(starts, at, n)
        near = self.index.nearest_all(starts, at, weight, NEIGHBOURS, [self.alike.get(k, ()) for k in keys])
        for ids, sims in near:
            yield float(np.interp(self.vote(ids, sims), self.votes, self.scores)) if len(ids) else self.base, ids, sims


def digest(at: np.ndarray, n: np.ndarray) -> bytes:
    """Names term counts."""
    return hashlib.blake2b(at.astype("<i8").tobytes() + n.astype("<i8").tobytes(), digest_size=16).digest()


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing curve nearest to y over x (pool adjacent
    violators)."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []  # low x, high x, sum of weighted y, weight
    for a, b, w in zip(x[order], y[order], weight[order], strict=True):
        pools.append([a, a, b * w, w])
        while len(pools) > 1 and (pools[-2][1] == pools[-1][0] or pools[-2][2] * pools[-1][3] >= pools[-1][2] * pools[-2][3]):
            last = pools.pop()
            pools[-1] = [pools[-1][0], last[1], pools[-1][2] + last[2], pools[-1][3] + last[3]]
    knots = np.array([p[:2] for p in pools]).ravel()
    return knots, np.repeat([p[2] / p[3] for p in pools], 2)


def _count_known(column: str, vocabulary: pa.Array):
    """Per task: how many texts hold each term of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(vocabulary), np.int64)
        for b in batches:
            for i in range(0, b.num_rows, LOOKED_UP):
                n += np.bincount(count(b[column].slice(i, LOOKED_UP), vocabulary)[1], minlength=len(n))
        held = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict({"term": pa.array(held), "n": pa.array(n[held])})

    return run


def _terms(column: str):
    """Per batch: the terms of its texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found: set[str] = set()
            found.update(*(terms(t.as_py()) for t in b[column]))
            yield pa.RecordBatch.from_pydict({"term": pa.array(sorted(found), pa.string())})

    return run


def examples(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, toxic, share): the sampled labelled rows, and the share
    of their class that was taken. The labels are sampled first, by a hash of
    the id; what is left has a bounded size and is broadcast to the texts."""
    flags = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("long").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in flags.groupBy("toxic").count().collect()}  # one row for each label value
    share = F.lit(0.0)
    for value, n in sizes.items():
        share = F.when(F.col("toxic") == value, F.lit(min(1.0, (MAX_TOXIC if value == 1 else MAX_CLEAN) / n))).otherwise(share)
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    some = flags.withColumn("share", share).where(place < F.col("share"))
    return docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").select("doc_id", "text", "toxic", "share")


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Learns from ``labels`` (leave held-out rows out of it) and the texts
    of ``docs``; document frequencies are those of all ``docs``."""
    spark = docs.sparkSession
    picked = materialise(examples(docs, labels), "toxic-examples")
    if not picked.head(1):
        return None
    found = picked.mapInArrow(_terms("text"), "term string").distinct().toArrow()["term"].cast(pa.large_string()).combine_chunks()  # the examples' own
    vocabulary = found.take(pc.array_sort_indices(found))
    del found
    held = docs.select("text").mapInArrow(_count_known("text", vocabulary), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    frequency = np.zeros(len(vocabulary))
    frequency[held["term"].to_numpy(int)] = held["n"]
    del held
    n_docs = docs.count()
    idf = np.log((1 + SMOOTH) * (n_docs + 1) / (frequency + 1 + SMOOTH * n_docs))
    none = np.zeros(0, np.int32)
    model = Model(vocabulary, idf, none, none, np.zeros(len(idf) + 1, int), none, none, 0.0, np.array([0.0, 1.0]), np.array([0.0, 1.0]), {})
    shared = spark.sparkContext.broadcast(model)

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            starts, at, n = count(batch["text"], m.vocabulary)
            w = m.weights(starts, at, n)
            lead = pa.array([int(at[s + np.argmax(w[s:e])]) if e > s else -1 for s, e in zip(starts[:-1], starts[1:], strict=True)], pa.int32())
            held = [pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(x, pa.int32())) for x in (at, n)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["toxic"], batch["share"], lead, *held], names=["doc_id", "toxic", "share", "lead", "at", "n"])

    kind = "doc_id long, toxic long, share double, lead int, at array<int>, n array<int>"
    # at most MAX_TOXIC + MAX_CLEAN rows, about; those with the same strongest term stand together, so that block maxima are tight
    table = picked.mapInArrow(counts, kind).orderBy("lead", "doc_id").toArrow()
    shared.destroy()
    small = lambda x: x.astype(np.min_scalar_type(int(x.max(initial=0))))
    model.ids, model.toxic, share = (table[c].to_numpy() for c in ("doc_id", "toxic", "share"))
    sizes = np.concatenate([np.diff(c.offsets.to_numpy()) for c in table["at"].chunks])
    at, times = (np.concatenate([c.flatten().to_numpy() for c in table[x].chunks]) for x in ("at", "n"))
    del table  # the driver holds each posting as few times as it can
    times, ends = small(times), np.cumsum(sizes)
    for i, (a, b) in enumerate(zip(ends - sizes, ends, strict=True)):  # of a bounded number of examples
        model.alike.setdefault(digest(at[a:b], times[a:b]), []).append(i)
    held = sum((np.bincount(at[i : i + RUN], minlength=len(idf)) for i in range(0, len(at), RUN)), np.zeros(len(idf), int))
    order = np.argsort(at, kind="stable")
    model.starts, model.times = np.r_[0, np.cumsum(held)], times[order]
    model.example = np.repeat(small(np.arange(len(sizes))), sizes)[order]
    del order
    return _calibrate(spark, model, (np.r_[0, ends], at, times), 1.0 / share, sizes == 0)


def _calibrate(spark, model: Model, counts: tuple[np.ndarray, ...], weight: np.ndarray, bare: np.ndarray) -> Model:
    """The curve from votes to scores, by votes on the examples, each with the ``weight`` of what it stands for in the corpus.
    ``counts``: the examples' terms, as ``count`` gives them; ``bare``: examples without terms."""
    y = model.toxic.astype(float)
    shared = spark.sparkContext.broadcast((replace(model, vocabulary=None), *counts))

    def vote(batches):
        m, starts, at, n = shared.value
        own = {i: same for same in m.alike.values() for i in same}
        for pdf in batches:
            out = []
            for first in range(0, len(pdf), BATCH):
                some = pdf["i"].to_numpy()[first : first + BATCH]
                lens = starts[some + 1] - starts[some]
                flat, ends = _ranges(starts[some], lens), np.r_[0, np.cumsum(lens)]
                for near, sims in m.index.nearest_all(ends, at[flat], m.weights(ends, at[flat], n[flat]), NEIGHBOURS, [own[i] for i in some]):
                    out.append(m.vote(near, sims) if len(near) else -1.0)
            yield pdf[["i"]].assign(vote=out)

    like = bare if bare.any() else np.ones(len(y), bool)
    model.base = float((y * weight)[like].sum() / weight[like].sum())
    asked = [(int(i),) for i in np.flatnonzero(~bare)]
    if asked:
        rows = spark.createDataFrame(asked, "i long").repartition(spark.sparkContext.defaultParallelism)
        got = rows.mapInPandas(vote, "i long, vote double").toPandas()
        got = got[got["vote"] >= 0].sort_values("i")
        if len(got):
            model.votes, model.scores = isotonic(got["vote"].to_numpy(), y[got["i"]], weight[got["i"]])
    shared.destroy()
    return model


def score(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` plus ``score`` and ``evidence`` (the neighbours)."""
    fields = T._parse_datatype_string("score double, evidence array<struct<doc_id:bigint,similarity:double,toxic:int>>").fields
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64()), ("toxic", pa.int32())]))

    def start():
        m = shared.value
        known: dict[bytes, tuple[float, np.ndarray, np.ndarray]] = {}

        def run(texts: pa.Array) -> list[pa.Array]:
            if not m:
                return [pa.array(np.zeros(len(texts))), pa.array([[]] * len(texts), kind)]
            starts, at, n = count(texts, m.vocabulary)
            keys = [digest(at[s:e], n[s:e]) for s, e in zip(starts[:-1], starts[1:], strict=True)]
            if len(known) >= CACHE_VECTORS:
                known.clear()
            new = {k: i for i, k in enumerate(keys) if k not in known}  # equal counts have equal neighbours
            some = np.fromiter(new.values(), int)
            lens = starts[some + 1] - starts[some]
            flat = _ranges(starts[some], lens)
            results = m.score(np.r_[0, np.cumsum(lens)], at[flat], n[flat], list(new))
            known.update((key, (min(1.0, max(0.0, s)), near, sims)) for key, (s, near, sims) in zip(new, results, strict=True))
            found = [known[k] for k in keys]
            near = np.concatenate([f[1] for f in found])
            evidence = [pa.array(m.index.ids[near], pa.int64()), pa.array(np.concatenate([f[2] for f in found])), pa.array(m.index.toxic[near].astype(np.int32))]
            ends = pa.array(np.r_[0, np.cumsum([len(f[1]) for f in found])], pa.int32())
            return [pa.array([f[0] for f in found], pa.float64()), pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(evidence, fields=list(kind.value_type)))]

        return run

    return add_columns(docs, text, fields, start, BATCH)
