"""Spelling variants: words that differ by one inserted, deleted or replaced
code point are near; a rare word's form is its most frequent near word.

Near words are found with a frequency-vector trie. Letters fall into
``GROUPS`` groups (code point modulo the number of groups); a word's vector
counts its letters per group, and the trie arranges words by these counts, one
level after another. Inserting, deleting or replacing one letter raises at
most one count by one (surplus) and lowers at most one by one (deficit), so a
depth-first search with a budget of one surplus and one deficit meets every
near word; all other branches are pruned. The words at the leaves that it
reaches are verified.

In Spark the first levels of the trie are the shard: every word is at home in
the shard of its own first counts and visits the shards that the budget
allows, with what is left of it; of two shards only one visits the other (the
one with the smaller count where they first differ), so each pair meets once.
Inside a shard the search walks the remaining levels with all its queries at
once, each branch keeping those whose budget allows it. The number of shard
levels follows the number of words. A dense shard is cut into blocks of home
words and blocks of queries, and every pair of blocks meets in its own call. A
shard returns one row per word: how many near words it met and the best of
them, never pairs.

Defined cases: a null text or one without a run of letters has no words; a
null doc_id counts as the empty text in the hash that deletes a code point.
Repeated rows count as often as they occur. Ties between near words go to the
smallest in code-point order. An empty table gives an empty result. Other
columns are ignored."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxtab.llm.common import LOWER, UPPER, materialise, require

#: Letter groups, home words that a shard should have, home words and queries of a block.
GROUPS, HOMES, HOME_BLOCK, QUERY_BLOCK = 16, 1 << 15, 1 << 16, 1 << 17
#: Pairs of words under which a branch is a leaf, and pairs that are verified at a time.
LEAF, CHUNK = 128, 1 << 16
#: Letters of a word; a shorter word has no variants.
LETTERS, LEAST = "a-zÀ-ÿ", 7


def runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id and run: every maximal run of letters with at least ``least``
    code points, A-Z lower-cased."""
    text = F.translate(F.coalesce(F.col("text"), F.lit("")), UPPER, LOWER)
    found = F.regexp_extract_all(text, F.lit(f"([{LETTERS}]{{{least},}})"), F.lit(1))
    return docs.select("doc_id", F.explode(found).alias("run"))


def misspelt(doc_id: Column, run: Column, every: int = 31) -> Column:
    """The run without one code point where ``every`` divides its hash."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % every == 0, cut).otherwise(run)


def words(docs: DataFrame, least: int = LEAST, times: int = 2) -> DataFrame:
    """word and n: the words of at least ``least`` code points that occur
    ``times`` times or more."""
    require(docs, ["doc_id", "text"])
    seen = runs(docs, least).select(misspelt(F.col("doc_id"), F.col("run")).alias("word")).where(F.length("word") >= least)
    return seen.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= times)


def vectors(some: list[str], groups: int = GROUPS) -> np.ndarray:
    """(len, groups) letter-group counts."""
    flat = np.frombuffer("".join(some).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(some)), [len(w) for w in some])
    return np.bincount(owner * groups + flat % groups, minlength=len(some) * groups).reshape(len(some), groups)


def one_apart(a: str, b: str) -> bool:
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i, n = 0, len(a)
    while i < n and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


class Spelled:
    """Letters of many words, from the left and from the right."""

    def __init__(self, words_: list[str], width: int = 64):
        self.words, self.size = words_, np.array([len(w) for w in words_], np.int64)
        self.width = int(min(width, self.size.max(initial=1)))
        flat = np.frombuffer("".join(words_).encode("utf-32-le", "surrogatepass"), np.uint32)
        owner = np.repeat(np.arange(len(words_)), self.size)
        at = np.arange(len(flat)) - np.repeat(np.cumsum(self.size) - self.size, self.size)
        self.left, self.right = (np.zeros((len(words_), self.width), np.uint32) for _ in range(2))
        for side, place in ((self.left, at), (self.right, self.size[owner] - 1 - at)):
            some = place < self.width
            side[owner[some], place[some]] = flat[some]
        # one change leaves this many letters as they are at one end of both words
        self.k = int(self.size.min(initial=0)) // 2
        self.head, self.tail = (_code(m[:, : min(self.k, self.width)]) for m in (self.left, self.right))

    def near(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those of the pairs of places that are exactly one change apart:
        what they share at both ends is all but one letter."""
        some = (self.head[i] == self.head[j]) | (self.tail[i] == self.tail[j])
        i, j = i[some], j[some]
        least, most = np.minimum(self.size[i], self.size[j]), np.maximum(self.size[i], self.size[j])
        shared = np.zeros(len(i), np.int64)
        for side in (self.left, self.right):
            differ = side[i] != side[j]
            first = np.where(differ.any(axis=1), differ.argmax(axis=1), self.width)
            shared += np.minimum(first, least)
        good = (most - least <= 1) & (shared >= most - 1) & ((most > least) | (shared < 2 * most))
        for x in np.flatnonzero(most > self.width):  # longer than the table
            good[x] = one_apart(self.words[i[x]], self.words[j[x]])
        return i[good], j[good]


def _code(counts: np.ndarray) -> np.ndarray:
    """One number per row of counts (a polynomial modulo 2**64)."""
    code = np.zeros(len(counts), np.uint64)
    for level in range(counts.shape[1]):
        code = code * np.uint64(0x9E3779B97F4A7C15) + counts[:, level].astype(np.uint64) + np.uint64(1)
    return code


def _visits(levels: int) -> list[tuple[int, int]]:
    """Changes (raised level, lowered level) that lead from a word to the
    shards it visits; -1 is none, (-1, -1) its home. The first change is
    upwards: the other way round, the other shard visits."""
    return [(-1, -1)] + [(u, d) for u in range(levels) for d in [-1, *range(u + 1, levels)]]


def routed(vocabulary: DataFrame, levels: int) -> DataFrame:
    """word, n, shard, home, and whether a visitor has spent its deficit (its
    surplus is spent)."""
    changes = _visits(levels)
    names = ["word", "n", "shard", "home", "deficit"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 4096):
                b = whole.slice(i, 4096)
                top = vectors(b.column(0).to_pylist())[:, :levels]
                for up, down in changes:
                    to, able = top.copy(), np.ones(len(top), bool)
                    if up >= 0:
                        to[:, up] += 1
                    if down >= 0:
                        to[:, down] -= 1
                        able = to[:, down] >= 0
                    flags = [pa.array(np.full(len(to), x)) for x in (up < 0, down >= 0)]
                    rows = pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(_code(to).view(np.int64)), *flags], names=names)
                    yield rows.filter(pa.array(able))

    return vocabulary.select("word", "n").mapInArrow(run, "word string, n long, shard long, home boolean, deficit boolean")


def search(homes: np.ndarray, queries: np.ndarray, surplus: np.ndarray, deficit: np.ndarray, levels: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Depth-first search of the trie over the count vectors ``homes`` below
    its first ``levels``: arrays (places in queries, places in homes) of the
    pairs that the budget of a surplus and a deficit of one each brings to a
    leaf together. A home's count above the query's is a surplus, below it a deficit; the flags
    tell what is spent already."""
    stack = [(levels, np.arange(len(homes)), np.arange(len(queries)), surplus.astype(bool), deficit.astype(bool))]
    asked, met, waiting = [], [], 0
    while stack:
        level, h, q, up, down = stack.pop()
        if level == GROUPS or len(h) * len(q) <= LEAF:
            step = max(1, CHUNK // len(h))
            for i in range(0, len(q), step):
                some = q[i : i + step]
                asked.append(np.repeat(some, len(h)))
                met.append(np.tile(h, len(some)))
                waiting += len(met[-1])
                if waiting >= CHUNK:
                    yield np.concatenate(asked), np.concatenate(met)
                    asked, met, waiting = [], [], 0
            continue
        want, held = queries[q, level], homes[h, level]
        order = np.argsort(held, kind="stable")
        starts = np.r_[0, np.flatnonzero(np.diff(held[order])) + 1]
        for s, e in zip(starts, np.r_[starts[1:], len(order)], strict=True):
            count = held[order[s]]
            more, less = want == count - 1, want == count + 1
            on = np.flatnonzero((want == count) | (more & ~up) | (less & ~down))
            if len(on):
                stack.append((level + 1, h[order[s:e]], q[on], up[on] | more[on], down[on] | less[on]))
    if waiting:
        yield np.concatenate(asked), np.concatenate(met)


def _nearest(levels: int):
    """One row per word of the shards of a call: near words met, the best."""

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        word, n, shard = group["word"].to_pylist(), group["n"].to_numpy(), group["shard"].to_numpy()
        held, asks, home, deficit = (np.array(group[c].to_pylist(), bool) for c in ("held", "asks", "home", "deficit"))
        counts, spelled = vectors(word).astype(np.int32), Spelled(word)
        near_words: dict[str, int] = {}
        best: dict[str, tuple[int, str]] = {}

        def offer(w: str, v: str, times: int):
            near_words[w] = near_words.get(w, 0) + 1
            if w not in best or (-times, v) < best[w]:
                best[w] = (-times, v)

        order = np.argsort(shard, kind="stable")
        starts = np.r_[0, np.flatnonzero(np.diff(shard[order])) + 1]
        for s, e in zip(starts, np.r_[starts[1:], len(order)], strict=True):
            at = order[s:e]
            h, q = at[held[at]], at[asks[at]]
            if not len(h) or not len(q):
                continue
            for qs, hs in search(counts[h], counts[q], ~home[q], deficit[q], levels):
                for i, j in zip(*(x.tolist() for x in spelled.near(q[qs], h[hs])), strict=True):
                    offer(word[i], word[j], int(n[j]))
                    if not home[i]:  # the pair meets nowhere else
                        offer(word[j], word[i], int(n[i]))
        found = list(near_words)
        return pa.table({
            "word": pa.array(found, pa.string()), "n_near": pa.array([near_words[w] for w in found], pa.int64()),
            "near_n": pa.array([-best[w][0] for w in found], pa.int64()), "near": pa.array([best[w][1] for w in found], pa.string()),
        })

    return run


def near(vocabulary: DataFrame, homes: int = HOMES, home_block: int = HOME_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """word, n_near, and the near word of the largest n with that n, for all
    words of the ``vocabulary`` (word, n) that have a near one."""
    total = vocabulary.count()
    levels = min(GROUPS, max(0, math.ceil(math.log(max(1, total) / homes, 3))))
    rows = routed(vocabulary, levels)
    crowd = rows.groupBy("shard").agg(F.count(F.when(F.col("home"), 1)).alias("n_homes"), F.count("*").alias("n_queries"))
    h_parts, q_parts = F.ceil(F.col("n_homes") / home_block).cast("long"), F.ceil(F.col("n_queries") / query_block).cast("long")
    crowd = materialise(  # without the shards where nobody is at home
        crowd.where("n_homes > 0").select("shard", h_parts.alias("hp"), q_parts.alias("qp")), "spelling-shards"
    )
    packs, large = max(1, math.ceil(total / homes)), (F.col("hp") > 1) | (F.col("qp") > 1)
    placed = rows.join(crowd, "shard").withColumn("large", large)
    placed = placed.withColumn("pack", F.when(F.col("large"), F.col("shard")).otherwise(F.pmod(F.xxhash64("shard"), F.lit(packs))))
    cols = ("large", "pack", "shard", "word", "n", "home", "deficit")
    zero, yes, no = F.lit(0).cast("long"), F.lit(True), F.lit(False)
    own_h, own_q = F.pmod(F.xxhash64("word"), "hp"), F.pmod(F.xxhash64("word"), "qp")
    # a small shard's words ask and are held in one call; a large one's are held in their block and ask in every block
    small = F.array(F.struct(F.col("home").alias("held"), yes.alias("asks"), zero.alias("h"), zero.alias("q")))
    asking = F.transform(F.sequence(zero, F.col("hp") - 1), lambda h: F.struct(no.alias("held"), yes.alias("asks"), h.alias("h"), own_q.alias("q")))
    holding = F.transform(F.sequence(zero, F.col("qp") - 1), lambda q: F.struct(yes.alias("held"), no.alias("asks"), own_h.alias("h"), q.alias("q")))
    places = F.when(F.col("large"), F.when(F.col("home"), F.concat(asking, holding)).otherwise(asking)).otherwise(small)
    met = placed.select(*cols, F.inline(places)).groupBy("large", "pack", "h", "q").applyInArrow(
        _nearest(levels), "word string, n_near long, near_n long, near string"
    )
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near")))
    return met.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", (-F.col("b.less")).alias("near_n"), F.col("b.near").alias("near")
    )


def roots(forms: DataFrame) -> DataFrame:
    """word and root: ``forms`` (word, form) followed to the last. A form is
    at least ten times as frequent as its word, so chains end; each round
    doubles the steps."""
    to = materialise(forms.select("word", F.col("form").alias("root")), "spelling-forms")
    while True:
        on = to.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ahead = materialise(
            to.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "spelling-roots",
        )
        to = ahead.select("word", "root")
        if ahead.where("moved").isEmpty():
            return to


def variants(docs: DataFrame, least: int = LEAST, times: int = 2, ratio: int = 10) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of ``docs``."""
    vocabulary = materialise(words(docs, least, times), "spelling-words")
    found = vocabulary.join(near(vocabulary), "word", "left")
    ok = F.col("near_n") >= ratio * F.col("n")
    judged = materialise(
        found.select(
            "word", F.when(ok, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(ok, F.col("near_n")).alias("form_n"),
        ),
        "spelling-judged",
    )
    last = roots(judged.where("form IS NOT NULL").select("word", "form"))
    return judged.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
