"""Ranked lexical search: the best documents for every query of a stated set,
by integer BM25-like scores, exact.

The index is built where the documents lie: every ``rows`` documents of a
partition form a shard with a forward index (a vector of impacts per document)
and a posting list per term. Each posting list is cut into blocks by document
similarity: evenly spaced documents of the list are pivots and every other
one joins the pivot with the most similar vector (cosine over all query
terms). A block stores the coordinatewise maximum of the vectors of its
documents. The inner product of a query with that summary is an upper bound
of the score of every document of the block, so a query visits the blocks of
its terms by falling bound, scores their documents from the forward index, and
stops at the first bound below its current k-th best score; blocks with an
equal bound are still visited, for ties go to the smaller id. All bounds and
scores are 64-bit integers, so a skip never loses a result.

The best scores so far go along through the shards of a task, whose best rows
are merged by salted windows. Nothing is shuffled but ``k`` rows per query and
task. Posting lists hold the terms of the queries only; the vocabulary of a
batch of queries is bounded by ``VOCABULARY`` (one query alone may exceed it,
then shards get smaller), and only the terms' document frequencies and two
totals come to the driver. All statistics count all documents.

A term is a maximal run of ASCII letters, digits and characters beyond ASCII,
only A-Z lower-cased. With N documents that hold a term, L terms in all, n in
a document, tf of a term in it and df documents that hold the term, the term
weighs ``floor(1000 * ln((2N + 2) / (2df + 1)))``, its impact in a document is
``10**9 * tf div (1000 * tf + 8 * m)`` with ``m = 100 - b + (b * n * N) div L``,
and a score sums weight times impact over the query's terms with repeats.

Defined cases: a null text, or one without a term, neither ranks nor counts;
such a query has no result. Rows with a null doc_id rank behind equal scores
with one. Repeated documents rank one after another, repeated queries each get
their results. An empty table on either side gives an empty result. Other
columns are ignored."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxtab.llm.common import add_columns, materialise, require

#: Length normalisation in hundredths, results per query.
B, K = 75, 10
#: Documents per block, cells of a shard's forward index, documents of a shard at most.
BLOCK, CELLS, ROWS = 16, 1 << 22, 1024
#: Terms and queries of a batch.
VOCABULARY, QUERIES = 8192, 1024
#: Parts that the best rows of all tasks are merged in first.
SALT = 64
#: Bytes that end a term: ASCII but for digits and letters.
_BREAKS = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().translate(_BREAKS).split()


def batches(queries: DataFrame) -> Iterator[list[tuple[object, Counter]]]:
    """The queries (item_id, term counts) in batches of a bounded vocabulary."""
    batch, held = [], set()
    for row in queries.toLocalIterator():
        asked = Counter(terms(row[1]))
        if batch and (len(held | asked.keys()) > VOCABULARY or len(batch) >= QUERIES):
            yield batch
            batch, held = [], set()
        batch.append((row[0], asked))
        held |= asked.keys()
    if batch:
        yield batch


def vectors(docs: DataFrame, number: dict[bytes, int]) -> DataFrame:
    """doc_id, n_terms and the query terms (numbers, counts) of every row."""
    ints = T.ArrayType(T.IntegerType())
    fields = [T.StructField("n_terms", T.LongType()), T.StructField("terms", ints), T.StructField("counts", ints)]
    known = number.keys()

    def compute(texts: pa.Array) -> list[pa.Array]:
        sizes, which, times = [], [], []
        for t in texts:
            found = terms(t.as_py())
            c = Counter(found)
            hit = c.keys() & known
            sizes.append(len(found))
            which.append([number[x] for x in hit])
            times.append([c[x] for x in hit])
        return [pa.array(sizes, pa.int64()), pa.array(which, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int32()))]

    return add_columns(docs.select("doc_id", "text"), "text", fields, lambda: compute).drop("text")


def blocks(lists: list[np.ndarray], alike: np.ndarray, size: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(documents, start of each block, term of each block): every posting
    list cut around its pivots; ``alike`` holds the similarities."""
    docs, starts, owner, at = [], [], [], 0
    for term, held in enumerate(lists):
        if len(held) > size:
            nearest = alike[np.ix_(held, held[::size])].argmax(axis=1)
            order = np.argsort(nearest, kind="stable")
            cuts = np.r_[0, np.flatnonzero(np.diff(nearest[order])) + 1]
            docs.append(held[order])
        else:
            cuts = np.zeros(min(1, len(held)), np.int64)
            docs.append(held)
        starts.append(cuts + at)
        owner.append(np.full(len(cuts), term))
        at += len(held)
    return np.concatenate(docs), np.concatenate(starts), np.concatenate(owner)


def summaries(impacts: np.ndarray, docs: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Coordinatewise maxima of the blocks, some blocks at a time."""
    ends = np.r_[starts[1:], len(docs)]
    out = np.empty((len(starts), impacts.shape[1]), impacts.dtype)
    step = max(1, CELLS // (BLOCK * max(1, impacts.shape[1])))
    for i in range(0, len(starts), step):
        lo, hi = starts[i], ends[min(i + step, len(starts)) - 1]
        out[i : i + step] = np.maximum.reduceat(impacts[docs[lo:hi]], starts[i : i + step] - lo, axis=0)
    return out


class Best:
    """The k best (score, document) of a query so far; None is behind all ids."""

    def __init__(self, k: int):
        self.k, self.rows, self.least = k, [], 1

    def offer(self, scores: np.ndarray, ids: list) -> None:
        self.rows += [(-int(s), i is None, i or 0) for s, i in zip(scores, ids, strict=True) if s >= self.least]
        self.rows.sort()
        del self.rows[self.k :]
        if len(self.rows) == self.k:
            self.least = -self.rows[-1][0]


class Shard:
    """Forward index, posting lists in blocks, and summaries of some documents."""

    def __init__(self, ids: list, impacts: np.ndarray, weight: np.ndarray):
        self.ids = np.array(ids, object)
        self.active = np.flatnonzero(impacts.any(axis=0))
        self.place = np.full(impacts.shape[1], -1)
        self.place[self.active] = np.arange(len(self.active))
        self.impacts = np.ascontiguousarray(impacts[:, self.active])
        unit = self.impacts * weight[self.active].astype(np.float32)
        unit /= np.maximum(np.linalg.norm(unit, axis=1, keepdims=True), 1e-9)
        held = [np.flatnonzero(c) for c in (self.impacts > 0).T]
        self.docs, self.starts, owner = blocks(held, unit @ unit.T)
        self.ends = np.r_[self.starts[1:], len(self.docs)]
        self.first = np.searchsorted(owner, np.arange(len(self.active) + 1))  # blocks of each term
        self.most = summaries(self.impacts, self.docs, self.starts)
        self.visited = 0

    def search(self, asked: np.ndarray, worth: np.ndarray, best: Best) -> None:
        """Improves ``best`` by the documents that the query's terms
        ``asked``, of weight ``worth`` each, may rank."""
        at = self.place[asked]
        at, worth = at[at >= 0], worth[at >= 0]
        if not len(at):
            return
        own = np.concatenate([np.arange(self.first[t], self.first[t + 1]) for t in at])
        bound = self.most[own][:, at] @ worth
        able = bound >= best.least
        own, bound = own[able], bound[able]
        order = np.argsort(-bound, kind="stable")
        seen = np.zeros(len(self.ids), bool)
        for i in self._runs(len(order)):
            some = order[i]
            some = some[bound[some] >= best.least]  # an exact bound below the k-th best score
            if not len(some):
                break
            self.visited += len(some)
            docs = np.unique(np.concatenate([self.docs[self.starts[b] : self.ends[b]] for b in own[some]]))
            docs = docs[~seen[docs]]
            seen[docs] = True
            scores = self.impacts[docs][:, at] @ worth
            good = scores >= best.least
            best.offer(scores[good], self.ids[docs[good]].tolist())

    @staticmethod
    def _runs(n: int) -> Iterator[slice]:
        """The first block, then twice as many each time up to 64."""
        at, step = 0, 1
        while at < n:
            yield slice(at, at + step)
            at, step = at + step, min(64, 2 * step)


def top(vecs: DataFrame, asked: list[Counter], number: dict[bytes, int], weight: np.ndarray, n_docs: int, n_terms: int, k: int = K, b: int = B) -> DataFrame:
    """query, doc_id, score: at least the k best documents of each query."""
    wanted = []
    for q in asked:
        some = np.array([number[x] for x in q], np.int64)
        wanted.append((some, weight[some] * np.array(list(q.values()), np.int64)))
    width = len(number)
    rows = max(16, min(ROWS, CELLS // max(1, width)))
    id_type = vecs.schema["doc_id"].dataType

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in wanted]
        ids, cells, sizes = [], [], []

        def close():
            owner = np.repeat(np.arange(len(ids)), [len(c[0]) for c in cells])
            which, times = (np.concatenate([c[i] for c in cells]).astype(np.int64) for i in (0, 1))
            m = 100 - b + (b * np.array(sizes, np.int64) * n_docs) // n_terms
            impacts = np.zeros((len(ids), width), np.int32)
            impacts[owner, which] = 1000000000 * times // (1000 * times + 8 * m[owner])
            shard = Shard(ids, impacts, weight)
            for (some, worth), found in zip(wanted, best, strict=True):
                shard.search(some, worth, found)
            ids.clear(), cells.clear(), sizes.clear()

        for batch in stream:
            which, times = batch.column(2), batch.column(3)
            for i, (doc, n) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                ids.append(doc), sizes.append(n)
                cells.append((which[i].values.to_numpy(), times[i].values.to_numpy()))
                if len(ids) == rows:
                    close()
        if ids:
            close()
        flat = [(q, None if none else i, -s) for q, found in enumerate(best) for s, none, i in found.rows]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in flat], pa.int32()), pa.array([r[1] for r in flat], pa.int64()), pa.array([r[2] for r in flat], pa.int64())],
            names=["query", "doc_id", "score"],
        )

    some = vecs.where(F.size("terms") > 0).select(F.col("doc_id").cast("long"), "n_terms", "terms", "counts")
    found = some.mapInArrow(run, "query int, doc_id long, score long")
    return found.withColumn("doc_id", F.col("doc_id").cast(id_type))


def search(docs: DataFrame, queries: DataFrame, k: int = K, b: int = B) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents (doc_id, an
    integer, and text) with a score above zero for each row of ``queries``
    (item_id, text)."""
    require(docs, ["doc_id", "text"])
    require(queries, ["item_id", "text"])
    spark = docs.sparkSession
    results = []
    for batch in batches(queries.select("item_id", "text")):
        number = {t: i for i, t in enumerate(sorted(set().union(*[q.keys() for _, q in batch])))}
        vecs = materialise(vectors(docs, number), "search-vectors")
        n_docs, n_terms = vecs.agg(F.count(F.when(F.col("n_terms") > 0, 1)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
        if not n_terms:
            continue
        df = np.zeros(len(number))
        for term, count in vecs.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # a row per query term at most
            df[term] = count
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df], np.int64)
        found = top(vecs, [q for _, q in batch], number, weight, n_docs, n_terms, k, b)
        ranked = Window.orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        parted = found.withColumn("part", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALT)))
        parted = parted.withColumn("r", F.row_number().over(ranked.partitionBy("query", "part"))).where(F.col("r") <= k)
        last = parted.withColumn("rank", F.row_number().over(ranked.partitionBy("query"))).where(F.col("rank") <= k)
        named = spark.createDataFrame(
            [(i, item) for i, (item, _) in enumerate(batch)],
            T.StructType([T.StructField("query", T.IntegerType()), T.StructField("item_id", queries.schema["item_id"].dataType)]),
        )
        results.append(last.join(named, "query").select("item_id", F.col("rank").cast("int"), "doc_id", "score"))
    if not results:
        schema = [queries.schema["item_id"], T.StructField("rank", T.IntegerType()), docs.schema["doc_id"], T.StructField("score", T.LongType())]
        return spark.createDataFrame([], T.StructType(schema))
    return reduce(DataFrame.unionByName, results)
