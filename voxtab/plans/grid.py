"""All pairs of vectors in a grid of few large blocks.

Points are hashed into blocks, and every pair of blocks meets in one call of a
kernel, so a vector is shuffled once for each partner block. ``block_count``
keeps the number of blocks at ``GRID`` until a block would hold more than
``MOST`` vectors: up to ``GRID * MOST`` points the shuffled volume grows with
the points, not with their square, and a call's memory stays bounded beyond.
Vectors travel as packed chunks in their own precision. Where some points are
``done`` with one another (their pairs are known already), only the blocks of
the others meet all blocks.

A kernel walks its pair of blocks in tiles of ``TILE`` cells, so no matrix of
all its pairs is ever held."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Blocks of a side, and the least and most vectors of a block.
GRID, LEAST, MOST = 24, 256, 1 << 15
#: Cells of a distance matrix that are held at a time, and of sums by cluster.
TILE, SUMS = 1 << 20, 1 << 23
#: Rows of an output batch.
_OUT = 1 << 14


class Block:
    """Ids, labels and vectors of one side of a call."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vecs: np.ndarray):
        self.ids, self.labels, self.vecs = ids, labels, vecs

    def __len__(self) -> int:
        return len(self.ids)

    def take(self, at) -> Block:
        return Block(self.ids[at], self.labels[at], self.vecs[at])


def block_count(n: int, least: int = LEAST, grid: int = GRID, most: int = MOST) -> int:
    """Blocks for ``n`` points: so many that one holds ``least``, but ``grid``
    at most unless one would hold more than ``most``."""
    return max(math.ceil(n / most), min(grid, math.ceil(n / least)))


def chunks(points: DataFrame) -> DataFrame:
    """``(id, label, vec, blk)`` -> rows of packed vectors of one block."""
    single = points.schema["vec"].dataType.elementType == T.FloatType()
    kind = np.float32 if single else np.float64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            ids, labels, blk = (b.column(i).to_numpy() for i in (0, 1, 3))
            vecs = b.column(2).flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(b.num_rows, -1)
            order = np.argsort(blk, kind="stable")
            starts = np.r_[0, np.flatnonzero(np.diff(blk[order])) + 1, len(order)]
            parts = [order[s:e] for s, e in zip(starts, starts[1:], strict=False)]
            packed = [pa.array([x[p].tobytes() for p in parts], pa.binary()) for x in (ids, labels, vecs)]
            yield pa.RecordBatch.from_arrays([pa.array([int(blk[p[0]]) for p in parts], pa.int64()), *packed], names=["blk", "ids", "labels", "vecs"])

    plain = points.select(*(F.col(c).cast("bigint").alias(c) for c in ("id", "label")), "vec", F.col("blk").cast("bigint").alias("blk"))
    return plain.mapInArrow(run, "blk long, ids binary, labels binary, vecs binary")


def dealt(points: DataFrame, asking: int, done: int = 0, done_if: Column | None = None) -> DataFrame:
    """Chunks of ``points (id, label, vec)`` for every call ``(lo, hi)``:
    ``asking`` blocks that meet all blocks, and ``done`` blocks, of the points
    with ``done_if``, that meet only those."""
    h = F.xxhash64("id")
    blk = F.pmod(h, F.lit(max(1, asking)))
    if done_if is not None:
        blk = F.when(done_if, asking + F.pmod(h, F.lit(max(1, done)))).otherwise(blk)
    packed = chunks(points.select("id", "label", "vec", blk.alias("blk")))
    last = F.when(F.col("blk") < asking, F.lit(asking + done - 1)).otherwise(F.lit(asking - 1))
    met = packed.withColumn("with", F.explode(F.sequence(F.lit(0).cast("bigint"), last.cast("bigint"))))
    return met.select(F.least("blk", "with").alias("lo"), F.greatest("blk", "with").alias("hi"), "blk", "ids", "labels", "vecs")


def _held(rows: list, kind: np.dtype) -> Block:
    ids, labels, vecs = (b"".join(r[i] for r in rows) for i in range(3))
    n = len(ids) // 8
    flat = np.frombuffer(vecs, kind)
    return Block(np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64), flat.reshape(n, -1).astype(np.float64))


def calls(met: DataFrame, single: bool, kernel: Callable[[Block, Block | None], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``kernel(a, b)`` for every pair of blocks; ``b`` is None where a block
    meets itself."""
    kind = np.dtype(np.float32 if single else np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, diagonal = [], [], False
        for batch in batches:
            for lo, hi, blk, *rest in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                diagonal = lo == hi
                (a if blk == lo else b).append(rest)
        if a and (b or diagonal):
            yield from kernel(_held(a, kind), None if diagonal else _held(b, kind))

    return met.groupBy("lo", "hi").applyInArrow(run, schema)


def is_single(points: DataFrame) -> bool:
    return points.schema["vec"].dataType.elementType == T.FloatType()


def _unit(x: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, length, out=np.zeros_like(x), where=length > 0)


def _tiles(n: int, width: int) -> Iterator[slice]:
    step = max(1, TILE // max(1, width))
    for i in range(0, n, step):
        yield slice(i, min(n, i + step))


def cosine_extremes(points: DataFrame, blocks: int) -> DataFrame:
    """``(dmin, dmax)`` per call: least and largest cosine distance of the
    pairs of ``points (id, label, vec)``; zero vectors are at distance 1."""

    def kernel(a: Block, b: Block | None) -> Iterator[pa.RecordBatch]:
        u = _unit(a.vecs)
        v = u if b is None else _unit(b.vecs)
        low, high = [], []
        for s in _tiles(len(u), len(v)):
            dots = u[s] @ (v if b is not None else v[s.start :]).T
            parts = [dots]
            if b is None:  # i < j
                k = len(dots)
                parts = [dots[:, :k][np.triu_indices(k, 1)], dots[:, k:]]
            low += [p.min() for p in parts if p.size]
            high += [p.max() for p in parts if p.size]
        if low:
            d = np.clip(1.0 - np.array([max(high), min(low)]), 0.0, 2.0)
            yield pa.RecordBatch.from_arrays([pa.array(d[:1]), pa.array(d[1:])], names=["dmin", "dmax"])

    return calls(dealt(points, blocks), is_single(points), kernel, "dmin double, dmax double")


def _sums(a: Block, b: Block, same: bool) -> Iterator[pa.RecordBatch]:
    """Sums of the distances of each point of ``a`` to the clusters of ``b``,
    and the other way round unless ``same``. Both are sorted by label."""
    ka, kb = len(np.unique(a.labels)), len(np.unique(b.labels))
    if len(a) * kb + len(b) * ka > SUMS and max(len(a), len(b)) > 1:  # many clusters: in parts
        if len(a) >= len(b):
            cut = len(a) // 2
            parts = [(a.take(slice(0, cut)), b), (a.take(slice(cut, None)), b)]
        else:
            cut = len(b) // 2
            parts = [(a, b.take(slice(0, cut))), (a, b.take(slice(cut, None)))]
        for x, y in parts:
            yield from _sums(x, y, same)
        return
    clusters_a, clusters_b = np.unique(a.labels), np.unique(b.labels)
    starts_b = np.searchsorted(b.labels, clusters_b)
    to_b, to_a = np.zeros((len(a), kb)), np.zeros((0 if same else len(b), ka))
    aa, bb = (a.vecs * a.vecs).sum(1), (b.vecs * b.vecs).sum(1)
    for s in _tiles(len(a), len(b)):
        d = a.vecs[s] @ b.vecs.T
        d *= -2.0
        d += aa[s, None]
        d += bb[None, :]
        np.maximum(d, 0.0, out=d)
        np.sqrt(d, out=d)
        if same:
            d[a.ids[s][:, None] == b.ids[None, :]] = 0.0
        to_b[s] = np.add.reduceat(d, starts_b, axis=1)
        if not same:
            some, starts = np.unique(a.labels[s], return_index=True)
            to_a[:, np.searchsorted(clusters_a, some)] += np.add.reduceat(d, starts, axis=0).T
    for x, other, clusters, sums in ((a, b, clusters_b, to_b), (b, a, clusters_a, to_a)):
        k, sizes = len(clusters), np.unique(other.labels, return_counts=True)[1].astype(np.int32)
        step = max(1, (_OUT * 16) // k)
        for i in range(0, len(sums), step):
            some = sums[i : i + step]
            ends = pa.array(np.arange(len(some) + 1, dtype=np.int32) * k)
            lists = [pa.ListArray.from_arrays(ends, pa.array(v)) for v in (np.tile(clusters, len(some)), some.ravel(), np.tile(sizes, len(some)))]
            names = ["id", "own", "clusters", "totals", "sizes"]
            yield pa.RecordBatch.from_arrays([pa.array(x.ids[i : i + step]), pa.array(x.labels[i : i + step]), *lists], names=names)


def distance_sums(points: DataFrame, blocks: int) -> DataFrame:
    """``(id, own, cluster, total, n)``: the sum of the Euclidean distances of
    each of ``points (id, label, vec)`` to each cluster, and the cluster's size."""

    def kernel(a: Block, b: Block | None) -> Iterator[pa.RecordBatch]:
        a = a.take(np.argsort(a.labels, kind="stable"))
        b = a if b is None else b.take(np.argsort(b.labels, kind="stable"))
        yield from _sums(a, b, a is b)

    kind = "id long, own long, clusters array<long>, totals array<double>, sizes array<int>"
    parts = calls(dealt(points, blocks), is_single(points), kernel, kind)
    # one row a point and call is shuffled; the sums of a point then lie together
    lies = parts.repartition("id").select("id", "own", F.explode(F.arrays_zip("clusters", "totals", "sizes")).alias("s"))
    return lies.groupBy("id", "own", F.col("s.clusters").alias("cluster")).agg(F.sum("s.totals").alias("total"), F.sum("s.sizes").alias("n"))
