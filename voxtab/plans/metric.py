"""Neighbour links among unit vectors by exact metric-space partitioning.

``dist = 1 - u.v <= eps`` on unit vectors is a ball of radius
``r = sqrt(2 * eps)`` in the Euclidean metric, so the triangle inequality
prunes:

1. **Cells.** A bounded set of pivots (data points at least ``r / 2`` apart,
   from a sample dealt by hash) is compared with every vector; the nearest one
   is its cell, its distance to it the shell inside the cell. Pivots only
   steer the work, never the result.
2. **Linked for free.** A vector within ``eps`` of its pivot is linked to it,
   and pivots that share such a vector are linked too. All that hang together
   this way carry one label, so a crowded blob costs one comparison a vector
   and pivot however many vectors it holds.
3. **Visits.** A vector visits a shell of a cell only if the shell can hold a
   neighbour: its distance to the pivot is within ``r`` of the shell's least
   and largest distance, and it lies within ``r`` of the bisector of the two
   pivots. Of two shells the one with the smaller number visits. A visit is
   left out where everyone involved carries one label already.
4. **Blocks.** A crowded shell is cut into blocks of held and asking vectors,
   and each pair of blocks is one call of the kernel (a matrix product) that
   returns a spanning forest of the labels it links.

5. **Seeds.** Where visits would send a vector to more than ``FEW`` calls,
   those outside the largest crowd first meet a bounded sample of that crowd,
   so that one without clear centres is linked too.
6. **Rest.** Where visits prune too little, the vectors outside the largest
   crowd meet all vectors in a grid of few large blocks
   (``voxtab.plans.grid``); only the pairs inside that crowd are left out. The
   way that shuffles fewer vectors is taken, from their exact counts.

On separated blobs the number of shuffled vectors grows with n; on vectors
without any structure each is sent once for each large block."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtab.plans.graph import connected_components
from voxtab.plans.grid import Block, _tiles, block_count, calls, dealt
from voxtab.plans.pairs import _components_small
from voxtab.session import bounded_table, cut_lineage

#: Sampled vectors, pivots at most, shells of a cell at most.
SAMPLE, PIVOTS, SHELLS = 4096, 1024, 16
#: Held vectors of a kernel call; twice as many ask.
HELD = 1024
#: Vectors of the largest crowd that all others meet, and the copies of a vector that are few.
SEEDS, FEW = 1 << 14, 3
_TOL = 1e-6


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def unit_vectors(vecs: DataFrame, id_col: str, vec: str) -> DataFrame:
    """``(id, u)``: vectors of length one; zero vectors stay zero."""
    x = F.col(vec).cast("array<double>")
    norm = F.sqrt(F.aggregate(x, F.lit(0.0), lambda s, v: s + v * v))
    some = vecs.select(F.col(id_col).cast("bigint").alias("id"), x.alias("x"), norm.alias("norm"))
    return some.select("id", F.when(F.col("norm") > 0, F.transform("x", lambda v: v / F.col("norm"))).otherwise(F.col("x")).alias("u"))


def net(sample: np.ndarray, apart: float, most: int) -> np.ndarray:
    """Places of rows of ``sample`` that are more than ``apart`` from all
    earlier ones, ``most`` at most."""
    far, chosen = np.full(len(sample), np.inf), []
    for i in range(len(sample)):
        if far[i] <= apart:
            continue
        chosen.append(i)
        if len(chosen) == most:
            break
        far = np.minimum(far, _chord(sample @ sample[i]))
    return np.array(chosen, np.int64)


def _chord(dots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * dots, 0.0))


class Partition:
    """Pivots, and once they are known the shells of their cells."""

    def __init__(self, ids: np.ndarray, pivots: np.ndarray, eps: float):
        self.ids, self.pivots, self.eps = ids, pivots, eps
        self.radius = math.sqrt(2 * eps)
        self.width = max(self.radius / 4, 2.0 / SHELLS)
        self.between = _chord(pivots @ pivots.T)
        self.root = np.arange(len(ids))

    def place(self, u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
        """Cell, distance, whether linked to the pivot, other linked pivots."""
        dots = u @ self.pivots.T
        cell = dots.argmax(axis=1)
        rows = np.arange(len(u))
        near = np.clip(1.0 - dots, 0.0, 2.0) <= self.eps
        linked = near[rows, cell]
        near[rows, cell] = False
        near[~linked] = False
        return cell, _chord(dots[rows, cell]), linked, [np.flatnonzero(x) for x in near]

    def join(self, pairs: np.ndarray) -> None:
        """Pivots that hang together get one root."""
        if len(pairs):
            self.root = _components_small(len(self.ids), pairs[:, 0], pairs[:, 1])

    def shells(self, cell, shell, least, most, linked) -> None:
        order = np.lexsort((shell, cell))
        self.cell, self.shell = cell[order], shell[order]
        self.least, self.most, self.linked = least[order], most[order], linked[order]
        self.number = {(int(c), int(s)): i for i, (c, s) in enumerate(zip(self.cell, self.shell, strict=True))}

    def label(self, ids: np.ndarray, cell: np.ndarray, linked: np.ndarray) -> np.ndarray:
        return np.where(linked, self.ids[self.root[cell]], ids)

    def visits(self, u: np.ndarray, cell: np.ndarray, home: np.ndarray, linked: np.ndarray) -> np.ndarray:
        """(vectors, shells): which shells each vector must visit."""
        d = _chord(u @ self.pivots.T)
        own = d[np.arange(len(u)), cell]
        to = d[:, self.cell]
        r = self.radius + _TOL
        able = (to - r <= self.most) & (to + r >= self.least)
        # within r of the bisector of both pivots, else no neighbour is nearer to the other pivot
        able &= (d**2 - own[:, None] ** 2 <= 2 * r * self.between[cell] + _TOL)[:, self.cell]
        able &= np.arange(len(self.cell)) >= home[:, None]
        return able & ~(linked[:, None] & self.linked & (self.root[self.cell] == self.root[cell][:, None]))


def partition(units: DataFrame, n: int, eps: float) -> Partition:
    """Pivots from a bounded sample of ``(id, u)``."""
    table = bounded_table(units.orderBy(F.xxhash64("id"), "id").limit(SAMPLE), SAMPLE)
    sample = matrix(table["u"].combine_chunks())
    at = net(sample, math.sqrt(2 * eps) / 2, max(1, min(PIVOTS, math.ceil(math.sqrt(n)))))
    return Partition(table["id"].to_numpy()[at], sample[at], eps)


def placed(units: DataFrame, part: Partition) -> DataFrame:
    """``(id, u, cell, shell, d, linked, others)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 1024):
                b = whole.slice(i, 1024)
                cell, d, linked, others = part.place(matrix(b.column(1)))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(cell.astype(np.int32)), pa.array((d / part.width).astype(np.int32)), pa.array(d),
                     pa.array(linked), pa.array([x.astype(np.int32) for x in others], pa.list_(pa.int32()))],
                    names=["id", "u", "cell", "shell", "d", "linked", "others"],
                )

    return units.mapInArrow(run, "id long, u array<double>, cell int, shell int, d double, linked boolean, others array<int>")


def _routes(points: DataFrame, part: Partition, parts: np.ndarray | None = None) -> DataFrame:
    """Without ``parts``: ``(shell_no, asking, holding)``, counts. With the
    blocks (held, asking) of every shell: the vectors themselves, once for
    each kernel call that they take part in."""

    def pieces(whole: pa.RecordBatch) -> Iterator:
        for i in range(0, whole.num_rows, 256):
            b = whole.slice(i, 256)
            ids, cell = b.column(0).to_numpy(), b.column(2).to_numpy().astype(np.int64)
            linked = np.array(b.column(5).to_pylist(), bool)
            home = np.array([part.number[x] for x in zip(cell.tolist(), b.column(3).to_pylist(), strict=True)], np.int64)
            yield b, ids, part.label(ids, cell, linked), home, part.visits(matrix(b.column(1)), cell, home, linked)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asking, holding = (np.zeros(len(part.cell), np.int64) for _ in range(2))
        for whole in batches:
            for _, _, _, home, able in pieces(whole):
                asking += able.sum(axis=0)
                np.add.at(holding, home, 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(asking))), pa.array(asking), pa.array(holding)], names=["shell_no", "asking", "holding"]
        )

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b, ids, label, home, able in pieces(whole):
                mixed = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
                out = []
                for held, rows, shell in ((False, *np.nonzero(able)), (True, np.arange(len(ids)), home)):
                    own, other = parts[shell, 0 if held else 1], parts[shell, 1 if held else 0]
                    rows, shell, own, other = (x[(own > 0) & (other > 0)] for x in (rows, shell, own, other))  # nobody asks: nobody is sent
                    mine = (mixed[rows] % own.astype(np.uint64)).astype(np.int64)
                    again = np.repeat(np.arange(len(rows)), other)
                    partner = np.arange(len(again)) - np.repeat(np.cumsum(other) - other, other)
                    h, q = (mine[again], partner) if held else (partner, mine[again])
                    out.append((rows[again], shell[again], h, q, np.full(len(again), held)))
                rows, shell, h, q, held = (np.concatenate(x) for x in zip(*out, strict=True))
                for i in range(0, len(rows), 4096):  # as many copies at a time
                    s = slice(i, i + 4096)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(shell[s]), pa.array(h[s]), pa.array(q[s]), pa.array(held[s]), pa.array(label[rows[s]]), b.column(1).take(pa.array(rows[s]))],
                        names=["shell_no", "h", "q", "held", "label", "u"],
                    )

    if parts is None:
        return points.mapInArrow(count, "shell_no long, asking long, holding long").groupBy("shell_no").agg(
            F.sum("asking").alias("asking"), F.sum("holding").alias("holding")
        )
    return points.mapInArrow(send, "shell_no long, h long, q long, held boolean, label long, u array<double>")


def _parts(points: DataFrame, part: Partition, held: int) -> tuple[np.ndarray, int]:
    """Blocks (held, asking) of every shell, and the vectors that ``routes``
    would send."""
    parts, sent = np.zeros((len(part.cell), 2), np.int64), 0
    for row in bounded_table(_routes(points, part), len(part.cell)).to_pylist():  # a row per shell
        h, q = math.ceil(row["holding"] / held), math.ceil(row["asking"] / (2 * held))
        parts[row["shell_no"]] = h, q
        sent += row["holding"] * q + row["asking"] * h
    return parts, sent


def routes(points: DataFrame, part: Partition, held: int = HELD) -> DataFrame:
    """Vectors of ``points`` for every kernel call: ``(shell_no, h, q, held,
    label, u)``. The row count is the number of shuffled vectors."""
    return _routes(points, part, _parts(points, part, held)[0])


def crowd(points: DataFrame, part: Partition) -> int:
    """The label that most linked vectors carry (-1: none is linked)."""
    linked = points.where("linked").groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    t = bounded_table(linked, len(part.ids))  # a row per pivot
    if not t.num_rows:
        return -1
    sizes = np.bincount(part.root[t["cell"].to_numpy()], t["n"].to_numpy(), len(part.ids))
    return int(part.ids[sizes.argmax()])


def seeded(points: DataFrame, part: Partition, eps: float, most: int) -> DataFrame:
    """``(id, label, vec, was)``: vectors near a seed, one of a bounded sample
    of the label ``most``, carry that label; ``was``: what they carried, if
    others may carry it too."""

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            linked = np.array(b.column(3).to_pylist(), bool)
            label = part.label(b.column(0).to_numpy(), b.column(2).to_numpy().astype(np.int64), linked)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(label), b.column(1), b.column(3)], names=["id", "label", "vec", "linked"])

    table = points.select("id", "u", "cell", "linked").mapInArrow(named, "id long, label long, vec array<double>, linked boolean")
    inside = F.col("label") == most
    size = table.where(inside).count()
    share = 0.9 * SEEDS / max(1, size)
    place = F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(1 << 30)) / float(1 << 30)
    seeds = matrix(bounded_table(table.where(inside & (place < share)).select("vec").limit(SEEDS), SEEDS)["vec"].combine_chunks())
    shared = points.sparkSession.sparkContext.broadcast(seeds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = shared.value
        for whole in batches:
            for first in range(0, whole.num_rows, 1024):
                b = whole.slice(first, 1024)
                label, linked, u = b.column(1).to_numpy().copy(), np.array(b.column(3).to_pylist(), bool), matrix(b.column(2))
                left, was = np.flatnonzero(label != most), np.full(len(label), -1)
                for i in range(0, len(seeds), 1024):
                    if not len(left):
                        break
                    near = (1.0 - u[left] @ seeds[i : i + 1024].T <= eps).any(axis=1)
                    hit = left[near]
                    was[hit], label[hit] = np.where(linked[hit], label[hit], -1), most
                    left = left[~near]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(label), b.column(2), pa.array(was, mask=was == -1)], names=["id", "label", "vec", "was"]
                )

    try:
        return cut_lineage(table.mapInArrow(run, "id long, label long, vec array<double>, was long"))
    finally:
        shared.destroy()


def _links(eps: float):
    """Links between the labels of two blocks, as a spanning forest."""

    def run(a: Block, b: Block | None) -> Iterator[pa.RecordBatch]:
        b = a if b is None else b
        nodes = np.unique(np.concatenate([a.labels, b.labels]))
        la, lb = np.searchsorted(nodes, a.labels), np.searchsorted(nodes, b.labels)
        root = np.arange(len(nodes))
        for s in _tiles(len(la), len(lb)):
            of_a, of_b = root[la[s]], root[lb]
            most = np.bincount(of_b).argmax()  # pairs inside the largest component are left out
            for rows, cols in ((np.flatnonzero(of_a != most), slice(None)), (np.flatnonzero(of_a == most), np.flatnonzero(of_b != most))):
                x, y = of_a[rows], of_b[cols]
                if not len(x) or not len(y):
                    continue
                i, j = np.nonzero((1.0 - a.vecs[s][rows] @ b.vecs[cols].T <= eps) & (x[:, None] != y[None, :]))
                if len(i):
                    pair = np.unique(x[i] * len(nodes) + y[j])
                    joined = _components_small(len(nodes), root[pair // len(nodes)], root[pair % len(nodes)])
                    root = joined[root]
        far = np.flatnonzero(root != np.arange(len(nodes)))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[far]), pa.array(nodes[root[far]])], names=["src", "dst"])

    return run


def rest_links(marked: DataFrame, most: int, n: int, eps: float, sent: int) -> DataFrame | None:
    """Links ``(src, dst)`` between the labels of ``marked``: the vectors
    outside the label ``most`` meet all. None if that would shuffle more than
    ``sent`` vectors."""
    inside = F.col("label") == most
    outside = marked.where(~inside).count()
    asking, done = block_count(outside, least=4096), block_count(n - outside)
    if outside * (asking + done) + (n - outside) * asking > sent:
        return None
    links = calls(dealt(marked, asking, done, inside), False, _links(eps), "src long, dst long")
    was = marked.where("was IS NOT NULL").select(F.col("was").alias("src"), F.lit(most).cast("long").alias("dst"))
    return links.unionByName(was)


def _kernel(eps: float):
    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        held, label = np.array(group["held"].to_pylist(), bool), group["label"].to_numpy()
        u = matrix(group["u"].combine_chunks())
        a, b = np.flatnonzero(held), np.flatnonzero(~held)
        src = dst = np.zeros(0, np.int64)
        if len(a) and len(b):
            close = np.clip(1.0 - u[a] @ u[b].T, 0.0, 2.0) <= eps
            i, j = np.nonzero(close & (label[a][:, None] != label[b][None, :]))
            nodes, at = np.unique(np.concatenate([label[a[i]], label[b[j]]]), return_inverse=True)
            if len(nodes):
                root = _components_small(len(nodes), at[: len(i)], at[len(i) :])
                far = np.flatnonzero(root != np.arange(len(nodes)))
                src, dst = nodes[far], nodes[root[far]]
        return pa.table({"src": pa.array(src, pa.int64()), "dst": pa.array(dst, pa.int64())})

    return run


def prepare(units: DataFrame, n: int, eps: float) -> tuple[DataFrame, Partition]:
    """Placed vectors and their partition, labels of the pivots included."""
    part = partition(units, n, eps)
    points = cut_lineage(placed(units, part))
    shared = bounded_table(points.select("cell", F.explode("others").alias("other")).distinct(), len(part.ids) ** 2)  # pairs of pivots
    part.join(np.stack([shared["cell"].to_numpy(), shared["other"].to_numpy()], axis=1).astype(np.int64))
    shells = points.groupBy("cell", "shell").agg(F.min("d").alias("least"), F.max("d").alias("most"), F.every("linked").alias("linked"))
    t = bounded_table(shells, len(part.ids) * (SHELLS + 1))  # a distance of two ends the last shell
    part.shells(*(t[c].to_numpy() for c in ("cell", "shell", "least", "most")), np.array(t["linked"].to_pylist(), bool))
    return points, part


def neighbour_components(vecs: DataFrame, id_col: str, vec: str, eps: float, held: int = HELD) -> DataFrame:
    """``(node, label)`` of every vector (bigint ids): connected components of
    ``cosine distance <= eps``; a label is the smallest id of its component. A
    zero vector is at distance 1 from every other."""
    units = cut_lineage(unit_vectors(vecs, id_col, vec))
    empty = F.forall("u", lambda v: v == 0)
    n, zeros = units.agg(F.count(F.lit(1)), F.count(F.when(empty, 1))).first()
    alone = units.select(F.col("id").alias("node"), F.col("id").alias("label"))
    if n == zeros == 0 or eps < 0:
        return alone
    if eps >= 2 or (zeros and eps >= 1):  # everyone is near everyone, or near a zero vector
        return alone.withColumn("label", F.lit(alone.agg(F.min("node")).first()[0]))
    if n == zeros:
        return alone
    points, part = prepare(units.where(~empty), n - zeros, eps)
    parts, sent = _parts(points, part, held)
    marked = links = None
    if sent > FEW * n:
        most = crowd(points, part)
        marked = seeded(points, part, eps, most)
        links = rest_links(marked, most, n - zeros, eps, sent)
    if links is None:
        marked, links = None, _routes(points, part, parts).groupBy("shell_no", "h", "q").applyInArrow(_kernel(eps), "src long, dst long")
    edges = cut_lineage(links.distinct())
    touched = edges.select(F.col("src").alias("node")).union(edges.select("dst")).distinct()
    joined = connected_components(touched, edges).select(F.col("node").alias("first"), "label")

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_numpy()
            label = part.label(ids, b.column(1).to_numpy().astype(np.int64), np.array(b.column(2).to_pylist(), bool))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(label)], names=["node", "first"])

    if marked is None:
        labels = points.select("id", "cell", "linked").mapInArrow(first, "node long, first long")
    else:
        labels = marked.select(F.col("id").alias("node"), F.col("label").alias("first"))
    labels = cut_lineage(labels.join(joined, "first", "left").select("node", F.coalesce("label", "first").alias("label")))
    least = labels.groupBy("label").agg(F.min("node").alias("least"))
    return labels.join(least, "label").select("node", F.col("least").alias("label")).unionByName(
        units.where(empty).select(F.col("id").alias("node"), F.col("id").alias("label"))
    )
