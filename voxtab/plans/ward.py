"""Agglomerative clustering with Ward linkage as rounds of safe merges.

A cluster is a centroid and a size; joining two costs
``sqrt(2 * na * nb / (na + nb)) * |ca - cb|``. Ward linkage is reducible: the
cost from a joined cluster to any other is at least the smaller of its parts'
costs, so what was a lower bound before a merge is one after it. Hence:

- Every cluster keeps its ``NEAR`` nearest clusters as of its last search and
  a horizon, below which no other cluster lies. Both stay valid while other
  clusters merge; a cluster searches again only when it or its nearest one has
  merged.
- A round groups clusters that lead to the same reciprocal pair. Inside a
  group merges go on as long as a pair is reciprocal and no dearer than the
  lower bounds of both parts towards everything outside the group, so each of
  them is a merge of the sequential algorithm. Every group merges one pair at
  least, so the rounds end.
- A search is pruned by the metric: a cost below ``x`` needs centroids nearer
  than ``x / sqrt(2 * na / (na + 1))``. First a cluster looks into its own
  shell of a fixed partition of the space, which bounds its ``NEAR``-th cost;
  then it visits only the shells within that distance. Neighbouring shells
  share a bucket, and a cluster is sent once to each bucket it visits: without
  structure it visits all of them, but they stay ``GRID`` or a few more until
  a bucket would hold more than ``MOST`` clusters, so the shuffled volume of a
  search grows with the clusters.

Equal vectors are one cluster from the start (they join at no cost). Costs at
or above the threshold are never searched. Ties go to smaller ids."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxtab.plans.grid import GRID, MOST, TILE
from voxtab.plans.metric import PIVOTS, SAMPLE, SHELLS, matrix
from voxtab.session import bounded_table, cut_lineage

#: Nearest clusters that are kept, clusters of a group at most, and the least clusters of a bucket.
NEAR, GROUP, LEAST = 32, 1024, 64
_TOL = 1e-9
#: Rounding of squared distances by products, relative to the squared lengths.
_ROUNDING = 1e-12
_CAND = "array<struct<d:double,id:long>>"


def ward_cost(a: np.ndarray, na: np.ndarray, b: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Costs of joining every cluster of ``a`` with every one of ``b``; the
    differences are taken before they are squared, so near centroids stay
    exact."""
    out = np.empty((len(a), len(b)))
    step = max(1, (1 << 21) // max(1, b.size))
    for i in range(0, len(a), step):
        diff = a[i : i + step, None, :] - b[None, :, :]
        out[i : i + step] = np.einsum("ijk,ijk->ij", diff, diff)
    return np.sqrt(2.0 * na[:, None] * nb[None, :] / (na[:, None] + nb[None, :]) * out)


class Space:
    """Fixed pivots and shells of equal width around them."""

    def __init__(self, pivots: np.ndarray, width: float):
        self.pivots, self.width = pivots, width
        self.between = self._to(pivots)

    def _to(self, c: np.ndarray) -> np.ndarray:
        sq = (c * c).sum(axis=1)[:, None] + (self.pivots * self.pivots).sum(axis=1)[None, :] - 2 * c @ self.pivots.T
        return np.sqrt(np.maximum(sq, 0.0))

    def home(self, c: np.ndarray) -> np.ndarray:
        """Shell numbers: cell * SHELLS + shell, the last shell being open."""
        d = self._to(c)
        cell = d.argmin(axis=1)
        return cell * SHELLS + np.minimum(d[np.arange(len(c)), cell] / self.width, SHELLS - 1).astype(np.int64)

    def reach(self, c: np.ndarray, radius: np.ndarray, open_: np.ndarray) -> np.ndarray:
        """(clusters, numbers of ``open_``): shells that can hold a centroid
        within the radius of each cluster, its own left out."""
        d, home, r = self._to(c), self.home(c), (radius * (1 + 1e-9) + 1e-7)[:, None]
        cell, shell = open_ // SHELLS, open_ % SHELLS
        to, own = d[:, cell], d[np.arange(len(c)), home // SHELLS][:, None]
        most = np.where(shell == SHELLS - 1, np.inf, (shell + 1) * self.width)
        able = (to - r <= most) & (to + r >= shell * self.width)
        able &= to**2 - own**2 <= 2 * r * self.between[home // SHELLS][:, cell] + 1e-7
        return able & (open_ != home[:, None])


def _space(clusters: DataFrame, n: int, threshold: float) -> Space:
    table = bounded_table(clusters.orderBy(F.xxhash64("cl"), "cl").limit(SAMPLE).select("c"), SAMPLE)
    sample = matrix(table["c"].combine_chunks())
    pivots = sample[: max(1, min(PIVOTS, math.ceil(math.sqrt(n))))]
    d = np.sqrt(np.maximum(((sample - pivots[0]) ** 2).sum(axis=1), 0.0))
    return Space(pivots, max(threshold / 4, float(d.max()) / SHELLS, 1e-12))


class Buckets:
    """Where the clusters of each shell are held: runs of neighbouring shells
    share a bucket of at most ``most`` clusters, a larger shell has several.
    Asking clusters are dealt into ``parts``, which meet every bucket apart."""

    def __init__(self, sizes: dict[int, int], most: int, parts: int):
        self.known, self.parts = np.array(sorted(sizes), np.int64), max(1, parts)
        starts, first, count, number, room = [], [], [], 0, 0
        for i, s in enumerate(self.known.tolist()):
            if sizes[s] > room or sizes[s] > most:
                need = max(1, math.ceil(sizes[s] / most))
                starts.append(i)
                first.append(number)
                count.append(need)
                number += need
                room = most if need == 1 else 0
            room = max(0, room - sizes[s])
        self.starts, self.first, self.count = (np.array(x, np.int64) for x in (starts, first, count))
        self.run = np.searchsorted(self.starts, np.arange(len(self.known)), side="right") - 1


def _shell_counts(rows: DataFrame, space: Space) -> DataFrame:
    """``(shell_no, n, asking)``: held and asking clusters per shell."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            shells, asks = space.home(matrix(b.column(1))), np.array(b.column(3).to_pylist(), np.int64)
            some, at = np.unique(shells, return_inverse=True)
            for s, n, k in zip(some.tolist(), np.bincount(at), np.bincount(at, asks), strict=True):
                held[s] = held.get(s, 0) + np.array([n, k], np.int64)
        counts = np.array(list(held.values()), np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array(counts[:, 0]), pa.array(counts[:, 1])], names=["shell_no", "n", "asking"])

    counted = rows.mapInArrow(count, "shell_no long, n long, asking long")
    return counted.groupBy("shell_no").agg(F.sum("n").alias("n"), F.sum("asking").alias("asking"))


def _send(rows: DataFrame, space: Space, threshold: float, buckets: Buckets, own_shell: bool) -> DataFrame:
    """Clusters ``(cl, c, size, asks, bound)`` for the kernel calls: either
    into the buckets of their own shell, or into the others that hold a shell
    within reach."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 256):
                b = whole.slice(i, 256)
                cl, c, size = b.column(0).to_numpy(), matrix(b.column(1)), b.column(2).to_numpy().astype(float)
                asks, bound = np.array(b.column(3).to_pylist(), bool), b.column(4).to_numpy()
                home = buckets.run[np.searchsorted(buckets.known, space.home(c))]
                if own_shell:
                    ask, at = np.flatnonzero(asks), home[asks]
                else:
                    radius = np.minimum(bound, threshold) / np.sqrt(2 * size / (size + 1))
                    able = np.logical_or.reduceat(space.reach(c, radius, buckets.known), buckets.starts, axis=1)
                    able[np.arange(len(c)), home] = False  # asked before
                    ask, at = np.nonzero(able & asks[:, None])
                # every bucket of a run is asked; every cluster is held in one, for all parts
                n, some = buckets.count[at], np.arange(len(c))
                again = np.repeat(np.arange(len(ask)), n)
                asked = buckets.first[at[again]] + np.arange(len(again)) - np.repeat(np.cumsum(n) - n, n)
                part = (cl // 7) % buckets.parts
                each = np.repeat(some, buckets.parts)
                out = [
                    (ask[again], asked, part[ask[again]], np.ones(len(again), bool)),
                    (each, (buckets.first[home] + cl % buckets.count[home])[each], np.tile(np.arange(buckets.parts), len(c)), np.zeros(len(each), bool)),
                ]
                rows_, bucket, part, asking = (np.concatenate(x) for x in zip(*out, strict=True))
                for j in range(0, len(rows_), 4096):
                    s = slice(j, j + 4096)
                    take = pa.array(rows_[s])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(bucket[s]), pa.array(part[s]), pa.array(asking[s]), *(b.column(k).take(take) for k in range(3))],
                        names=["bucket", "part", "asking", "cl", "c", "size"],
                    )

    return rows.mapInArrow(send, "bucket long, part long, asking boolean, cl long, c array<double>, size long")


def nearest(cl: np.ndarray, c: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray, threshold: float, k: int) -> Iterator[tuple]:
    """(place in ``a``, costs, ids) of the ``k`` nearest of the clusters ``b``
    below the threshold, ties by id. Products tell which can be among them;
    those are compared exactly."""
    bb, cb, nb = (c[b] * c[b]).sum(1), c[b], size[b]
    step = max(1, TILE // max(1, len(b)))
    for i in range(0, len(a), step):
        rows = a[i : i + step]
        aa, na = (c[rows] * c[rows]).sum(1)[:, None], size[rows][:, None]
        factor = 2.0 * na * nb[None, :] / (na + nb[None, :])
        off = _ROUNDING * (aa + bb[None, :])
        squared = aa + bb[None, :] - 2.0 * (c[rows] @ cb.T)
        high = (squared + off) * factor
        high[cl[rows][:, None] == cl[b][None, :]] = np.inf
        last = np.full((len(rows), 1), threshold**2 * (1 + 1e-9))
        if len(b) > k:
            last = np.minimum(last, np.partition(high, k - 1, axis=1)[:, k - 1 : k])
        low = (squared - off) * factor
        low[np.isinf(high)] = np.inf
        r, j = np.nonzero(low <= last)
        cost = np.empty(len(r))
        for x in range(0, len(r), 1 << 15):
            y = slice(x, x + (1 << 15))
            diff = c[rows[r[y]]] - cb[j[y]]
            n1, n2 = size[rows[r[y]]], nb[j[y]]
            cost[y] = np.sqrt(2.0 * n1 * n2 / (n1 + n2) * np.einsum("ij,ij->i", diff, diff))
        order = np.lexsort((cl[b[j]], cost, r))
        order = order[cost[order] < threshold]
        r, cost, ids = r[order], cost[order], cl[b[j[order]]]
        starts = np.r_[0, np.flatnonzero(np.diff(r)) + 1, len(r)] if len(r) else np.zeros(1, int)
        for s, e in zip(starts, starts[1:], strict=False):
            e = min(e, s + k)
            yield int(rows[r[s]]), cost[s:e], ids[s:e]


def _kernel(threshold: float):
    """The ``NEAR`` nearest held clusters of each asking one."""

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        asking = np.array(group["asking"].to_pylist(), bool)
        cl, size, c = group["cl"].to_numpy(), group["size"].to_numpy().astype(float), matrix(group["c"].combine_chunks())
        found = list(nearest(cl, c, size, np.flatnonzero(asking), np.flatnonzero(~asking), threshold, NEAR))
        ends = np.r_[0, np.cumsum([len(d) for _, d, _ in found])].astype(np.int32)
        flat = [np.concatenate([*(f[i] for f in found), np.zeros(0, kind)]) for i, kind in ((1, float), (2, np.int64))]
        near = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(flat[0], pa.float64()), pa.array(flat[1], pa.int64())], names=["d", "id"]))
        return pa.table({"cl": pa.array([int(cl[f[0]]) for f in found], pa.int64()), "near": near})

    return run


def _merged(found: DataFrame) -> DataFrame:
    """``(cl, cand)``: the ``NEAR`` nearest over all calls."""
    return found.groupBy("cl").agg(F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, NEAR).alias("cand"))


def search(clusters: DataFrame, space: Space, threshold: float, held: int = LEAST, asked: int = MOST) -> DataFrame:
    """``clusters (cl, c, size, cand, horizon, dirty)`` with new neighbours
    for the dirty ones: ``(cl, c, size, cand, horizon)``. A bucket holds
    ``LEAST`` clusters (``held``, if fewer) or a share of ``GRID``, a kernel
    call has about ``asked`` asking clusters at most."""
    start = clusters.select("cl", "c", "size", F.col("dirty").alias("asks"), F.lit(float(threshold)).alias("bound"))
    counted = bounded_table(_shell_counts(start, space), len(space.pivots) * SHELLS).to_pylist()  # a row per shell
    sizes, asking = {r["shell_no"]: r["n"] for r in counted}, sum(r["asking"] for r in counted)
    most = max(min(held, LEAST), min(MOST, math.ceil(sum(sizes.values()) / GRID)))
    buckets = Buckets(sizes, most, math.ceil(asking / asked))
    near = "cl long, near " + _CAND
    own = cut_lineage(_send(start, space, threshold, buckets, True).groupBy("bucket", "part").applyInArrow(_kernel(threshold), near))
    best = _merged(own).select("cl", F.when(F.size("cand") == NEAR, F.element_at("cand", NEAR)["d"]).alias("own_bound"))
    bounded = start.join(best, "cl", "left").select("cl", "c", "size", "asks", F.coalesce("own_bound", "bound").alias("bound"))
    others = _send(bounded, space, threshold, buckets, False).groupBy("bucket", "part").applyInArrow(_kernel(threshold), near)
    found = _merged(own.unionByName(others)).withColumnRenamed("cand", "new")
    out = clusters.join(found, "cl", "left").withColumn("new", F.coalesce("new", F.array().cast(_CAND)))
    # a full list ends where others may begin; a shorter one holds all below the threshold
    ends = F.when(F.size("new") == NEAR, F.element_at("new", NEAR)["d"]).otherwise(F.lit(float(threshold)))
    return out.select(
        "cl", "c", "size", F.when(F.col("dirty"), F.col("new")).otherwise(F.col("cand")).alias("cand"),
        F.when(F.col("dirty"), ends).otherwise(F.col("horizon")).alias("horizon"),
    )


def _merge(threshold: float):
    """Safe merges inside a group: ``(cl, c, size, into)``; a cluster that
    joined another names it, the centroid and size of others may be new."""

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        order = np.argsort(group["cl"].to_numpy(), kind="stable")
        cl, size = group["cl"].to_numpy()[order], group["size"].to_numpy().astype(float)[order]
        c = matrix(group["c"].combine_chunks())[order].copy()
        cand, horizon = group["cand"].to_pylist(), group["horizon"].to_numpy()
        inside = set(cl.tolist())
        limit = np.array([min([horizon[i], *(e["d"] for e in cand[i] if e["id"] not in inside)]) for i in order])
        into, changed = np.arange(len(cl)), np.zeros(len(cl), bool)
        live = np.arange(len(cl))
        cost = ward_cost(c, size, c, size)
        np.fill_diagonal(cost, np.inf)
        while len(live) > 1:
            some = cost[np.ix_(live, live)]
            nn = some.argmin(axis=1)
            at = np.arange(len(live))
            least = some[at, nn]
            safe = (nn[nn] == at) & (at < nn) & (least < threshold) & (least <= limit[live] + _TOL) & (least <= limit[live[nn]] + _TOL)
            keep = live[safe]
            if not len(keep):
                break
            gone = live[nn[safe]]
            na, nb = size[keep][:, None], size[gone][:, None]
            c[keep] = (c[keep] * na + c[gone] * nb) / (na + nb)
            size[keep] += size[gone]
            limit[keep] = np.minimum(limit[keep], limit[gone])
            into[gone] = keep
            changed[keep] = changed[gone] = True
            live = np.setdiff1d(live, gone)
            fresh = ward_cost(c[keep], size[keep], c, size)
            cost[keep], cost[:, keep] = fresh, fresh.T
            cost[keep, keep] = np.inf
        while (into != into[into]).any():  # a cluster may have joined one that joined a third
            into = into[into]
        return pa.table({
            "cl": cl[changed], "c": pa.array(list(c[changed]), pa.list_(pa.float64())),
            "size": size[changed].astype(np.int64), "into": cl[into[changed]],
        })

    return run


def ward(points: DataFrame, threshold: float, held: int = LEAST) -> DataFrame:
    """``points (id long, c array<double>)`` -> ``(id, cl)``: the clusters of
    all merges cheaper than ``threshold``, named by a member's id."""
    if threshold <= 0:
        return points.select("id", F.col("id").alias("cl"))
    same = points.groupBy("c").agg(F.min("id").alias("cl"), F.count(F.lit(1)).alias("size"))
    clusters = cut_lineage(same.select("cl", "c", "size"))
    assign = cut_lineage(points.join(same.select("c", "cl"), "c").select("id", "cl"))
    n = clusters.count()
    if not n:
        return assign
    space = _space(clusters, n, threshold)
    none, unknown, dirty = F.array().cast(_CAND).alias("cand"), F.lit(0.0).alias("horizon"), F.lit(True).alias("dirty")
    state = cut_lineage(search(clusters.select("cl", "c", "size", none, unknown, dirty), space, threshold, held))
    for round_ in itertools.count(1):
        lead = state.where(F.size("cand") > 0).select("cl", F.col("cand")[0]["id"].alias("nn"), F.col("cand")[0]["d"].alias("d"))
        back = lead.select(F.col("cl").alias("nn"), F.col("nn").alias("back"))
        mutual = F.col("back").eqNullSafe(F.col("cl"))
        step = cut_lineage(
            lead.join(back, "nn", "left").select("cl", "d", mutual.alias("root"), F.when(mutual, F.least("cl", "nn")).otherwise(F.col("nn")).alias("to"))
        )
        if step.where("root").isEmpty():
            break
        for _ in range(3):  # up to seven steps to a reciprocal pair; others wait for a later round
            on = step.select(F.col("cl").alias("to"), F.col("root").alias("on_root"), F.col("to").alias("next"))
            step = step.join(on, "to", "left").select(
                "cl", "d", F.when(F.col("root"), True).otherwise(F.coalesce("on_root", F.lit(False))).alias("root"),
                F.when(F.col("root"), F.col("to")).otherwise(F.coalesce("next", "to")).alias("to"),
            )
        nearest = Window.partitionBy("to").orderBy("d", "cl")
        grouped = step.where("root").withColumn("r", F.row_number().over(nearest)).where(F.col("r") <= GROUP).select("cl", F.col("to").alias("grp"))
        merged = cut_lineage(
            state.join(grouped, "cl").select("grp", "cl", "c", "size", "cand", "horizon").groupBy("grp").applyInArrow(
                _merge(threshold), "cl long, c array<double>, size long, into long"
            )
        )
        gone = merged.where("cl != into").select(F.col("cl").alias("gone"), "into")
        assign = assign.join(gone.withColumnRenamed("gone", "cl"), "cl", "left").select("id", F.coalesce("into", "cl").alias("cl"))
        if round_ % 4 == 0:  # its lineage is small tables of joins
            assign = cut_lineage(assign)
        touched = merged.select(F.col("cl").alias("t"))
        kept = state.join(touched, F.col("cl") == F.col("t"), "left_anti")
        lost = F.col("t").isNotNull().alias("dirty")  # its nearest cluster has merged
        kept = kept.join(touched, F.get("cand", F.lit(0))["id"] == F.col("t"), "left").select("cl", "c", "size", "cand", "horizon", lost)
        fresh = merged.where("cl = into").select("cl", "c", "size", none, unknown, dirty)
        now = cut_lineage(kept.unionByName(fresh).repartition("cl"))  # unions would double the partitions each round
        state = cut_lineage(search(now, space, threshold, held).repartition("cl"))
    return assign
