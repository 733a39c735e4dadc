"""Bounds on the silhouette of a clustering without distances between points.

Points are cut into cells, each inside one cluster and near one pivot. A cell
keeps its size, centre and variance. By Jensen's inequality the mean distance
of a point to a cell lies between its distance to the centre and the root of
that distance squared plus the variance, so sums over cells bound the mean
distance to every cluster, and with it the silhouette of every point. The work
is points times cells, and the cells are bounded in number. More pivots make
smaller cells and tighter bounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxtab.session import bounded_table

#: Rounding of squared distances, relative to the squared lengths.
ROUNDING = 1e-12
#: Cells at most: clusters times pivots.
CELLS = 1 << 15
_ROWS = 512


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _squared(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances of all rows, and how far rounding may put them off."""
    xx, cc = (x * x).sum(1)[:, None], (c * c).sum(1)[None, :]
    return np.maximum(xx + cc - 2 * x @ c.T, 0.0), ROUNDING * (xx + cc)


def pivots_of(points: DataFrame, n: int, id_col: str = "_id", vec: str = "_v") -> np.ndarray:
    """At most ``n`` points, chosen by a hash of their ids."""
    some = points.select(id_col, F.col(vec).cast("array<double>").alias("v")).orderBy(F.xxhash64(id_col), id_col).limit(n)
    return _matrix(bounded_table(some.select("v"), n)["v"].combine_chunks())


def with_pivot(points: DataFrame, pivots: np.ndarray, vec: str = "_v") -> DataFrame:
    """``points`` plus ``pivot``, the number of the nearest pivot."""
    names = points.columns
    at = names.index(vec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, _ROWS):
                b = whole.slice(i, _ROWS)
                d, _ = _squared(_matrix(b.column(at)), pivots)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(d.argmin(1), pa.int64())], names=[*names, "pivot"])

    return points.mapInArrow(run, T.StructType([*points.schema.fields, T.StructField("pivot", T.LongType())]))


def cells_of(points: DataFrame, label: str = "label", vec: str = "_v") -> dict[str, np.ndarray]:
    """Cluster, size, centre and variance of each cell: a row per cluster and
    pivot, so a bounded number."""
    v = F.col(vec).cast("array<double>")
    square = F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x)
    mean = vector_to_array(Summarizer.mean(array_to_vector(v)))
    cells = points.groupBy(label, "pivot").agg(F.count(F.lit(1)).alias("n"), mean.alias("centre"), F.avg(square).alias("square"))
    got = bounded_table(cells, CELLS)
    centre = _matrix(got["centre"].combine_chunks())
    length = (centre * centre).sum(1)
    square = got["square"].to_numpy()
    variance = np.maximum(square - length, 0.0) + ROUNDING * (square + length)
    return {"label": got[label].to_numpy(), "n": got["n"].to_numpy().astype(float), "centre": centre, "variance": variance}


def point_bounds(x: np.ndarray, own: np.ndarray, cells: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The lowest and highest silhouette that each row of ``x``, a member of
    cluster ``own``, can have."""
    clusters, of = np.unique(cells["label"], return_inverse=True)
    held = np.zeros((len(of), len(clusters)))
    held[np.arange(len(of)), of] = cells["n"]
    size = held.sum(0)
    squared, off = _squared(x, cells["centre"])
    low = np.sqrt(np.maximum(squared - off, 0.0)) @ held
    high = np.sqrt(squared + off + cells["variance"]) @ held
    rows, at = np.arange(len(x)), np.searchsorted(clusters, own)
    others = np.maximum(size[at] - 1, 1)
    a_low, a_high = low[rows, at] / others, high[rows, at] / others
    low, high = low / size, high / size
    low[rows, at] = high[rows, at] = np.inf
    b_low, b_high = low.min(1), high.min(1)
    alone = (size[at] == 1) | (len(clusters) == 1)

    def value(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        top = np.maximum(a, b)
        with np.errstate(invalid="ignore", divide="ignore"):
            return np.where(alone | (top == 0), 0.0, (b - a) / top)

    return value(a_high, b_low), value(a_low, b_high)


def silhouette_bounds(points: DataFrame, label: str = "label", vec: str = "_v") -> tuple[float, float]:
    """Lower and upper bound of the mean silhouette of ``points`` (vec, label,
    pivot). A point alone in its cluster counts 0."""
    cells = points.sparkSession.sparkContext.broadcast(cells_of(points, label, vec))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(3)
        for b in batches:
            for i in range(0, b.num_rows, _ROWS):
                some = b.slice(i, _ROWS)
                low, high = point_bounds(_matrix(some.column(0)), some.column(1).to_numpy(), cells.value)
                sums += len(low), low.sum(), high.sum()
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in sums], names=["n", "low", "high"])

    try:
        rows = points.select(F.col(vec).cast("array<double>"), F.col(label).cast("long"))
        got = rows.mapInArrow(run, "n double, low double, high double").agg(F.sum("n"), F.sum("low"), F.sum("high")).first()
    finally:
        cells.destroy()
    return got[1] / got[0], got[2] / got[0]


def best_clustering(labelled: dict[int, DataFrame], exact, pivots: tuple[int, ...] = (1, 16, 256), id_col: str = "_id", vec: str = "_v") -> int:
    """The key of the clustering with the highest mean silhouette, the first
    among equals. ``labelled`` holds the same points (id, vec, label) under
    each key. Bounds rule clusterings out, with more pivots in each
    round; where they cannot tell the last ones apart, ``exact(key)`` does."""
    left = sorted(labelled)
    for n in pivots:
        if len(left) < 2:
            break
        chosen = pivots_of(labelled[left[0]], n, id_col, vec)
        bounds = {k: silhouette_bounds(with_pivot(labelled[k], chosen, vec)) for k in left}
        floor = max(low for low, _ in bounds.values())
        left = [k for k in left if bounds[k][1] >= floor - 1e-9]
    if len(left) < 2:
        return left[0]
    score = {k: -2.0 if (s := exact(k)) is None else s for k in left}  # no score: a single cluster
    return max(left, key=lambda k: (score[k], -k))
