"""All pairs in a grid of large blocks: results of brute force, and a shuffled
volume that grows with the points."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from voxtab.operators import speakers as SP
from voxtab.plans import grid


def _points(spark, X, labels, kind="array<float>"):
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(len(X)), "label": labels, "vec": list(X)})).repartition(3)
    return df.withColumn("vec", F.col("vec").cast(kind))


def test_copies_grow_with_the_points(spark):
    """Every vector is sent once for each partner block, of which there are no
    more for more points; a grid of fixed blocks would send 16 times as many."""
    sent = {}
    for n in (400, 1600):
        X = np.random.default_rng(1).normal(size=(n, 4))
        met = grid.dealt(_points(spark, X, np.zeros(n, int)), grid.block_count(n, least=16, grid=6))
        sent[n] = met.agg(F.sum(F.length("ids") / 8)).first()[0]
    assert sent == {400: 400 * 6, 1600: 1600 * 6}
    assert grid.block_count(10) == 1 and grid.block_count(1) == 1 and grid.block_count(0) == 0
    assert grid.block_count(grid.GRID * grid.MOST) == grid.GRID < grid.block_count(2 * grid.GRID * grid.MOST) == 2 * grid.GRID


def test_done_points_meet_only_the_others(spark):
    X = np.random.default_rng(1).normal(size=(120, 3))
    met = grid.dealt(_points(spark, X, np.zeros(120, int)), 2, 3, F.col("id") >= 20)
    calls = {(r["lo"], r["hi"]) for r in met.select("lo", "hi").distinct().collect()}
    assert calls == {(i, j) for i in range(2) for j in range(i, 5)}


@pytest.mark.parametrize("kind", ["array<float>", "array<double>"])
@pytest.mark.parametrize("blocks", [1, 5])
def test_sums_equal_brute_force(spark, blocks, kind):
    rng = np.random.default_rng(2)
    X = rng.normal(size=(90, 5)).astype(np.float32)
    X[7] = X[40]
    labels = rng.integers(0, 4, 90) * 10**12
    labels[3] = -1  # alone
    got = grid.distance_sums(_points(spark, X, labels, kind), blocks).toPandas()
    d = np.sqrt(((X[:, None].astype(float) - X[None]) ** 2).sum(-1))
    assert len(got) == 90 * len(np.unique(labels))
    for r in got.itertuples():
        other = labels == r.cluster
        assert r.own == labels[r.id] and r.n == other.sum() and abs(r.total - d[r.id, other].sum()) < 1e-6


def test_sums_of_many_clusters_are_cut(monkeypatch):
    monkeypatch.setattr(grid, "SUMS", 50)
    monkeypatch.setattr(grid, "TILE", 64)
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(30, 3)), rng.normal(size=(20, 3))
    a, b = grid.Block(np.arange(30), np.sort(rng.integers(0, 9, 30)), x), grid.Block(np.arange(100, 120), np.sort(rng.integers(0, 9, 20)), y)
    totals = {}
    for batch in grid._sums(a, b, False):
        for i, _, clusters, sums, _ in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
            for c, t in zip(clusters, sums, strict=True):
                totals[i, c] = totals.get((i, c), 0.0) + t
    d = np.sqrt(((x[:, None] - y[None]) ** 2).sum(-1))
    for side, other, dist in ((a, b, d), (b, a, d.T)):
        for i, row in zip(side.ids, dist, strict=True):
            for c in np.unique(other.labels):
                assert abs(totals[i, c] - row[other.labels == c].sum()) < 1e-9


@pytest.mark.parametrize("blocks", [1, 4])
def test_extremes_equal_brute_force(spark, blocks):
    rng = np.random.default_rng(4)
    X = np.abs(rng.normal(size=(70, 6)))
    X[9] = 0.0
    u = X / np.maximum(np.linalg.norm(X, axis=1, keepdims=True), 1e-300)
    d = (1 - u @ u.T)[np.triu_indices(70, 1)]
    got = grid.cosine_extremes(_points(spark, X, np.zeros(70, int), "array<double>"), blocks).agg(F.min("dmin"), F.max("dmax")).first()
    assert abs(got[0] - d.min()) < 1e-12 and abs(got[1] - 1.0) < 1e-12
    none = SP.cosine_stats(spark.createDataFrame([(1, [1.0, 2.0])], "utt_id long, vec array<double>"), "utt_id").first()
    assert none["n_pairs"] == 0 and none["min_dist"] is None
