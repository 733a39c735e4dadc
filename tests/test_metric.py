"""Metric partitioning: exact components at any shape of the data, and fewer
shuffled vectors than all pairs of blocks where the data have structure."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from test_speakers import brute_components

from voxtab.operators import speakers as SP
from voxtab.plans import metric


def _frame(spark, X):
    return spark.createDataFrame(pd.DataFrame({"utt_id": np.arange(len(X)), "vec": list(X)})).repartition(4)


def _least(X, eps):
    roots = brute_components(X, eps)
    return roots


def _blobs(rng, centres, size, spread, dim):
    c = rng.normal(size=(centres, dim))
    c /= np.linalg.norm(c, axis=1, keepdims=True)
    return np.concatenate([x + rng.normal(size=(size, dim)) * spread for x in c])


@pytest.mark.parametrize("eps", [0.02, 0.3, 1.2])
@pytest.mark.parametrize("shape", ["noise", "blobs", "arc", "crowd"])
def test_components_equal_brute_force(spark, monkeypatch, shape, eps):
    monkeypatch.setattr(metric, "PIVOTS", 12)
    rng = np.random.default_rng(3)
    if shape == "noise":
        X = rng.normal(size=(250, 6))
        X[7] = X[90] = 0.0
    elif shape == "blobs":
        X = _blobs(rng, 8, 30, 0.05, 16)
    elif shape == "arc":  # a chain wider than any ball
        t = np.sort(rng.random(200)) * 3
        X = np.stack([np.cos(t), np.sin(t)], axis=1) * rng.random((200, 1)) * 5
    else:  # a third of the points is one point, another third a tight blob
        X = np.concatenate([np.tile(rng.normal(size=6), (80, 1)), rng.normal(size=6) + rng.normal(size=(80, 6)) * 0.02, rng.normal(size=(80, 6))])
    got = metric.neighbour_components(_frame(spark, X), "utt_id", "vec", eps, held=16).toPandas().set_index("node")["label"].sort_index()
    assert got.tolist() == _least(X, eps)


def test_shuffled_vectors_stay_below_quadratic_on_blobs(spark, capsys):
    rng = np.random.default_rng(5)
    sent = {}
    for n in (1000, 4000):
        X = _blobs(rng, 20, n // 20, 0.04, 32)
        X[: n // 3] = X[0] + rng.normal(size=(n // 3, 32)) * 0.04  # a third in one blob
        X[::25] = rng.normal(size=X[::25].shape)  # and some noise
        units = metric.unit_vectors(_frame(spark, X), "utt_id", "vec").cache()
        points, part = metric.prepare(units, n, 0.1)
        sent[n] = metric.routes(points, part, held=64).count()
    with capsys.disabled():
        print(f"\nshuffled vectors by n: {sent}; all pairs of blocks of 64: { {n: n * -(-n // 64) for n in sent} }")
    assert sent[4000] <= 5 * max(sent[1000], 200)
    assert sent[4000] < 4000 * (4000 // 64) / 10


def test_string_ids_and_mean(spark):
    rng = np.random.default_rng(8)
    X = rng.normal(size=(40, 5))
    X[3] = 0
    df = _frame(spark, X)
    named = df.withColumn("utt_id", F.format_string("clip_%03d", "utt_id"))
    a = SP.dbscan_speakers(df, 0.4).toPandas().sort_values("utt_id")["label"].tolist()
    assert a == SP.dbscan_speakers(named, 0.4).toPandas().sort_values("utt_id")["label"].tolist()
    u = X / np.maximum(np.linalg.norm(X, axis=1, keepdims=True), 1e-300)
    d = (1 - u @ u.T)[np.triu_indices(40, 1)]
    row = SP.cosine_mean(df, "utt_id").first()
    assert row["n_pairs"] == 780 and abs(row["mean_dist"] - d.mean()) < 1e-12
    assert SP.cosine_mean(df.limit(1), "utt_id").first()["mean_dist"] is None
    assert SP.cosine_mean(df.limit(0), "utt_id").first()["n_pairs"] == 0


def test_approximate_form_reaches_its_recall(spark):
    rng = np.random.default_rng(9)
    X = _blobs(rng, 12, 25, 0.05, 24)
    exact = SP.dbscan_speakers(_frame(spark, X), 0.2).toPandas().set_index("utt_id")["label"].sort_index().to_numpy()
    near = SP.approx_dbscan_speakers(_frame(spark, X), 0.2).toPandas().set_index("utt_id")["label"].sort_index().to_numpy()
    same = (exact[:, None] == exact[None, :]) & (exact >= 0)[:, None]
    kept = same & (near[:, None] == near[None, :]) & (near >= 0)[:, None]
    assert kept.sum() / same.sum() >= 0.9
    assert not (~same & (near[:, None] == near[None, :]) & (near >= 0)[:, None]).any()


def test_only_checked_tables_reach_the_driver(spark):
    """Rows come to the driver through ``bounded_table`` alone, which fails
    beyond its bound."""
    import pathlib

    from voxtab.session import bounded_table

    root = pathlib.Path(metric.__file__).parents[1]
    held = {str(p.relative_to(root)) for p in root.rglob("*.py") if "llm" not in p.parts and ".toArrow()" in p.read_text(encoding="utf-8")}
    assert held == {"session.py"}
    assert bounded_table(spark.range(5), 5).num_rows == 5
    with pytest.raises(RuntimeError, match="more than 4 rows"):
        bounded_table(spark.range(5), 4)


@pytest.mark.parametrize("eps", [0.02, 0.3, 0.8])
@pytest.mark.parametrize("shape", ["noise", "crowd", "two crowds"])
def test_rest_components_equal_brute_force(spark, monkeypatch, shape, eps):
    """The way through seeds and the grid, which structureless vectors take."""
    monkeypatch.setattr(metric, "PIVOTS", 6)
    monkeypatch.setattr(metric, "SEEDS", 9)
    monkeypatch.setattr(metric, "FEW", -1)
    monkeypatch.setattr(metric, "block_count", lambda n, least=0: -(-n // 40))
    taken, rest = [], metric.rest_links
    monkeypatch.setattr(metric, "rest_links", lambda *a: taken.append(1) or rest(*a[:-1], 10**9))
    rng = np.random.default_rng(6)
    X = rng.normal(size=(220, 6))
    X[5] = X[200] = 0.0
    if shape != "noise":
        X[:80] = X[0] + rng.normal(size=(80, 6)) * 0.1
    if shape == "two crowds":
        X[80:150] = X[100] + rng.normal(size=(70, 6)) * 0.1
    got = metric.neighbour_components(_frame(spark, X), "utt_id", "vec", eps).toPandas().set_index("node")["label"].sort_index()
    assert got.tolist() == _least(X, eps) and taken


def test_shuffled_vectors_grow_with_structureless_ones(spark, monkeypatch):
    """Vectors in all directions: no shell can be left out, yet a vector is
    sent to few calls, and to no more of them where there are more vectors."""
    sent, calls = {}, metric.calls
    monkeypatch.setattr(metric, "calls", lambda met, *a: sent.update({n: met.agg(F.sum(F.length("ids") / 8)).first()[0]}) or calls(met, *a))
    for n in (1500, 6000):
        X = np.random.default_rng(n).normal(size=(n, 16))
        metric.neighbour_components(_frame(spark, X), "utt_id", "vec", 0.35).count()
        assert sent[n] <= n * 8
    units = metric.unit_vectors(_frame(spark, X), "utt_id", "vec").cache()
    assert metric._parts(*metric.prepare(units, n, 0.35), metric.HELD)[1] > n * 8
