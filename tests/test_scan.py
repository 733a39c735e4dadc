"""Distributed scan, successor search and chain walk against plain loops."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from voxtab.plans.chain import chain_walk, successor
from voxtab.plans.scan import exact_median, global_rank, ordered_scan


def test_ordered_scan_matches_pandas_with_hot_key(spark):
    rng = np.random.default_rng(1)
    # one key holds most rows so it spans many range partitions
    keys = np.concatenate([np.zeros(3000, int), rng.integers(1, 40, 1000)])
    pdf = pd.DataFrame({"k": keys, "i": np.arange(len(keys)), "x": rng.integers(0, 10, len(keys))})
    pdf["y"] = np.where(rng.random(len(pdf)) < 0.3, rng.random(len(pdf)), np.nan)
    df = spark.createDataFrame(pdf).withColumn("y", F.when(F.isnan("y"), None).otherwise(F.col("y")))
    out = ordered_scan(df, ["k"], ["i"], sums=["x"], ffills=["y"], prevs=["x"], partitions=16).toPandas()
    out = out.sort_values("i").reset_index(drop=True)
    exp = pdf.sort_values(["k", "i"]).copy()
    g = exp.groupby("k")
    exp["pos"] = g.cumcount()
    exp["cum_x"] = g["x"].cumsum()
    exp["ffill_y"] = g["y"].ffill()
    exp["prev_x"] = g["x"].shift(1)
    exp = exp.sort_values("i").reset_index(drop=True)
    assert (out["pos"].to_numpy() == exp["pos"].to_numpy()).all()
    assert (out["cum_x"].to_numpy() == exp["cum_x"].to_numpy()).all()
    np.testing.assert_allclose(out["ffill_y"].astype(float).to_numpy(), exp["ffill_y"].to_numpy(), equal_nan=True)
    np.testing.assert_allclose(out["prev_x"].astype(float).to_numpy(), exp["prev_x"].to_numpy(), equal_nan=True)


def test_descending_scan_gives_next_row(spark):
    pdf = pd.DataFrame({"k": [1] * 50 + [2] * 5, "i": list(range(50)) + list(range(5)), "x": list(range(55))})
    out = ordered_scan(spark.createDataFrame(pdf), ["k"], ["i"], prevs=["x"], descending=True, partitions=7).toPandas()
    out = out.sort_values(["k", "i"]).reset_index(drop=True)
    exp = pdf.sort_values(["k", "i"]).groupby("k")["x"].shift(-1).to_numpy()
    np.testing.assert_allclose(out["prev_x"].astype(float).to_numpy(), exp, equal_nan=True)


def test_exact_median_and_rank(spark):
    rng = np.random.default_rng(2)
    for n in (1, 2, 7, 100):
        v = rng.random(n)
        df = spark.createDataFrame(pd.DataFrame({"v": v}))
        assert abs(exact_median(df, "v").first()["median"] - np.median(v)) < 1e-12
    df = spark.createDataFrame(pd.DataFrame({"v": rng.permutation(200)}))
    r = global_rank(df, ["v"]).toPandas()
    assert (r["rank"].to_numpy() == r["v"].to_numpy() + 1).all()


def test_successor_and_chain(spark):
    rng = np.random.default_rng(3)
    pts = np.sort(rng.choice(1000, 60, replace=False))
    qs = rng.integers(0, 1100, 40)
    p = spark.createDataFrame(pd.DataFrame({"k": 0, "value": pts.astype(float), "pid": np.arange(60)}))
    q = spark.createDataFrame(pd.DataFrame({"k": 0, "value": qs.astype(float), "qid": np.arange(40)}))
    for strict in (False, True):
        got = successor(p, q, ["k"], strict=strict).toPandas().set_index("qid")["pid"]
        for i, v in enumerate(qs):
            cand = np.nonzero(pts > v)[0] if strict else np.nonzero(pts >= v)[0]
            exp = cand[0] if len(cand) else None
            g = got.loc[i]
            assert (exp is None and pd.isna(g)) or g == exp
    nxt = np.arange(1, 101)
    jump = rng.integers(1, 4, 100)
    nodes = pd.DataFrame({"k": 0, "node": np.arange(100), "next": [i + j if i + j < 100 else None for i, j in zip(range(100), jump)]})
    walk, i = set(), 0
    while i is not None:
        walk.add(i)
        n = nodes.loc[i, "next"]
        i = None if n is None or pd.isna(n) else int(n)
    got = chain_walk(spark.createDataFrame(nodes, "k long, node long, next long"),
                     spark.createDataFrame(pd.DataFrame({"k": [0], "node": [0]})), ["k"])
    assert set(got.toPandas()["node"]) == walk
    del nxt


def test_ordered_scan_with_aqe_sized_partitions(spark):
    """Default path: AQE coalesces the range partitions; a small advisory
    size keeps several of them, so the hot key's carries are exercised."""
    rng = np.random.default_rng(8)
    keys = np.concatenate([np.zeros(20000, int), rng.integers(1, 50, 5000)])
    pdf = pd.DataFrame({"k": keys, "i": np.arange(len(keys)), "x": rng.integers(0, 10, len(keys))})
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        out = ordered_scan(spark.createDataFrame(pdf), ["k"], ["i"], sums=["x"]).toPandas()
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    out = out.sort_values("i").reset_index(drop=True)
    exp = pdf.sort_values(["k", "i"]).copy()
    exp["pos"] = exp.groupby("k").cumcount()
    exp["cum_x"] = exp.groupby("k")["x"].cumsum()
    exp = exp.sort_values("i").reset_index(drop=True)
    assert (out["pos"].to_numpy() == exp["pos"].to_numpy()).all()
    assert (out["cum_x"].to_numpy() == exp["cum_x"].to_numpy()).all()
