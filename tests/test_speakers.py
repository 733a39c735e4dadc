"""Clustering against brute force on small seeded sets."""

import numpy as np
import pandas as pd

from voxtab.operators import speakers as SP
from voxtab.plans import separation


def brute_components(X, eps):
    n = len(X)
    u = X / np.where(np.linalg.norm(X, axis=1, keepdims=True) > 0, np.linalg.norm(X, axis=1, keepdims=True), 1)
    d = np.clip(1 - u @ u.T, 0, 2)
    lab = list(range(n))

    def find(i):
        while lab[i] != i:
            lab[i] = lab[lab[i]]
            i = lab[i]
        return i

    for i in range(n):
        for j in range(i + 1, n):
            if d[i, j] <= eps:
                a, b = find(i), find(j)
                lab[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_dbscan_equals_brute_force(spark):
    rng = np.random.default_rng(0)
    X = rng.normal(size=(300, 8))
    X[5] = 0.0  # zero vector: distance 1 to everything
    df = spark.createDataFrame(pd.DataFrame({"utt_id": np.arange(300), "vec": list(X)}))
    got = SP.dbscan_speakers(df, eps=0.35, block=64).toPandas().set_index("utt_id")["label"]
    roots = brute_components(X, 0.35)
    sizes = pd.Series(roots).value_counts()
    clusters = sorted(r for r in set(roots) if sizes[r] >= 2)
    exp = [clusters.index(r) if sizes[r] >= 2 else -1 for r in roots]
    assert got.sort_index().tolist() == exp


def test_speaker_count_per_utterance(spark):
    rng = np.random.default_rng(1)
    rows, exp = [], {}
    for utt in range(20):
        k = int(rng.integers(0, 12))
        X = rng.normal(size=(k, 4))
        for c in range(k):
            rows.append((utt, c, X[c].tolist()))
        exp[utt] = len(set(brute_components(X, 0.5))) if k else 0
    df = spark.createDataFrame(rows, "utt_id long, chunk_idx long, vec array<double>")
    utts = spark.createDataFrame([(u,) for u in range(20)], "utt_id long")
    got = SP.speaker_count(df, eps=0.5, utts=utts, block=4).toPandas().set_index("utt_id")
    for utt, n in exp.items():
        assert got.loc[utt, "spk_count"] == n
        assert bool(got.loc[utt, "multi_speaker"]) == (n > 1)


def naive_ward(X, threshold):
    clusters = {i: ([i], X[i].astype(float)) for i in range(len(X))}
    while len(clusters) > 1:
        best = None
        keys = sorted(clusters)
        for a_i, a in enumerate(keys):
            for b in keys[a_i + 1:]:
                na, nb = len(clusters[a][0]), len(clusters[b][0])
                d = np.sqrt(2 * na * nb / (na + nb)) * np.linalg.norm(clusters[a][1] - clusters[b][1])
                if best is None or d < best[0]:
                    best = (d, a, b)
        if best[0] >= threshold:
            break
        _, a, b = best
        ma, ca = clusters[a]
        mb, cb = clusters.pop(b)
        clusters[a] = (ma + mb, (ca * len(ma) + cb * len(mb)) / (len(ma) + len(mb)))
    lab = {}
    for members, _ in clusters.values():
        for m in members:
            lab[m] = min(members)
    firsts = sorted(set(lab.values()))
    return [firsts.index(lab[i]) for i in range(len(X))]


def test_ward_equals_greedy(spark):
    rng = np.random.default_rng(2)
    centers = rng.normal(size=(4, 3)) * 3
    X = np.concatenate([c + rng.normal(size=(10, 3)) * 0.3 for c in centers])
    df = spark.createDataFrame(pd.DataFrame({"utt_id": np.arange(len(X)), "vec": list(X)}))
    exp = naive_ward(X, 1.5)
    for block in (16, SP.BLOCK):  # shells cut into blocks, or not
        got = SP.ward_speakers(df, threshold=1.5, block=block).toPandas()
        assert got.set_index("utt_id")["label"].sort_index().tolist() == exp


def test_kmeans_finds_blobs_and_silhouette(spark):
    rng = np.random.default_rng(3)
    centers = np.array([[0, 0], [10, 0], [0, 10]], float)
    X = np.concatenate([c + rng.normal(size=(15, 2)) * 0.2 for c in centers])
    df = spark.createDataFrame(pd.DataFrame({"utt_id": np.arange(len(X)), "vec": list(X)}))
    got = SP.kmeans_speakers(df, max_k=6).toPandas()
    assert got["k"].iloc[0] == 3 and got["label"].nunique() == 3
    labels = np.repeat([0, 1, 2], 15)
    s = SP.silhouette(spark.createDataFrame(pd.DataFrame({"id": np.arange(45), "vec": list(X), "label": labels})), "id").first()
    d = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1))
    sil = []
    for i in range(45):
        own = labels == labels[i]
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, labels == c].mean() for c in set(labels) - {labels[i]})
        sil.append((b - a) / max(a, b))
    assert abs(s["silhouette"] - np.mean(sil)) < 1e-9


def _silhouettes(X, labels):
    d = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1))
    out = []
    for i, own in enumerate(labels):
        n = (labels == own).sum()
        a, b = d[i, labels == own].sum() / max(n - 1, 1), min(d[i, labels == c].mean() for c in set(labels) - {own})
        out.append(0.0 if n == 1 or max(a, b) == 0 else (b - a) / max(a, b))
    return np.mean(out)


def test_silhouette_bounds_hold_and_choose(spark):
    """Bounds hold the exact value and tighten with more pivots; the choice is
    the exact one, without any exact distances where the bounds tell."""
    rng = np.random.default_rng(9)
    X = np.concatenate([c + rng.normal(size=(20, 4)) for c in rng.normal(size=(3, 4)) * 9])
    X[10:15] = X[9]  # copies
    own = np.repeat([0, 1, 2], 20)
    lonely = own.copy()
    lonely[0] = 7
    sets = {2: np.minimum(own, 1), 3: own, 4: rng.integers(0, 4, 60), 5: np.where(np.arange(60) % 2, own, own + 3), 6: lonely}
    frames = {
        k: spark.createDataFrame(pd.DataFrame({"_id": np.arange(60), "_v": list(X), "label": v})).cache() for k, v in sets.items()
    }
    exact = {k: _silhouettes(X, v) for k, v in sets.items()}
    for k, df in frames.items():
        gaps = []
        for n in (1, 12, 60):
            low, high = separation.silhouette_bounds(separation.with_pivot(df, separation.pivots_of(df, n)))
            assert low - 1e-9 <= exact[k] <= high + 1e-9
            gaps.append(high - low)
        assert gaps[0] > gaps[1] > gaps[2]
    asked = []
    few = {k: frames[k] for k in (2, 3, 4)}
    assert separation.best_clustering(few, asked.append) == max(few, key=exact.get) and asked == []
    twins = {8: frames[3], 9: frames[3], 10: frames[4]}  # equal ones go to the exact form, the first wins
    assert separation.best_clustering(twins, lambda k: asked.append(k) or 0.5) == 8 and asked == [8, 9]
    for df in frames.values():
        df.unpersist()


def test_two_points_kmeans_gives_one_cluster(spark):
    df = spark.createDataFrame(pd.DataFrame({"utt_id": [1, 2], "vec": [[0.0, 1.0], [1.0, 0.0]]}))
    got = SP.kmeans_speakers(df).toPandas()
    assert set(got["label"]) == {0}


def test_ward_with_a_third_in_one_blob(spark, monkeypatch):
    """Near lists that are too short to hold a blob, copies, and groups that
    are cut: the same clusters as the greedy form."""
    from voxtab.plans import ward as W

    monkeypatch.setattr(W, "NEAR", 3)
    monkeypatch.setattr(W, "GROUP", 6)
    monkeypatch.setattr(W, "PIVOTS", 5)
    rng = np.random.default_rng(4)
    X = np.concatenate([rng.normal(size=(40, 4)) * 0.3, np.tile(rng.normal(size=4), (20, 1)), rng.normal(size=(60, 4)) * 3])
    df = spark.createDataFrame(pd.DataFrame({"utt_id": np.arange(len(X)), "vec": list(X)})).repartition(3)
    for threshold in (0.0, 1.1):
        got = SP.ward_speakers(df, threshold=threshold, block=16).toPandas()
        assert got.set_index("utt_id")["label"].sort_index().tolist() == (naive_ward(X, threshold) if threshold else list(range(len(X))))
    assert SP.ward_speakers(df.limit(0)).count() == 0


def test_ward_search_sends_a_cluster_once_to_a_bucket(spark):
    """Without structure every cluster visits every bucket, but not every
    shell: what is sent grows with the clusters."""
    from pyspark.sql import functions as F

    from voxtab.plans import ward as W

    sent, exact = {}, {}
    for n in (150, 600):
        X = np.random.default_rng(n).normal(size=(n, 12))
        df = spark.createDataFrame(pd.DataFrame({"cl": np.arange(n), "c": list(X)})).repartition(3)
        df = df.select("cl", "c", F.lit(1).cast("long").alias("size"), F.lit(True).alias("asks"), F.lit(99.0).alias("bound"))
        space = W._space(df, n, 99.0)
        counted = W._shell_counts(df, space).collect()
        assert sum(r["n"] for r in counted) == sum(r["asking"] for r in counted) == n and len(counted) > 12
        buckets = W.Buckets({r["shell_no"]: r["n"] for r in counted}, -(-n // 6), 1)
        sent[n] = sum(W._send(df, space, 99.0, buckets, own).count() for own in (True, False))
        state = df.select("cl", "c", "size", F.array().cast(W._CAND).alias("cand"), F.lit(0.0).alias("horizon"), F.lit(True).alias("dirty"))
        for row in W.search(state, space, 99.0, held=16, asked=40).collect():
            cost = np.sqrt(((X - X[row["cl"]]) ** 2).sum(1))
            order = [i for i in np.lexsort((np.arange(n), cost)) if i != row["cl"]][: W.NEAR]
            assert [e["id"] for e in row["cand"]] == order and abs(row["horizon"] - cost[order[-1]]) < 1e-9
    assert sent[600] <= 600 * 14 and sent[150] <= 150 * 14
