"""Speaker embeddings: pooling, validity, distance statistics,
per-utterance speaker counts, corpus clustering (DBSCAN, KMeans, Ward),
labels and reports.

All-pairs work goes through ``voxtab.plans.pairs`` (blocked pair joins with
bounded outputs), components through ``voxtab.plans.graph``, numbering
through the distributed scan."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxtab.plans.graph import connected_components
from voxtab.plans.grid import block_count, cosine_extremes, distance_sums
from voxtab.plans.metric import neighbour_components, unit_vectors
from voxtab.plans.pairs import block_pairs, component_counts, pack_blocks, threshold_forest
from voxtab.plans.scan import global_rank
from voxtab.plans.separation import best_clustering
from voxtab.plans.ward import ward
from voxtab.session import cut_lineage

BLOCK = 1024  # vectors per block: a block pair is ~2 x 1024 x 192 doubles


def mean_pool(emb: DataFrame, key: str = "utt_id", vec: str = "vec") -> DataFrame:
    """mean of the chunk vectors per utterance (one partial
    aggregation over vectors)."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    some = emb.where(F.col(vec).isNotNull()).select(key, array_to_vector(F.col(vec).cast("array<double>")).alias("_v"))
    return some.groupBy(key).agg(Summarizer.mean(F.col("_v")).alias("_m")).select(key, vector_to_array("_m").alias("vec"))


def valid_embeddings(pooled: DataFrame, utts: DataFrame | None = None, key: str = "utt_id", vec: str = "vec") -> DataFrame:
    """``failed`` with reason for an utterance without chunk vectors
    (``empty embedding``) or whose mean holds NaN (``embedding is NaN``);
    ``success`` otherwise. ``utts`` lists every utterance (a left join finds
    the empty ones)."""
    base = pooled if utts is None else utts.select(key).distinct().join(pooled, key, "left")
    empty = F.col(vec).isNull() | (F.size(vec) == 0)
    has_nan = F.exists(vec, lambda x: F.isnan(x))
    return base.withColumn("status", F.when(empty | has_nan, "failed").otherwise("success")).withColumn(
        "reason", F.when(empty, F.lit("empty embedding")).when(has_nan, F.lit("embedding is NaN"))
    )


def _dense_ids(vecs: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame | None]:
    """The pair kernels number points by bigints. Ids of another type (clip
    paths) are ranked once, in their own order; the second table leads back."""
    if isinstance(vecs.schema[id_col].dataType, T.IntegralType):
        return vecs, None
    ids = cut_lineage(global_rank(vecs.select(id_col).distinct(), [id_col], "_nid"))
    numbered = vecs.join(ids, id_col).drop(id_col).withColumnRenamed("_nid", id_col)
    return numbered, ids


def _own_ids(out: DataFrame, ids: DataFrame | None, id_col: str) -> DataFrame:
    if ids is None:
        return out
    back = out.withColumnRenamed(id_col, "_nid").join(ids, "_nid")
    return back.select(*out.columns)


def cosine_mean(vecs: DataFrame, id_col: str, vec: str = "vec") -> DataFrame:
    """number of pairs and mean cosine distance of all pairs, in one
    aggregation: the unit vectors of n points with sum S have
    ``(|S|^2 - n) / 2`` as the sum of their products. A zero vector is at
    distance 1 from every other."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    u = unit_vectors(vecs.select(F.lit(0).alias(id_col), vec), id_col, vec)
    length = F.aggregate("u", F.lit(0.0), lambda s, v: s + v * v)
    some = u.groupBy(F.lit(0).alias("_one")).agg(  # no group where there is no vector
        F.count(F.lit(1)).alias("n"), F.sum(length).alias("own"), Summarizer.sum(array_to_vector("u")).alias("total")
    )
    some = some.select("_one", "n", "own", F.aggregate(vector_to_array("total"), F.lit(0.0), lambda a, v: a + v * v).alias("whole"))
    s = vecs.sparkSession.range(1).select(F.lit(0).alias("_one")).join(some, "_one", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    n = F.col("n").cast("double")
    return s.select(
        F.expr("n * (n - 1) div 2").alias("n_pairs"),
        F.when(F.col("n") > 1, 1 - (F.col("whole") - F.col("own")) / (n * (n - 1))).alias("mean_dist"),
    )


def cosine_stats(vecs: DataFrame, id_col: str, vec: str = "vec") -> DataFrame:
    """mean, min and max cosine distance over all pairs ``i < j``. Only
    the extremes need the pairs (``voxtab.plans.grid``); ``cosine_mean`` gives
    the mean alone."""
    vecs, _ = _dense_ids(vecs, id_col)
    points = vecs.select(F.col(id_col).cast("bigint").alias("id"), F.lit(0).cast("bigint").alias("label"), F.col(vec).alias("vec"))
    s = cosine_extremes(points, block_count(points.count())).agg(F.min("dmin").alias("min_dist"), F.max("dmax").alias("max_dist"))
    one = F.lit(0).alias("_one")
    return cosine_mean(vecs, id_col, vec).select(one, "*").join(s.select(one, "*"), "_one").drop("_one")


def speaker_count(emb: DataFrame, eps: float = 0.75, key: str = "utt_id", id_col: str = "chunk_idx", vec: str = "vec",
                  utts: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """speakers per utterance = DBSCAN (cosine, min_samples 1) cluster
    count = connected components of ``dist <= eps`` among its chunks;
    an utterance without chunks counts 0; ``multi_speaker = count > 1``. The
    vectors of an utterance meet in one row of at most ``block``; only
    utterances with more go through block pairs and rounds of components."""
    packed = cut_lineage(pack_blocks(emb, [key], id_col, vec, block))
    counts = component_counts(packed.where("nb = 1"), [key], eps)
    large = packed.where("nb > 1")
    if not large.isEmpty():
        forest = threshold_forest(block_pairs(large, [key]), [key], eps)
        labels = connected_components(large.select(key, F.explode("ids").alias("node")), forest, [key])
        counts = counts.unionByName(labels.groupBy(key).agg(F.countDistinct("label").alias("spk_count")))
    if utts is not None:
        counts = utts.select(key).distinct().join(counts, key, "left")
    c = F.coalesce(F.col("spk_count"), F.lit(0)).cast("int")
    return counts.select(key, (c > 1).alias("multi_speaker"), c.alias("spk_count"))


def dbscan_speakers(vecs: DataFrame, eps: float = 0.25, id_col: str = "utt_id", vec: str = "vec",
                    block: int = BLOCK) -> DataFrame:
    """DBSCAN (cosine, min_samples 2): clusters are the components of
    size >= 2 of ``dist <= eps``, numbered in order of their first member;
    singletons are noise (-1). Neighbours are found by exact metric
    partitioning (``voxtab.plans.metric``); ``block`` bounds the vectors of a
    kernel call. Vectors of length zero are noise below ``eps = 1``."""
    vecs, ids = _dense_ids(vecs, id_col)
    return _own_ids(_numbered_clusters(neighbour_components(vecs, id_col, vec, eps, block), id_col), ids, id_col)


def _numbered_clusters(labels: DataFrame, id_col: str) -> DataFrame:
    """Components of two or more, numbered in order of their label (their
    smallest id); others are noise."""
    sizes = labels.groupBy("label").agg(F.count(F.lit(1)).alias("_size"))
    roots = global_rank(sizes.where(F.col("_size") >= 2).select("label"), ["label"], "cluster")
    return labels.join(roots, "label", "left").select(
        F.col("node").alias(id_col), F.coalesce(F.col("cluster") - 1, F.lit(-1)).cast("bigint").alias("label")
    )


def approx_dbscan_speakers(vecs: DataFrame, eps: float = 0.25, id_col: str = "utt_id", vec: str = "vec", tables: int = 8,
                           width: float | None = None, seed: int = 0) -> DataFrame:
    """F5 by choice of the caller with an approximate neighbour search:
    ``BucketedRandomProjectionLSH`` on unit vectors, where ``dist <= eps`` is
    a Euclidean distance of at most ``sqrt(2 * eps)``. A pair that shares a
    bucket in none of the ``tables`` is missed, so clusters may fall apart;
    they never grow. The exact form is ``dbscan_speakers``."""
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector

    vecs, ids = _dense_ids(vecs, id_col)
    units = unit_vectors(vecs, id_col, vec).where(F.exists("u", lambda v: v != 0))
    data = cut_lineage(units.select("id", array_to_vector("u").alias("u")))
    radius = math.sqrt(2 * eps)
    model = BucketedRandomProjectionLSH(inputCol="u", outputCol="h", bucketLength=width or 2 * radius, numHashTables=tables, seed=seed).fit(data)
    near = model.approxSimilarityJoin(data, data, radius, "d").where("datasetA.id < datasetB.id")
    edges = near.select(F.col("datasetA.id").alias("src"), F.col("datasetB.id").alias("dst"))
    labels = connected_components(vecs.select(F.col(id_col).cast("bigint").alias("node")), edges)
    return _own_ids(_numbered_clusters(labels, id_col), ids, id_col)


def silhouette(points: DataFrame, id_col: str, vec: str = "vec", label: str = "label") -> DataFrame:
    """Exact Euclidean silhouette (mean over points; a point alone in its
    cluster scores 0): per point the sum of distances to every cluster from
    the pairs of large blocks (``voxtab.plans.grid``), then ``a``, ``b`` and
    ``s``. One row ``(n, silhouette)``."""
    points, _ = _dense_ids(points, id_col)
    p = points.select(F.col(id_col).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"), F.col(vec).alias("vec"))
    sums = distance_sums(p, block_count(p.count())).withColumn("is_own", F.col("cluster") == F.col("own"))
    per = sums.groupBy("id").agg(
        F.max(F.when(F.col("is_own"), F.col("n") - 1)).alias("n_own"),
        F.max(F.when(F.col("is_own"), F.col("total"))).alias("t_own"),
        F.min(F.when(~F.col("is_own"), F.col("total") / F.col("n"))).alias("b"),
    )
    a = F.col("t_own") / F.col("n_own")
    s = F.when(F.col("n_own") == 0, F.lit(0.0)).otherwise((F.col("b") - a) / F.greatest(a, F.col("b")))
    return per.agg(F.count(F.lit(1)).alias("n"), F.avg(s).alias("silhouette"))


def kmeans_speakers(vecs: DataFrame, id_col: str = "utt_id", vec: str = "vec", max_k: int = 10, seed: int = 0) -> DataFrame:
    """KMeans for k = 2 .. min(max_k, n) − 1, the best silhouette wins
    (first k on ties). Bounds from cell centres and variances decide
    (``voxtab.plans.separation``, work linear in the points); only ks that they
    cannot tell apart are compared by ``silhouette`` over all pairs. With n <= 2 (no k to try) every point gets label
    0 (the reference crashes there). Labels are canonical: numbered by
    smallest member id. Returns ``(id, label, k)``."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    n = vecs.count()  # scalar
    vecs, ids = _dense_ids(vecs, id_col)
    data = vecs.select(F.col(id_col).cast("bigint").alias("_id"), F.col(vec).alias("_v"),
                       array_to_vector(F.col(vec).cast("array<double>")).alias("features"))
    data = cut_lineage(data)
    labelled = {}
    for k in range(2, min(max_k, n)):
        model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="label").fit(data)
        labelled[k] = model.transform(data).select("_id", "_v", F.col("label").cast("bigint"))
    if not labelled:
        out = data.select(F.col("_id").alias(id_col), F.lit(0).cast("bigint").alias("label"), F.lit(1).alias("k"))
    else:
        k = best_clustering(labelled, lambda k: silhouette(labelled[k], "_id", "_v", "label").first()["silhouette"])
        best = cut_lineage(labelled[k].select("_id", "label"))
        out = canonical_labels(best, "_id", "label").select(F.col("_id").alias(id_col), "label", F.lit(k).alias("k"))
    return _own_ids(out, ids, id_col)


def canonical_labels(df: DataFrame, id_col: str, label: str = "label") -> DataFrame:
    """Renumber cluster labels 0.. by their smallest member id (negative
    labels, noise, are kept)."""
    firsts = df.where(F.col(label) >= 0).groupBy(label).agg(F.min(id_col).alias("_first"))
    ranked = global_rank(firsts, ["_first"], "_r")
    return df.join(ranked.select(label, "_r"), label, "left").withColumn(
        label, F.when(F.col(label) >= 0, F.col("_r") - 1).otherwise(F.col(label))
    ).drop("_r")


def ward_speakers(vecs: DataFrame, threshold: float = 0.75, id_col: str = "utt_id", vec: str = "vec",
                  block: int = BLOCK) -> DataFrame:
    """agglomerative clustering, Ward linkage, merging while the merge
    cost is below ``threshold``: rounds of safe merges with cached neighbours
    (``voxtab.plans.ward``), one path for every size. ``block`` bounds the
    clusters of a kernel call. Returns canonical ``(id, label)``."""
    vecs, ids = _dense_ids(vecs, id_col)
    points = vecs.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec).cast("array<double>").alias("c"))
    assign = ward(points, threshold, block).withColumnRenamed("cl", "label")
    return _own_ids(canonical_labels(assign, "id", "label").withColumnRenamed("id", id_col), ids, id_col)


def utt2spk(labels: DataFrame, key: str = "utt_id", label: str = "label") -> DataFrame:
    """F8: ``spk<label>`` per utterance (noise becomes ``spk-1``)."""
    return labels.select(key, F.concat(F.lit("spk"), F.col(label).cast("string")).alias("spk"))


def cluster_report(labels: DataFrame, label: str = "label") -> DataFrame:
    """clusters without noise, noise points, clusters counting noise as
    one."""
    return labels.agg(
        F.countDistinct(F.when(F.col(label) >= 0, F.col(label))).alias("n_clusters"),
        F.count(F.when(F.col(label) < 0, 1)).alias("n_noise"),
        F.countDistinct(F.col(label)).alias("n_labels"),
    )


def single_speaker(segs: DataFrame, verdicts: DataFrame, key: str = "utt_id", min_count: int = 0) -> DataFrame:
    """keep clips judged single-speaker (count 0, empty, is
    ``multi_speaker = false`` and passes unless ``min_count = 1``)."""
    ok = verdicts.where(~F.col("multi_speaker") & (F.col("spk_count") >= min_count)).select(key)
    return segs.join(ok, key, "left_semi")


__all__ = [
    "approx_dbscan_speakers",
    "canonical_labels",
    "cluster_report",
    "cosine_mean",
    "cosine_stats",
    "dbscan_speakers",
    "kmeans_speakers",
    "mean_pool",
    "silhouette",
    "single_speaker",
    "speaker_count",
    "utt2spk",
    "valid_embeddings",
    "ward_speakers",
]
