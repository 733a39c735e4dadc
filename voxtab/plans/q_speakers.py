"""Checked queries F1-F10 (speaker embeddings). Components in the SQL forms
are recursive reachability over the explicit all-pairs edge list (the
brute-force formulation; the Spark side never builds that list)."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxtab.operators import speakers as SP
from voxtab.plans.registry import register, rounded, sqlq
from voxtab.sources.views import table, v_emb, with_views

F4_EPS, F5_EPS = 0.95, 0.6

_COS = ("1 - list_dot_product(CAST(a.{v} AS DOUBLE[]), CAST(b.{v} AS DOUBLE[])) / "
        "(sqrt(list_dot_product(CAST(a.{v} AS DOUBLE[]), CAST(a.{v} AS DOUBLE[]))) * "
        "sqrt(list_dot_product(CAST(b.{v} AS DOUBLE[]), CAST(b.{v} AS DOUBLE[]))))")


def _raw(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vec"), "label")


@register(
    "f1_mean_pool",
    with_views("v_emb")
    + f"""SELECT utt_id, CAST(d - 1 AS INTEGER) AS dim, {sqlq('avg(x)')} AS value
FROM (SELECT utt_id, unnest(vec) AS x, unnest(range(1, len(vec) + 1)) AS d FROM v_emb) GROUP BY utt_id, d""",
)
def f1_mean_pool(spark, sf_dir):
    pooled = SP.mean_pool(v_emb(spark, sf_dir))
    return rounded(pooled.select("utt_id", F.posexplode("vec").alias("dim", "value")))


@register(
    "f2_valid_embeddings",
    """SELECT vec_id AS utt_id, CASE WHEN vec_id % 7 IN (0, 1) THEN 'failed' ELSE 'success' END AS status,
       CASE vec_id % 7 WHEN 0 THEN 'empty embedding' WHEN 1 THEN 'embedding is NaN' END AS reason FROM embeddings""",
)
def f2_valid_embeddings(spark, sf_dir):
    """Of each seven utterances one has no chunk and one a NaN in a chunk."""
    e = table(spark, sf_dir, "embeddings")
    utts = e.select(F.col("vec_id").alias("utt_id"))
    vec = F.when(F.col("vec_id") % 7 == 1, F.transform("embedding", lambda x, i: F.when(i == 1, F.lit(float("nan"))).otherwise(x)))
    chunks = e.where(F.col("vec_id") % 7 != 0).select(F.col("vec_id").alias("utt_id"), vec.otherwise(F.col("embedding")).alias("vec"))
    return SP.valid_embeddings(SP.mean_pool(chunks), utts).select("utt_id", "status", "reason")


@register(
    "f3_cosine_stats",
    f"""SELECT CAST(count(*) AS BIGINT) AS n_pairs, {sqlq('avg(d)')} AS mean_dist, {sqlq('min(d)')} AS min_dist,
       {sqlq('max(d)')} AS max_dist
FROM (SELECT least(greatest({_COS.format(v='embedding')}, 0.0), 2.0) AS d
      FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id)""",
)
def f3_cosine_stats(spark, sf_dir):
    return rounded(SP.cosine_stats(_raw(spark, sf_dir), "vec_id"))


_F4_SQL = with_views("v_emb") + f""", e AS (
  SELECT a.utt_id, a.chunk_idx AS i, b.chunk_idx AS j FROM v_emb a JOIN v_emb b
    ON a.utt_id = b.utt_id AND a.chunk_idx < b.chunk_idx
  WHERE {_COS.format(v='vec')} <= {F4_EPS}),
ee AS (SELECT utt_id, i, j FROM e UNION ALL SELECT utt_id, j, i FROM e),
reach(utt_id, node, r) AS (
  SELECT utt_id, chunk_idx, chunk_idx FROM v_emb
  UNION SELECT reach.utt_id, ee.j, reach.r FROM reach JOIN ee ON ee.utt_id = reach.utt_id AND ee.i = reach.node),
comp AS (SELECT utt_id, node, min(r) AS root FROM reach GROUP BY utt_id, node),
cnt AS (SELECT utt_id, CAST(count(DISTINCT root) AS INTEGER) AS spk_count FROM comp GROUP BY utt_id)
"""


@register("f4_speaker_count", _F4_SQL + "SELECT utt_id, spk_count > 1 AS multi_speaker, spk_count FROM cnt")
def f4_speaker_count(spark, sf_dir):
    return SP.speaker_count(v_emb(spark, sf_dir), eps=F4_EPS)


_F5_SQL = f"""WITH RECURSIVE e AS (
  SELECT a.vec_id AS i, b.vec_id AS j FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id
  WHERE {_COS.format(v='embedding')} <= {F5_EPS}),
ee AS (SELECT i, j FROM e UNION ALL SELECT j, i FROM e),
reach(node, r) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT ee.j, reach.r FROM reach JOIN ee ON ee.i = reach.node),
comp AS (SELECT node, min(r) AS root FROM reach GROUP BY node),
sz AS (SELECT root, count(*) AS n FROM comp GROUP BY root),
num AS (SELECT root, row_number() OVER (ORDER BY root) - 1 AS cl FROM sz WHERE n >= 2),
lab AS (SELECT comp.node AS vec_id, CAST(coalesce(num.cl, -1) AS BIGINT) AS label FROM comp LEFT JOIN num USING (root))
"""


def _f5(spark, sf_dir):
    return SP.dbscan_speakers(_raw(spark, sf_dir), eps=F5_EPS, id_col="vec_id")


@register("f5_dbscan_speakers", _F5_SQL + "SELECT vec_id, label FROM lab")
def f5_dbscan_speakers(spark, sf_dir):
    return _f5(spark, sf_dir)


@register(
    "f6_silhouette",
    f"""WITH d AS (
  SELECT a.vec_id AS i, a.label AS li, b.label AS lj,
         sqrt(list_sum(list_transform(list_zip(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])),
                                      lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS dist
  FROM embeddings a JOIN embeddings b ON a.vec_id != b.vec_id),
m AS (SELECT i, li, lj, avg(dist) AS md, count(*) AS n FROM d GROUP BY i, li, lj),
p AS (SELECT i, max(md) FILTER (WHERE li = lj) AS a, min(md) FILTER (WHERE li != lj) AS b FROM m GROUP BY i),
s AS (SELECT i, CASE WHEN a IS NULL THEN 0.0 ELSE (b - a) / greatest(a, b) END AS s FROM p)
SELECT CAST(count(*) AS BIGINT) AS n, {sqlq('avg(s)')} AS silhouette FROM s""",
)
def f6_silhouette(spark, sf_dir):
    return rounded(SP.silhouette(_raw(spark, sf_dir), "vec_id", "vec", "label"))


@register("f6_kmeans_speakers")
def f6_kmeans_speakers(spark, sf_dir):
    pooled = SP.mean_pool(v_emb(spark, sf_dir))
    return SP.kmeans_speakers(pooled, "utt_id", "vec", max_k=10)


_POOLED = f"""p AS (
  SELECT utt_id, list(x ORDER BY d) AS c FROM (
    SELECT utt_id, d, avg(x) AS x FROM (SELECT utt_id, unnest(vec) AS x, unnest(range(1, len(vec) + 1)) AS d FROM v_emb) GROUP BY utt_id, d)
  GROUP BY utt_id)"""
_COST = "sqrt(2.0 * a.n * b.n / (a.n + b.n)) * list_distance(a.c, b.c)"


@register(
    "f7_ward_speakers",
    with_views("v_emb")
    + f""", {_POOLED},
greedy(step, cl, c, n, members) AS (
  SELECT 0, utt_id, c, 1, [utt_id] FROM p
  UNION ALL
  SELECT step + 1, cl, CASE WHEN cl = x THEN mixed ELSE c END, CASE WHEN cl = x THEN total ELSE n END,
         CASE WHEN cl = x THEN everyone ELSE members END
  FROM greedy, (
    SELECT a.cl AS x, b.cl AS y, a.n + b.n AS total, list_concat(a.members, b.members) AS everyone,
           list_transform(list_zip(a.c, b.c), lambda v: (v[1] * a.n + v[2] * b.n) / (a.n + b.n)) AS mixed
    FROM greedy a JOIN greedy b ON a.cl < b.cl WHERE {_COST} < 0.75
    ORDER BY {_COST}, a.cl, b.cl LIMIT 1)
  WHERE cl <> y),
last AS (SELECT members, row_number() OVER (ORDER BY list_min(members)) - 1 AS label FROM greedy WHERE step = (SELECT max(step) FROM greedy))
SELECT unnest(members) AS utt_id, CAST(label AS BIGINT) AS label FROM last""",
)
def f7_ward_speakers(spark, sf_dir):
    pooled = SP.mean_pool(v_emb(spark, sf_dir))
    return SP.ward_speakers(pooled, 0.75, "utt_id", "vec")


@register("f8_utt2spk", _F5_SQL + "SELECT vec_id, 'spk' || CAST(label AS VARCHAR) AS spk FROM lab")
def f8_utt2spk(spark, sf_dir):
    return SP.utt2spk(_f5(spark, sf_dir), "vec_id")


@register(
    "f9_cluster_report",
    _F5_SQL
    + """SELECT CAST(count(DISTINCT label) FILTER (WHERE label >= 0) AS BIGINT) AS n_clusters,
       CAST(count(*) FILTER (WHERE label < 0) AS BIGINT) AS n_noise, CAST(count(DISTINCT label) AS BIGINT) AS n_labels FROM lab""",
)
def f9_cluster_report(spark, sf_dir):
    return SP.cluster_report(_f5(spark, sf_dir))


@register(
    "f10_single_speaker",
    _F4_SQL + "SELECT DISTINCT v.utt_id, v.chunk_idx FROM v_emb v JOIN cnt USING (utt_id) WHERE cnt.spk_count <= 1",
)
def f10_single_speaker(spark, sf_dir):
    emb = v_emb(spark, sf_dir)
    verdicts = SP.speaker_count(emb, eps=F4_EPS)
    return SP.single_speaker(emb.select("utt_id", "chunk_idx"), verdicts)
