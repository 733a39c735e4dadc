"""All-pairs work on vectors without a cross join and without emitting every
pair.

Vectors are packed into blocks of bounded size inside each key (a key may
hold a third of all rows: it simply gets more blocks). Each block is
replicated once per partner block and the two roles are *equi-joined* on
``(key, block_lo, block_hi)``, so every unordered block pair meets exactly
once, in its own task. A vectorised kernel (``mapInPandas``, numpy matrix
product) then reduces the pair to a bounded output: threshold edges as a
spanning forest (at most ``|A| + |B|`` rows). Work is ``O(n²)`` as all-pairs
must be, but it is spread over ``nb²/2`` tasks and never materialised.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def pack_blocks(df: DataFrame, keys: Sequence[str], id_col: str, vec_col: str, block_size: int,
                extra: Sequence[str] = ()) -> DataFrame:
    """``(keys, blk, nb, ids, vecs, extra...)``: rows of a key hashed into
    ``nb = ceil(n_key / block_size)`` blocks."""
    keys = list(keys)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")) if keys else df.agg(F.count(F.lit(1)).alias("_n"))
    nb = F.greatest(F.lit(1), F.ceil(F.col("_n") / block_size)).cast("bigint")
    if keys:
        j = df.join(counts, keys)
    else:
        j = df.withColumn("_one", F.lit(0)).join(F.broadcast(counts.withColumn("_one", F.lit(0))), "_one").drop("_one")
    j = j.withColumn("nb", nb).withColumn("blk", F.pmod(F.xxhash64(F.col(id_col)), F.col("nb")))
    return j.groupBy(*keys, "blk", "nb").agg(
        F.collect_list(F.col(id_col).cast("bigint")).alias("ids"),
        F.collect_list(F.col(vec_col).cast("array<double>")).alias("vecs"),
        *[F.collect_list(F.col(c)).alias(c) for c in extra],
    )


def block_pairs(blocks: DataFrame, keys: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """Every unordered pair of blocks of the same key, once:
    ``(keys, pa, pb, a_ids, a_vecs, b_ids, b_vecs, a_<x>, b_<x>)``."""
    keys = list(keys)
    left = blocks.select(
        *keys, F.col("blk").alias("pa"), F.explode(F.sequence(F.col("blk"), F.col("nb") - 1)).alias("pb"),
        F.col("ids").alias("a_ids"), F.col("vecs").alias("a_vecs"), *[F.col(c).alias(f"a_{c}") for c in extra],
    )
    right = blocks.select(
        *keys, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blk"))).alias("pa"), F.col("blk").alias("pb"),
        F.col("ids").alias("b_ids"), F.col("vecs").alias("b_vecs"), *[F.col(c).alias(f"b_{c}") for c in extra],
    )
    return left.join(right, [*keys, "pa", "pb"])


def _same_block(r) -> bool:
    """A diagonal pair (a block with itself): both join sides were built
    separately and their row order is not guaranteed to agree, so kernels
    use the ``a`` side for both."""
    if r["pa"] == r["pb"]:
        for k in list(r):
            if k.startswith("a_"):
                r["b_" + k[2:]] = r[k]
        return True
    return False


def _unit(rows) -> np.ndarray:
    m = np.stack([np.asarray(r, dtype=np.float64) for r in rows]) if len(rows) else np.zeros((0, 0))
    norms = np.linalg.norm(m, axis=1, keepdims=True)
    with np.errstate(invalid="ignore", divide="ignore"):
        u = np.where(norms > 0, m / np.where(norms > 0, norms, 1.0), 0.0)
    return u


def _cos_dist(a_vecs, b_vecs) -> np.ndarray:
    """Cosine distance, zero vectors at distance 1, clipped to [0, 2]."""
    d = 1.0 - _unit(a_vecs) @ _unit(b_vecs).T
    return np.clip(d, 0.0, 2.0)


def _components_small(n: int, ei: np.ndarray, ej: np.ndarray) -> np.ndarray:
    """Connected-component labels (smallest member index) of a small graph."""
    lab = np.arange(n)
    while True:
        m = np.minimum(lab[ei], lab[ej])
        new = lab.copy()
        np.minimum.at(new, ei, m)
        np.minimum.at(new, ej, m)
        new = new[new]
        if np.array_equal(new, lab):
            return lab
        lab = new


def threshold_forest(pairs: DataFrame, keys: Sequence[str], eps: float) -> DataFrame:
    """Edges ``dist <= eps`` between the two blocks of each pair (``i < j``
    inside a diagonal pair), reduced to a spanning forest of the pair:
    ``(keys, src, dst)``; connectivity is preserved, size is bounded."""
    keys = list(keys)
    schema = T.StructType(
        [pairs.schema[k] for k in keys] + [T.StructField("src", T.LongType()), T.StructField("dst", T.LongType())]
    )

    def fn(batches):
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                r = row._asdict()
                _same_block(r)
                a_ids, b_ids = np.asarray(r["a_ids"], dtype=np.int64), np.asarray(r["b_ids"], dtype=np.int64)
                d = _cos_dist(r["a_vecs"], r["b_vecs"])
                close = d <= eps
                if r["pa"] == r["pb"]:
                    close = np.triu(close, k=1)
                ii, jj = np.nonzero(close)
                if len(ii) == 0:
                    continue
                if r["pa"] == r["pb"]:
                    nodes, ei, ej = a_ids, ii, jj
                else:
                    nodes = np.concatenate([a_ids, b_ids])
                    ei, ej = ii, jj + len(a_ids)
                lab = _components_small(len(nodes), ei, ej)
                touched = np.zeros(len(nodes), dtype=bool)
                touched[ei] = True
                touched[ej] = True
                sel = touched & (lab != np.arange(len(nodes)))
                src, dst = nodes[sel], nodes[lab[sel]]
                kv = {k: r[k] for k in keys}
                out.append(pd.DataFrame({**{k: [v] * len(src) for k, v in kv.items()}, "src": src, "dst": dst}))
            if out:
                yield pd.concat(out, ignore_index=True)

    return pairs.mapInPandas(fn, schema)


def component_counts(blocks: DataFrame, keys: Sequence[str], eps: float) -> DataFrame:
    """``(keys, spk_count)``: components of ``dist <= eps`` among the vectors
    of each row of ``blocks``."""
    keys = list(keys)
    schema = T.StructType([*[blocks.schema[k] for k in keys], T.StructField("spk_count", T.LongType())])

    def fn(batches):
        for b in batches:
            counts = []
            for vecs in b.column(len(keys)).to_pylist():
                i, j = np.nonzero(np.triu(_cos_dist(vecs, vecs) <= eps, k=1))
                counts.append(len(np.unique(_components_small(len(vecs), i, j))))
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keys)], pa.array(counts, pa.int64())], names=schema.names)

    return blocks.select(*keys, "vecs").mapInArrow(fn, schema)
