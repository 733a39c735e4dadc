"""Near-duplicates by SuperMinHash: documents whose sets of word shingles have
a Jaccard similarity of at least ``NEAR`` are linked, links form components.

SuperMinHash draws, for every element, one random permutation of the slots of
the signature; at step j the element offers ``j + r`` (r a uniform fraction)
to the j-th slot of its permutation, and a slot keeps the least offer. The
ranks of an element over the slots are correlated (each slot is met exactly
once), so the share of equal slots estimates the similarity with less
variance than independent hashes. Steps can stop early: once every slot of a
document holds an offer of step j or less, later steps cannot win. Here all
elements of a batch of documents take a step together, and documents that are
full leave; large sets end after one or two steps.

Candidates come from banding: ``BANDS`` bands of ``ROWS`` slots; a pair at the
threshold misses all of them with probability 5e-8. Equal sets are one node
first, so copies cost one entry. No bucket emits all its pairs:

1. In every bucket the member that shares most with others leads, and each
   member is verified against its leaders. Links form components (union-find
   by label propagation in Spark).
   The cut on the number of equal slots before that loses a pair at the
   threshold with a probability under 1e-8.
2. Buckets whose members ended in one component are settled. In the others
   the whole sets of all members meet, in blocks of bounded size (a crowded
   bucket is a set of block pairs, spread over tasks): the product of the
   member-by-shingle matrix with itself holds all intersections, and a call
   returns a spanning forest of the components that it links, never pairs.

Verification is exact: shingle sets of whole texts, as 64-bit hashes, are
intersected, and ``100 * intersection >= NEAR * union`` decides. Sets are
computed again for the candidates only, so they are not stored for all rows.

Defined cases: a null or empty text, or one of white space only, has no
shingles and links with nothing, itself being its component. Fewer words than
a shingle make one shingle, the whole sequence. Rows with a null doc_id take
part; a component is named by the smallest id in it, null if it holds none.
Repeated rows share a component. An empty table gives an empty result. Other
columns are ignored."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxtab.llm.common import add_columns, materialise, require
from voxtab.plans.graph import connected_components

#: Words of a shingle, and the least similarity in hundredths.
SHINGLE, NEAR = 5, 80
#: Slots of a signature, cut into bands.
SLOTS, ROWS = 128, 4
BANDS = SLOTS // ROWS
#: Members of a bucket that are compared in one block; shingles of small buckets that share a call.
BLOCK, PACK = 512, 1 << 20
#: Cells of a member-by-shingle matrix that are filled at a time.
CELLS = 1 << 23
#: Elements that take their steps together.
ELEMENTS = 1 << 17
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_GOLDEN = 0x9E3779B97F4A7C15


def _mix(z: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def draw(elements: np.ndarray, step: int) -> np.ndarray:
    """64 random bits of every element for a step."""
    return _mix(elements + np.uint64((step + 1) * _GOLDEN & 0xFFFFFFFFFFFFFFFF))


def shingles(text: str | None, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    k = min(k, len(words))
    total = np.full(len(words) - k + 1, k, np.uint64)
    for i in range(k):
        total += _mix(h[i : len(h) - k + 1 + i] + np.uint64(i + 1)) * np.uint64(2 * i + 1)
    return np.unique(_mix(total))


def signatures(elements: np.ndarray, owner: np.ndarray, n: int, slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash signatures (n, slots) of ``n`` sets; ``owner`` names the
    set of each element. A slot holds step << 32 | fraction; slots of an empty
    set hold the largest value."""
    sig = np.full(n * slots, _EMPTY, np.uint64)
    live, order = np.arange(len(elements)), None
    for step in range(slots):
        z = draw(elements[live], step)
        at = step + (((z & np.uint64(0xFFFFFFFF)) * np.uint64(slots - step)) >> np.uint64(32)).astype(np.int64)
        if order is None:
            slot = at
        else:
            rows = np.arange(len(live))
            slot = order[rows, at].astype(np.int64)
            order[rows, at] = order[rows, step]
        np.minimum.at(sig, owner[live] * slots + slot, np.uint64(step << 32) | (z >> np.uint64(32)))
        full = (sig.reshape(n, slots) != _EMPTY).all(axis=1)
        on = ~full[owner[live]]
        if not on.any():
            break
        live = live[on]
        if order is None:  # the permutations of those that go on, after their first swap
            order = np.tile(np.arange(slots, dtype=np.uint16), (len(live), 1))
            order[np.arange(len(live)), at[on]] = 0
        else:
            order = order[on]
    return sig.reshape(n, slots)


def band_keys(sig: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """(n, bands) keys: equal where all slots of a band are."""
    bands = sig.shape[1] // rows
    parts = sig[:, : bands * rows].reshape(len(sig), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for i in range(rows):
        key = _mix(key + parts[:, :, i])
    return key.view(np.int64)


def least_equal(slots: int = SLOTS, near: int = NEAR, loss: float = 1e-8) -> int:
    """The largest count c such that a pair at the threshold has fewer than c
    equal slots with a probability of at most ``loss`` (binomial bound)."""
    p, tail = near / 100, 0.0
    for c in range(slots + 1):
        tail += math.comb(slots, c) * p**c * (1 - p) ** (slots - c)
        if tail > loss:
            return c
    return slots


def sketch(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, digest of the set (null if empty), marks (a byte of
    each slot) and bands."""
    fields = [
        T.StructField("n_shingles", T.LongType()),
        T.StructField("digest", T.BinaryType()),
        T.StructField("marks", T.BinaryType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
    ]

    def compute(texts: pa.Array) -> list[pa.Array]:
        sizes, digests, marks, bands = [], [], [], []
        pending, weight = [], 0

        def flush():
            sig = signatures(np.concatenate(pending), np.repeat(np.arange(len(pending)), [len(s) for s in pending]), len(pending))
            sizes.extend(len(s) for s in pending)
            digests.extend(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in pending)
            marks.extend(m.tobytes() for m in sig.astype(np.uint8))
            bands.extend(band_keys(sig).tolist())
            pending.clear()

        for t in texts:
            pending.append(shingles(t.as_py(), shingle))
            weight += len(pending[-1])
            if weight >= ELEMENTS:
                flush()
                weight = 0
        if pending:
            flush()
        return [pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(marks, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]

    return add_columns(docs.select("doc_id", "text"), "text", fields, lambda: compute).drop("text")


def shingle_sets(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, digest and the sorted shingle hashes of whole texts."""
    fields = [T.StructField("digest", T.BinaryType()), T.StructField("hashes", T.ArrayType(T.LongType()))]

    def compute(texts: pa.Array) -> list[pa.Array]:
        sets = [shingles(t.as_py(), shingle) for t in texts]
        offsets = np.r_[0, np.cumsum([len(s) for s in sets])].astype(np.int32)
        flat = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
        digests = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
        return [pa.array(digests, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))]

    return add_columns(docs.select("doc_id", "text"), "text", fields, lambda: compute).drop("text")


def _bytes(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), width)


def promising(pairs: DataFrame, nodes: DataFrame, near: int = NEAR) -> DataFrame:
    """Those of the ``pairs`` (a, b) whose sizes and marks could belong to
    sets at the threshold."""
    cut = least_equal(near=near)
    one = nodes.select(F.col("digest").alias("a"), F.col("n_shingles").alias("n_a"), F.col("marks").alias("m_a"))
    two = nodes.select(F.col("digest").alias("b"), F.col("n_shingles").alias("n_b"), F.col("marks").alias("m_b"))
    least, most = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    met = pairs.join(two, "b").join(one, "a").where(100 * least >= near * most).select("a", "b", "m_a", "m_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            equal = (_bytes(b.column(2), SLOTS) == _bytes(b.column(3), SLOTS)).sum(axis=1)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(equal >= cut))

    return met.mapInArrow(run, "a binary, b binary")


def verified(pairs: DataFrame, sets: DataFrame, near: int = NEAR) -> DataFrame:
    """Those of the ``pairs`` whose whole sets reach the threshold."""
    one, two = (sets.select(F.col("digest").alias(n), F.col("hashes").alias(f"h_{n}")) for n in ("a", "b"))
    both = F.size(F.array_intersect("h_a", "h_b"))
    union = F.size("h_a") + F.size("h_b") - both
    return pairs.join(two, "b").join(one, "a").where(100 * both >= near * union).select("a", "b")


def intersections(sets: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets ``x`` with the sets ``y``
    (places in ``sets``)."""
    out = np.zeros((len(x), len(y)), np.float32)
    value, at, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = times[at] > 1  # what one set alone holds is in no intersection
    column = np.cumsum(times > 1) - 1
    at, owner = column[at[shared]], owner[shared]
    width = int((times > 1).sum())
    step = max(1, CELLS // len(sets))
    order = np.argsort(at, kind="stable")
    at, owner = at[order], owner[order]
    for lo in range(0, width, step):
        s, e = np.searchsorted(at, [lo, lo + step])
        m = np.zeros((len(sets), min(step, width - lo)), np.float32)
        m[owner[s:e], at[s:e] - lo] = 1
        out += m[x] @ m[y].T
    return out.astype(np.int64)


def _across(near: int):
    """Links between the members of buckets that lie in different components,
    as a spanning forest of the components of the call; a row's ``own`` tells
    its block where a bucket is cut into several."""

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        key = group["key"].to_numpy()
        order = np.argsort(key, kind="stable")
        starts = np.r_[0, np.flatnonzero(np.diff(key[order])) + 1, len(order)]
        digest, label = group["digest"].to_pylist(), group["label"].to_pylist()
        own, lo, hi = (group[c].to_numpy() for c in ("own", "lo", "hi"))
        hashes = group["hashes"].combine_chunks()
        root: dict[bytes, bytes] = {}
        pairs = []

        def find(a: bytes) -> bytes:
            while (up := root.get(a, a)) != a:
                root[a] = a = root.get(up, up)
            return a

        for s, e in zip(starts, starts[1:], strict=False):
            at = order[s:e]
            some = [find(label[i]) for i in at]
            if len(set(some)) < 2:
                continue
            sets = [hashes[int(i)].values.to_numpy() for i in at]
            size = np.array([len(h) for h in sets])
            place = {name: i for i, name in enumerate(dict.fromkeys(some))}
            part = np.array([place[name] for name in some])
            x, y = np.flatnonzero(own[at] == lo[at]), np.flatnonzero(own[at] == hi[at])
            both = intersections(sets, x, y)
            linked = 100 * both >= near * (size[x][:, None] + size[y][None, :] - both)
            for i, j in zip(*np.nonzero(linked & (part[x][:, None] != part[y][None, :])), strict=True):
                a, b = at[x[i]], at[y[j]]
                one, two = find(label[a]), find(label[b])
                if one != two:
                    root[max(one, two)] = min(one, two)
                    pairs.append((digest[a], digest[b]))
        return pa.table({"a": pa.array([p[0] for p in pairs], pa.binary()), "b": pa.array([p[1] for p in pairs], pa.binary())})

    return run


def across(members: DataFrame, sets: DataFrame, near: int = NEAR) -> DataFrame:
    """Links (a, b) that connect the components whose members share a bucket
    and reach the threshold. ``members``: key, digest, size, label."""
    split = members.groupBy("key").agg(F.min("label").alias("_lo"), F.max("label").alias("_hi")).where("_lo != _hi").select("key")
    rest = members.where("size > 2").join(split, "key")  # a bucket of two was settled by its leader
    rest = rest.join(sets.select("digest", F.size("hashes").cast("long").alias("n")), "digest")
    rest = materialise(rest, "minhash-open-buckets")
    large, parts = F.col("size") > BLOCK, F.ceil(F.col("size") / BLOCK).cast("long")
    small = rest.where(~large).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    packs = max(1, math.ceil(small / PACK))
    own = F.when(large, F.pmod(F.xxhash64("digest"), parts)).otherwise(F.lit(0).cast("long"))
    partner = F.when(large, F.sequence(F.lit(0).cast("long"), parts - 1)).otherwise(F.array(F.lit(0).cast("long")))
    dealt = (
        rest.withColumn("own", own)
        .withColumn("partner", F.explode(partner))
        .withColumn("lo", F.least("own", "partner"))
        .withColumn("hi", F.greatest("own", "partner"))
        .withColumn("pack", F.when(large, F.col("key")).otherwise(F.pmod(F.xxhash64("key"), F.lit(packs))))
        .withColumn("large", large)
        .join(sets, "digest")
        .select("large", "pack", "key", "own", "lo", "hi", "digest", "label", "hashes")
    )
    return dealt.groupBy("large", "pack", "lo", "hi").applyInArrow(_across(near), "a binary, b binary").distinct()


def _labels(pairs: DataFrame) -> DataFrame:
    """digest and label of the nodes that the pairs touch."""
    edges = pairs.select(F.col("a").alias("src"), F.col("b").alias("dst"))
    touched = edges.select(F.col("src").alias("node")).union(edges.select("dst")).distinct()
    return connected_components(touched, edges).select(F.col("node").alias("digest"), "label")


def labels(docs: DataFrame, nodes: DataFrame, shingle: int = SHINGLE, near: int = NEAR) -> DataFrame:
    """digest and label of every node: equal labels for sets that pairs at
    the threshold connect. ``nodes``: digest, least (a doc_id that has it),
    n_shingles, marks, bands."""
    keyed = nodes.select("digest", F.explode("bands").alias("key"))
    crowd = keyed.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = materialise(keyed.join(crowd, "key").select("key", "digest", "size"), "minhash-buckets")
    degree = members.groupBy("digest").agg(F.sum(F.col("size") - 1).alias("shared"))
    lead = members.join(degree, "digest").groupBy("key").agg(F.max(F.struct("shared", "digest"))["digest"].alias("a"))
    stars = members.join(lead, "key").where("a != digest").select("a", F.col("digest").alias("b")).distinct()
    tried = materialise(promising(stars, nodes, near), "minhash-stars")

    # whole sets of every member, once; null ids are looked up among rows without one
    wanted = nodes.join(members.select("digest").distinct(), "digest", "left_semi").select("digest", "least")
    ids = wanted.where("least IS NOT NULL").select(F.col("least").alias("doc_id")).distinct()
    texts = docs.select("doc_id", "text")
    some = texts.join(ids, "doc_id", "left_semi").unionByName(texts.where("doc_id IS NULL"))
    sets = shingle_sets(some, shingle).join(wanted.select("digest"), "digest", "left_semi").dropDuplicates(["digest"])
    sets = materialise(sets.select("digest", "hashes"), "minhash-sets")

    first = materialise(_labels(verified(tried, sets, near)), "minhash-labels")
    everyone = nodes.select("digest").join(first, "digest", "left").withColumn("label", F.coalesce("label", "digest"))
    # a row per set, with its at most BANDS buckets, meets its label
    buckets = members.groupBy("digest").agg(F.collect_list(F.struct("key", "size")).alias("in"))
    labelled = buckets.join(first, "digest", "left").withColumn("label", F.coalesce("label", "digest"))
    placed = labelled.select("digest", "label", F.inline("in")).select("key", "digest", "size", "label")
    second = materialise(across(materialise(placed, "minhash-placed"), sets, near), "minhash-more-links")
    if not second.isEmpty():
        # later links join the components of the first; only the ends of a link look up their labels, once
        ends = [first.select(F.col("digest").alias(n), F.col("label").alias(f"l_{n}")) for n in ("a", "b")]
        named = second.join(ends[0], "a", "left").join(ends[1], "b", "left")
        joined = materialise(named.select(F.coalesce("l_a", "a").alias("a"), F.coalesce("l_b", "b").alias("b")), "minhash-later-links")
        moved = _labels(joined).select(F.col("digest").alias("label"), F.col("label").alias("to"))
        everyone = everyone.join(moved, "label", "left").select("digest", F.coalesce("to", "label").alias("label"))
    return materialise(everyone, "minhash-all-labels")


def components(docs: DataFrame, shingle: int = SHINGLE, near: int = NEAR) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    require(docs, ["doc_id", "text"])
    rows = materialise(sketch(docs, shingle), "minhash-signatures")
    nodes = rows.where("n_shingles > 0").groupBy("digest").agg(
        F.min("doc_id").alias("least"), *[F.first(c).alias(c) for c in ("n_shingles", "marks", "bands")]
    )
    nodes = materialise(nodes, "minhash-nodes")
    rooted = nodes.select("digest", "least").join(labels(docs, nodes, shingle, near), "digest")
    least = rooted.groupBy("label").agg(F.min("least").alias("component_id"))
    member = rooted.join(least, "label").select("digest", "component_id")
    full = rows.where("n_shingles > 0").select("doc_id", "n_shingles", "digest").join(member, "digest")
    void = rows.where("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    both = full.select("doc_id", "n_shingles", "component_id").unionByName(void.select("doc_id", "n_shingles", "component_id"))
    return both.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
