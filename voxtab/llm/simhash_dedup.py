"""Near-duplicates by SimHash: fingerprints within a few bits of each other
are linked, links form components.

Pairs are found with vantage-point trees. A fingerprint's bits are cut into
``bands``; two fingerprints within ``max_bits`` of each other differ in at
most ``max_bits // bands`` bits of some band, so one tree per band, searched
with that smaller radius, finds every pair. A tree level holds a vantage
point and a radius: band values at a Hamming distance up to the radius are
inside, others outside. Each fingerprint has one home shard (leaf) per tree;
where its distance to a vantage point is within the search radius of the
boundary, the triangle inequality cannot rule the other side out, and it also
visits the shards there. All other branches are pruned. In a shard, home
fingerprints are compared with each other and with the visitors by the full
64 bits, so the links are exact.

Vantage points and radii come from a bounded sample (``SAMPLE`` fingerprints);
they steer only how even the shards are. The number of levels follows the
number of distinct fingerprints, so a shard's homes stay near ``SHARD``. A
dense shard is cut further, its homes and its visitors both by a hash, and
each pair of parts is a group of its own (``deal``): more work, spread over
tasks of bounded size, never a dropped pair.

Work: a point makes about ``bands * (1 + p) ** levels`` visits, where p is the
share of distances near a boundary (about 0.35 with three bands). Copies share
a fingerprint and count once here, so a group of copies costs one entry; its
rows meet the result in an equi-join that AQE may split. A shard returns a
spanning star of its links, never all pairs of a dense group; components are
built from those by label propagation in Spark.

Defined cases: a null or empty text, or one of white space only, has
fingerprint zero and links like any other. Rows with a null doc_id take part;
their component is the smallest id in it, null if it holds none. Repeated
rows share a component. An empty table gives an empty result. Other columns
are ignored by ``components`` and kept by ``drop_near_copies``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxtab.llm.common import add_columns, free_name, materialise, require
from voxtab.plans.graph import connected_components

SHINGLE, MAX_BITS, BANDS = 4, 4, 3
SHARD, SAMPLE, SEED = 2048, 4096, 42
#: Visitors of a cell, as a multiple of a shard's homes.
VISITORS = 8
_CHUNK = 1 << 16
_CELLS = "array<struct<first:int,second:int,visit:boolean>>"


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of the word shingles, as a signed 64-bit integer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    first = np.r_[0, ends[:-1] + 1]
    k = min(shingle, len(words))
    starts, stops = first[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist()
    count, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(starts), _CHUNK):
        some = zip(starts[at : at + _CHUNK], stops[at : at + _CHUNK], strict=True)
        h = np.array([digest(line[a:b], SEED) for a, b in some], dtype="<u8")
        count += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * count > len(starts), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, text: str = "text", out: str = "fp") -> DataFrame:
    """``docs`` plus ``out``."""

    def start():
        return lambda texts: [pa.array([fingerprint(t.as_py(), shingle) for t in texts], pa.int64())]

    return add_columns(docs, text, [T.StructField(out, T.LongType())], start)


@dataclass
class Tree:
    """One band's tree: bit mask, search radius, and per level the vantage
    point and the radius of its ball. Shard numbers hold a side per level."""

    number: int
    mask: np.uint64
    reach: int
    points: np.ndarray
    radii: np.ndarray

    def route(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in ``fps``, shard, visits) of homes and visits."""
        at = np.arange(len(fps))
        shard, visit = np.full(len(fps), self.number << 56, np.int64), np.zeros(len(fps), bool)
        for level, (point, radius) in enumerate(zip(self.points, self.radii, strict=True)):
            d = np.bitwise_count((fps[at] ^ point) & self.mask).astype(np.int64)
            inside = d <= radius
            # a visitor goes wherever the bound allows; a home only spawns visits outwards, so a pair meets once
            go_in = np.where(visit, d <= radius + self.reach, inside)
            go_out = np.where(visit, d > radius - self.reach, ~inside)
            spawn = ~visit & inside & (d > radius - self.reach)
            sides = [(go_in, 0, visit[go_in]), (go_out, 1, visit[go_out]), (spawn, 1, np.ones(int(spawn.sum()), bool))]
            shard = np.concatenate([shard[m] | (side << level) for m, side, _ in sides])
            at, visit = np.concatenate([at[m] for m, _, _ in sides]), np.concatenate([v for *_, v in sides])
        return at, shard, visit


def plant(sample: np.ndarray, n: int, max_bits: int, bands: int, shard: int) -> list[Tree]:
    """Trees for ``n`` distinct fingerprints, from a sample of them."""
    levels = max(0, math.ceil(math.log2(max(1, n) / shard)))
    rng = np.random.default_rng(SEED)
    edges = [round(64 * i / bands) for i in range(bands + 1)]
    trees = []
    for number, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False)):
        mask = np.uint64(((1 << hi) - 1) ^ ((1 << lo) - 1))
        points, radii = np.zeros(0, np.uint64), []
        for _ in range(levels):
            some = rng.choice(sample, min(256, len(sample)), replace=False) & mask
            if len(points):  # as far from being alike as from being opposite: levels then divide independently
                skew = np.abs(np.bitwise_count(some[:, None] ^ points[None, :]).astype(float) - (hi - lo) / 2).max(axis=1)
                some = some[np.argsort(skew, kind="stable")]
            points = np.append(points, some[0])
            radii.append(math.floor(np.median(np.bitwise_count((sample ^ points[-1]) & mask)) - 0.5))
        trees.append(Tree(number, mask, max_bits // bands, points, np.array(radii, np.int64)))
    return trees


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Components of the edges (a, b) as pairs (member, smallest member)."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    far = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[far], nodes[label[far]]


def _compare(max_bits: int):
    def run(key: tuple, group: pa.Table) -> pa.Table:
        _, first, second = (k.as_py() for k in key)
        fps, visit = group["fp"].to_numpy().view(np.uint64), group["visit"].to_numpy()
        home = fps[~visit]
        everyone = np.concatenate([home, fps[visit]]) if first == second else fps[visit]  # homes meet in their own cell
        a = b = np.zeros(0, np.uint64)
        step = max(1, (1 << 21) // max(1, len(home)))
        for i in range(0, len(everyone), step):
            rows = everyone[i : i + step]
            r, c = np.nonzero(np.bitwise_count(rows[:, None] ^ home[None, :]) <= max_bits)
            r, c = rows[r], home[c]
            r, c = r[r != c], c[r != c]
            if len(r):
                a, b = stars(np.concatenate([a, r]), np.concatenate([b, c]))
        return pa.table({"src": a.view(np.int64), "dst": b.view(np.int64)})

    return run


def deal(routed: DataFrame, shard: int = SHARD) -> DataFrame:
    """``routed`` (fp, shard, visit) by cells (shard, first, second) of
    bounded size in which all homes and visitors of a shard meet once. Homes
    of a dense shard fall into ``p`` parts, its visitors into ``q``. Home part
    ``i`` is held in the cells (i, i) to (i, p - 1), where the later home
    parts visit it, and in one more for each part of the visitors but the
    first, which visits it in (i, i). Usual shards are the one cell (0, 0)."""
    count = lambda c: F.sum(c.cast("long"))
    sizes = routed.groupBy("shard").agg(count(~F.col("visit")).alias("homes"), count(F.col("visit")).alias("visitors"))
    dense = sizes.where((F.col("homes") > 2 * shard) | (F.col("visitors") > VISITORS * shard)).select(
        "shard",
        F.when(F.col("homes") > 2 * shard, F.ceil(F.col("homes") / shard)).otherwise(1).cast("int").alias("p"),
        F.greatest(F.lit(1), F.ceil(F.col("visitors") / (VISITORS * shard))).cast("int").alias("q"),
    )
    p, q, own = F.coalesce("p", F.lit(1)), F.coalesce("q", F.lit(1)), F.col("own")
    parted = routed.join(dense, "shard", "left").select("fp", "shard", "visit", p.alias("p"), q.alias("q"))
    parted = parted.withColumn("own", F.pmod(F.xxhash64("fp"), F.when(F.col("visit"), F.col("q")).otherwise(F.col("p"))).cast("int"))
    cell = lambda first, second, visit: F.struct(first.alias("first"), second.alias("second"), F.lit(visit).alias("visit"))
    held = F.transform(F.sequence(own, F.col("p") + F.col("q") - 2), lambda x: cell(own, x, False))
    earlier = F.when(own > 0, F.transform(F.sequence(F.lit(0), own - 1), lambda x: cell(x, own, True))).otherwise(F.array().cast(_CELLS))
    asking = F.transform(F.sequence(F.lit(0), F.col("p") - 1), lambda x: cell(x, F.when(own == 0, x).otherwise(F.col("p") - 1 + own), True))
    cells = F.when(F.col("visit"), asking).otherwise(F.concat(held, earlier))
    return parted.select("fp", "shard", F.inline(cells))


def links(distinct: DataFrame, max_bits: int = MAX_BITS, bands: int = BANDS, shard: int = SHARD) -> DataFrame:
    """Edges (src, dst) that connect exactly the distinct fingerprints ``fp``
    connected by differences of at most ``max_bits`` bits."""
    n = distinct.count()
    sample = distinct.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).toArrow()["fp"].to_numpy().astype(np.int64)
    trees = plant(sample.view(np.uint64), n, max_bits, bands, shard)
    batch_schema = pa.schema([("fp", pa.int64()), ("shard", pa.int64()), ("visit", pa.bool_())])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = b["fp"].to_numpy(zero_copy_only=False).astype(np.int64)
            for i in range(0, len(fps), 2048):
                some = fps[i : i + 2048]
                for tree in trees:
                    at, to, visit = tree.route(some.view(np.uint64))
                    yield pa.RecordBatch.from_arrays([pa.array(some[at]), pa.array(to), pa.array(visit)], schema=batch_schema)

    routed = distinct.select("fp").mapInArrow(route, "fp long, shard long, visit boolean")
    return deal(routed, shard).groupBy("shard", "first", "second").applyInArrow(_compare(max_bits), "src long, dst long")


def components(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, bands: int = BANDS, shard: int = SHARD) -> DataFrame:
    """doc_id, fp and component_id of every row."""
    require(docs, ["doc_id", "text"])
    rows = materialise(fingerprints(docs.select("doc_id", "text"), shingle).select("doc_id", "fp"), "fingerprints")
    groups = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    edges = materialise(links(groups, max_bits, bands, shard).distinct(), "fingerprint-links")
    nodes = edges.select(F.col("src").alias("node")).union(edges.select("dst")).distinct()
    labels = connected_components(nodes, edges).select(F.col("node").alias("fp"), "label")
    rooted = groups.join(labels, "fp", "left").withColumn("root", F.coalesce("label", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    member = rooted.join(least, "root").select("fp", "component_id")
    return rows.join(member, "fp").select("doc_id", "fp", "component_id")


def hex_fingerprint(col: str = "fp"):
    return F.lower(F.lpad(F.hex(col), 16, "0"))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """The document with the smallest id of each component, with its own
    columns; of rows that share that id one stays. Where no row of a component
    has an id, one stays for each of its fingerprints."""
    k, f = free_name(docs, "_key"), free_name(docs, "_fp")
    found = components(docs.select("doc_id", "text"))
    chosen = found.where("component_id IS NOT NULL").select(F.col("component_id").alias(k)).distinct()
    named = docs.withColumn(k, F.col("doc_id")).join(chosen, k, "left_semi").dropDuplicates([k]).drop(k)
    nameless = found.where("component_id IS NULL").select(F.col("fp").alias(f)).distinct()
    rest = fingerprints(docs.where("doc_id IS NULL"), out=f).join(nameless, f, "left_semi").dropDuplicates([f])
    return named.unionByName(rest.drop(f))
