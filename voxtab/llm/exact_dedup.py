"""Exact dedup against a minimal perfect hash of historical digests.

``build_index`` puts the distinct digests of a history into a minimal perfect
hash. Digests are dealt into buckets by their leading bits; each bucket holds
a bounded number of keys, gets a displacement table (hash, displace) and a
run of consecutive slots, so every historical digest owns exactly one slot
number in [0, n). A slot holds the full digest and the winner's locator.

``look_up`` sends the distinct digests of a batch to their buckets, computes
each one's slot from the displacement table and compares the slot's full
digest byte by byte. A match is a repeat of the historical winner. A minimal
perfect hash maps non-members to arbitrary slots; the comparison rejects
them, and they are grouped among themselves.

Rows are reduced per digest (map-side) before anything is grouped, so a text
that fills a third of the table is one record in its bucket; its rows return
by an equi-join that AQE may split. Only digests and ids are shuffled, never
texts. The digest table is written once to the shared checkpoint folder.

Defined cases: a null text counts as empty; empty texts equal each other and
texts of white space only are one space. A null doc_id ranks after all
others; of rows tied on the smallest doc_id exactly one stays (the first in
scan order). An empty history or batch gives an empty index or result. Other
columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxtab.llm.common import SPACE, free_name, materialise, require, text_of

#: Mean keys in a bucket; buckets are uniform because digests are.
BUCKET_KEYS = 2048
#: Keys that share a displacement, on average.
PILOT_KEYS = 4


def _digest() -> Column:
    normal = F.regexp_replace(text_of("text"), SPACE + "+", " ")
    return F.unhex(F.sha2(normal.cast("binary"), 256))


def _id_key(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, row, digest): sha256 of the white-space-normalised text and
    a row number that tells repeated rows apart."""
    require(docs, ["doc_id", "text"])
    return docs.select("doc_id", F.monotonically_increasing_id().alias("row"), _digest().alias("digest"))


def _bucketed(df: DataFrame, bits: int) -> DataFrame:
    head = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long")
    return df.withColumn("bucket", F.shiftright(head, 32 - bits))


def _halves(raw) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit numbers of each digest (bytes 8-15, 16-23)."""
    both = np.frombuffer(b"".join(raw), dtype=">u8").reshape(-1, 4)
    return both[:, 1].astype(np.uint64), both[:, 2].astype(np.uint64)


def _place(base: np.ndarray, displacement: np.ndarray | int, n: int) -> np.ndarray:
    """Slot of each key inside its bucket, given its displacement."""
    x = base ^ (np.asarray(displacement, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    return (x % np.uint64(n)).astype(np.int64)


def displacements(choice: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For one bucket's keys: a displacement for each key group, largest
    groups first, such that all keys take different slots. Returns the table
    and each key's slot."""
    n = len(base)
    groups = max(1, math.ceil(n / PILOT_KEYS))
    member = (choice % np.uint64(groups)).astype(np.int64)
    table, slots, taken = np.zeros(groups, np.int64), np.zeros(n, np.int64), np.zeros(n, bool)
    order = np.argsort(member, kind="stable")
    ends = np.cumsum(np.bincount(member, minlength=groups))
    for g in sorted(range(groups), key=lambda g: (-(ends[g] - (ends[g - 1] if g else 0)), g)):
        keys = order[ends[g - 1] if g else 0 : ends[g]]
        if not len(keys):
            break
        start, found = 0, False
        while not found:
            trial = np.arange(start, start + 256)
            at = _place(base[keys][None, :], trial[:, None], n)
            free = ~taken[at].any(axis=1)
            if len(keys) > 1:
                ranked = np.sort(at, axis=1)
                free &= (ranked[:, 1:] != ranked[:, :-1]).all(axis=1)
            hits = np.flatnonzero(free)
            if len(hits):
                found, table[g] = True, trial[hits[0]]
                slots[keys] = at[hits[0]]
                taken[slots[keys]] = True
            start += 256
    return table, slots


LOCATOR = "struct<no_id:boolean,doc_id:bigint,row:bigint>"
INDEX = f"bucket long, table array<long>, digests array<binary>, locators array<{LOCATOR}>"
FOUND = f"digest binary, locator {LOCATOR}, n long, slot long, history {LOCATOR}"
_LOCATOR = pa.struct([("no_id", pa.bool_()), ("doc_id", pa.int64()), ("row", pa.int64())])
_INDEX = pa.schema({"bucket": pa.int64(), "table": pa.list_(pa.int64()), "digests": pa.list_(pa.binary()), "locators": pa.list_(_LOCATOR)})
_FOUND = pa.schema({"digest": pa.binary(), "locator": _LOCATOR, "n": pa.int64(), "slot": pa.int64(), "history": _LOCATOR})


def _build(group: pa.Table) -> pa.Table:
    keys = group["digest"].combine_chunks()
    choice, base = _halves(keys.to_pylist())
    table, slots = displacements(choice, base)
    order, ends = np.argsort(slots), [0, len(keys)]
    return pa.table(
        {
            "bucket": group["bucket"].slice(0, 1),
            "table": pa.array([table.tolist()], pa.list_(pa.int64())),
            "digests": pa.ListArray.from_arrays(ends, keys.take(pa.array(order))),
            "locators": pa.ListArray.from_arrays(ends, group["locator"].combine_chunks().take(pa.array(order))),
        }
    ).cast(_INDEX)


def winners(rows: DataFrame) -> DataFrame:
    """(digest, locator, n): the row that stays for each distinct digest."""
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").cast("long").alias("doc_id"), "row")
    return rows.groupBy("digest").agg(F.min(key).alias("locator"), F.count("*").alias("n"))


def index_bits(n_keys: int) -> int:
    """Leading digest bits that name a bucket."""
    return max(0, math.ceil(math.log2(max(1, n_keys) / BUCKET_KEYS)))


def build_index(history: DataFrame, bits: int) -> DataFrame:
    """The perfect hash of ``winners(history)``: a row for each bucket with
    its displacement table and its slots (digest and locator, in slot
    order). Slot numbers over all buckets: a bucket's slots follow those of
    the buckets before it."""
    keyed = _bucketed(history.select("digest", "locator"), bits)
    return keyed.groupBy("bucket").applyInArrow(_build, INDEX)


def _look(batch: pa.Table, index: pa.Table) -> pa.Table:
    slots, history = [None] * len(batch), pa.nulls(len(batch), batch.schema.field("locator").type)
    if len(batch) and len(index):
        mine = batch["digest"].to_pylist()
        choice, base = _halves(mine)
        table = index["table"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        held = index["digests"].combine_chunks().flatten()
        at = _place(base, table[(choice % np.uint64(len(table))).astype(np.int64)], len(held))
        there = held.take(pa.array(at)).to_pylist()
        slots = [int(s) if x == y else None for s, x, y in zip(at, mine, there, strict=True)]
        history = index["locators"].combine_chunks().flatten().take(pa.array(slots, pa.int64()))
    found = {n: batch[n] for n in ("digest", "locator", "n")}
    return pa.table(found | {"slot": pa.array(slots, pa.int64()), "history": history}).cast(_FOUND)


def look_up(batch: DataFrame, index: DataFrame, bits: int) -> DataFrame:
    """``winners`` rows of a batch with ``history``: the locator held in the
    digest's slot if the slot's digest is equal to it byte by byte, else
    null (the digest is new), and its ``slot`` inside the bucket or null."""
    keyed = _bucketed(batch, bits)
    return keyed.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInArrow(_look, FOUND)


def dedup(history: DataFrame, batch: DataFrame) -> DataFrame:
    """``digests`` rows of history and batch -> one row per row of both:
    doc_id, row, digest, keep_id, group_size, kept, seen_before (its text is
    in the history's index and the row comes from the batch)."""
    old = winners(history)
    n_old = old.count()
    bits = index_bits(n_old)
    found = look_up(winners(batch), build_index(old, bits), bits)
    parts = old.select("digest", "locator", "n", F.lit(False).alias("repeat")).unionByName(
        found.select("digest", F.coalesce("history", "locator").alias("locator"), "n", F.col("history").isNotNull().alias("repeat"))
    )
    groups = parts.groupBy("digest").agg(
        F.min("locator").alias("locator"), F.sum("n").alias("group_size"), F.max("repeat").alias("repeat")
    )
    rows = history.withColumn("new", F.lit(False)).unionByName(batch.withColumn("new", F.lit(True)))
    return rows.join(groups, "digest").select(
        "doc_id",
        "row",
        "digest",
        F.col("locator")["doc_id"].alias("keep_id"),
        "group_size",
        (F.col("locator")["row"] == F.col("row")).alias("kept"),
        (F.col("new") & F.col("repeat")).alias("seen_before"),
    )


def dedup_table(docs: DataFrame) -> DataFrame:
    """Dedup of one table. The rows with the smaller half of the ids form the
    history (they came first, so a repeat's winner is in it if any copy is),
    the rest and rows without id the batch that is looked up in its index."""
    rows = materialise(digests(docs), "digests")
    half = rows.select(F.percentile_approx("doc_id", 0.5, 1000).alias("half")).first()["half"]
    first = F.col("doc_id") <= F.lit(half) if half is not None else F.lit(False)
    first = F.coalesce(first, F.lit(False))
    return dedup(rows.where(first), rows.where(~first))


def drop_repeats(docs: DataFrame) -> DataFrame:
    """The documents that stay, with their own columns. Texts meet the list
    of winners by (digest, id); of rows tied in both one stays."""
    winner = dedup_table(docs).where("kept").select(
        F.col("digest").alias(d := free_name(docs, "_digest")), _id_key("doc_id").alias(k := free_name(docs, "_id"))
    )
    keyed = docs.withColumns({d: _digest(), k: _id_key("doc_id")})
    return keyed.join(winner, [d, k], "left_semi").dropDuplicates([d, k]).drop(d, k)
