"""Distributed folds without a per-key fold.

Greedy, order-dependent rules ("append until the sum passes a limit, then
start over", "cut here, which moves the clip start") are path-dependent, but
in each of them the *next* decision point depends only on the current one.
So a fold becomes:

1. ``successor``: for every decision point, the first later point that
   satisfies a threshold (a merge of two sorted sequences, done as one
   distributed scan over their union);
2. ``chain_walk``: the points reachable from the start by following those
   successor pointers: bounded runs of consecutive points are passed in one
   task each, and the short chain from run to run is walked by pointer
   doubling (equi-joins on ``(key, node)``, lineage cut by checkpoints).

No key is collected into one row, one array or one task at any step, so a
recording holding a third of the corpus is spread like any other data.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtab.plans.scan import ordered_scan
from voxtab.session import cut_lineage


def successor(points: DataFrame, queries: DataFrame, keys: Sequence[str], strict: bool = False) -> DataFrame:
    """For each query ``(keys, qid, value)`` find the point ``(keys, pid,
    value)`` with the smallest value ``>= value`` (``> value`` if
    ``strict``), smallest ``pid`` among equal values. Returns ``(keys, qid,
    pid)``; ``pid`` is null when no point qualifies."""
    keys = list(keys)
    # ascending tie order at equal value: the query sorts after the points
    # it must not see (strict) or before the points it may see (not strict)
    q_type, p_type = (1, 0) if strict else (0, 1)
    u = points.select(*keys, F.col("value").cast("double").alias("_v"), F.lit(p_type).alias("_t"),
                      F.col("pid").cast("bigint").alias("_id"), F.col("pid").cast("bigint").alias("_p")).unionByName(
        queries.select(*keys, F.col("value").cast("double").alias("_v"), F.lit(q_type).alias("_t"),
                       F.col("qid").cast("bigint").alias("_id"), F.lit(None).cast("bigint").alias("_p"))
    )
    scanned = ordered_scan(u, keys, ["_v", "_t", "_id"], ffills=["_p"], descending=True)
    return scanned.where(F.col("_t") == q_type).select(*keys, F.col("_id").alias("qid"), F.col("ffill__p").alias("pid"))


def _exits(keys):
    """Backward pass over one run: each node's first node outside it."""

    def fn(table: pa.Table) -> pa.Table:
        order = np.argsort(table["node"].to_numpy(), kind="stable")
        nodes = table["node"].to_numpy()[order].tolist()
        nexts = table["next"].combine_chunks().take(pa.array(order)).to_pylist()
        out: dict[int, int | None] = {}
        for node, following in zip(reversed(nodes), reversed(nexts)):
            out[node] = out.get(following, following)
        return table.select([*keys, "run"]).take(pa.array(order)).append_column("node", pa.array(nodes, pa.int64())).append_column(
            "exit", pa.array([out[n] for n in nodes], pa.int64())
        )

    return fn


def _inside(keys):
    """Nodes of one run that the walks entering at ``entries`` visit."""

    def fn(nodes: pa.Table, entries: pa.Table) -> pa.Table:
        following = dict(zip(nodes["node"].to_pylist(), nodes["next"].to_pylist()))
        seen: dict[int, None] = {}
        for at in sorted(entries["node"].to_pylist()):
            while at in following and at not in seen:
                seen[at] = None
                at = following[at]
        source = nodes if len(nodes) else entries
        return source.select(keys).take(pa.array([0] * len(seen), pa.int64())).append_column("node", pa.array(list(seen), pa.int64()))

    return fn


def chain_walk(nxt: DataFrame, starts: DataFrame, keys: Sequence[str], run: int = 4096) -> DataFrame:
    """Nodes reachable from the start nodes by following ``next`` pointers.

    ``nxt``: ``(keys, node, next)``, ``next`` null at the end of a chain and
    larger than ``node`` otherwise; ``starts``: ``(keys, node)``. Returns
    ``(keys, node)`` including the starts that are nodes.

    Each key's number line is cut into runs of ``run`` consecutive numbers,
    so a hot key is many bounded groups. One backward pass per run gives
    every node's exit, the first node outside its run. The chain of exits
    has at most one node per run; it is walked by pointer doubling. Every
    run that it enters is then expanded on its own."""
    keys = list(keys)
    in_run = F.floor(F.col("node") / run).cast("bigint")
    nxt = nxt.select(*keys, F.col("node").cast("bigint").alias("node"), F.col("next").cast("bigint").alias("next"))
    nxt = cut_lineage(nxt.withColumn("run", in_run))
    starts = cut_lineage(starts.select(*keys, F.col("node").cast("bigint").alias("node")).distinct())
    kinds = ", ".join(f"`{k}` {nxt.schema[k].dataType.simpleString()}" for k in keys)
    lead = f"{kinds}, " if keys else ""
    exits = nxt.groupBy(*keys, "run").applyInArrow(_exits(keys), f"{lead}run bigint, node bigint, exit bigint")
    exits = cut_lineage(exits.drop("run"))
    # only starts and targets of exits can be entered
    targets = exits.where("exit IS NOT NULL").select(*keys, F.col("exit").alias("node"))
    entered = starts.union(targets).distinct()
    entries = _reach(exits.join(entered, [*keys, "node"]).withColumnRenamed("exit", "next"), starts, keys)
    grouped = nxt.groupBy(*keys, "run").cogroup(entries.withColumn("run", in_run).groupBy(*keys, "run"))
    return grouped.applyInArrow(_inside(keys), f"{lead}node bigint")


def _reach(jump: DataFrame, starts: DataFrame, keys: list) -> DataFrame:
    """Nodes on the chains from the starts, by pointer doubling: after k
    rounds the first 2**k of each. Ends when no node is new, which is after
    as many rounds as the logarithm of the longest chain."""
    jump = cut_lineage(jump)
    reached, count = starts, starts.count()
    while True:
        step = reached.join(jump, [*keys, "node"]).where(F.col("next").isNotNull()).select(*keys, F.col("next").alias("node"))
        grown = cut_lineage(reached.unionByName(step).distinct())
        new_count = grown.count()
        if new_count == count:
            return grown
        following = jump.select(*keys, F.col("node").alias("next"), F.col("next").alias("after"))
        jump = cut_lineage(jump.join(following, [*keys, "next"], "left").select(*keys, "node", F.col("after").alias("next")))
        reached, count = grown, new_count
