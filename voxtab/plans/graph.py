"""Connected components by min-label propagation with pointer jumping.

Each round is two equi-joins and one partial-aggregating groupBy on
``(key, node)``; lineage is cut by a reliable checkpoint per round, whose
files and tasks follow its rows (``PART_ROWS``), and the
loop stops on a scalar (the number of labels that changed). Labels end as
the smallest node of each component. A giant component only makes the join
on its root label hot, which AQE's skew-join handling splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtab.session import cut_lineage

#: Rows of a checkpoint's file: some ids each.
PART_ROWS = 1 << 18


def connected_components(vertices: DataFrame, edges: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``vertices (keys, node)``, ``edges (keys, src, dst)`` (undirected) ->
    ``(keys, node, label)``."""
    keys = list(keys)
    e = edges.select(*keys, F.col("src").alias("a"), F.col("dst").alias("b"))
    both = cut_lineage(e.unionByName(e.select(*keys, F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), PART_ROWS)
    labels = cut_lineage(vertices.select(*keys, "node").distinct().withColumn("label", F.col("node")), PART_ROWS)
    while True:  # labels only ever fall, so this ends
        offered = both.join(labels.withColumnRenamed("node", "b"), [*keys, "b"]).select(*keys, F.col("a").alias("node"), "label")
        hooked = labels.unionByName(offered).groupBy(*keys, "node").agg(F.min("label").alias("label"))
        parent = hooked.select(*keys, F.col("node").alias("label"), F.col("label").alias("plabel"))
        jumped = hooked.join(parent, [*keys, "label"], "left").select(
            *keys, "node", F.least(F.col("label"), F.coalesce(F.col("plabel"), F.col("label"))).alias("label")
        )
        jumped = cut_lineage(jumped, PART_ROWS)
        changed = jumped.join(labels.withColumnRenamed("label", "old"), [*keys, "node"]).where(
            F.col("label") != F.col("old")
        ).count()
        labels = jumped
        if changed == 0:
            return labels
