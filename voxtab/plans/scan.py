"""Distributed ordered scans.

``ordered_scan`` computes, for every row, its 0-based position within its key
and running (prefix) aggregates in a given order, without a window that
pulls a whole key into one task:

1. range-partition on ``(keys, order)`` and sort inside partitions, so a hot
   key is spread over many tasks;
2. one Arrow pass per partition (``mapInArrow``) computes the local scan and
   two summary rows: the partition's first key and the totals of its last
   key;
3. the pass is materialised once (a reliable checkpoint), so the data rows
   and the summaries come from the same partitioning;
4. carries are computed from the summaries (at most two rows per partition,
   so their size is bounded by the partition count, not by the data) and
   broadcast back.

This is the classic two-level parallel prefix scan. Everything that needs
"row number", "running sum", "last non-null so far" or "previous row" on
large or skewed keys goes through here. Null (and NaN) keys form one group
each; data columns are never converted.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type

_KIND_DATA, _KIND_FIRST, _KIND_LAST = 0, 1, 2


def _changes(column: pa.Array) -> np.ndarray:
    """Where a key column differs from the row before (row 0: not looked at).
    Null equals null, NaN equals NaN."""
    out = np.zeros(len(column), dtype=bool)
    if len(column) > 1:
        a, b = column.slice(1), column.slice(0, len(column) - 1)
        differ = pc.fill_null(pc.not_equal(a, b), False)
        differ = pc.or_(differ, pc.xor(a.is_null(), b.is_null()))
        if pa.types.is_floating(column.type):
            differ = pc.and_not(differ, pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False))
        out[1:] = differ.to_numpy(zero_copy_only=False)
    return out


def _same_key(a: tuple, b: tuple) -> bool:
    return all(x == y or (x != x and y != y) for x, y in zip(a, b))


def _numbers(column: pa.Array, kind: pa.DataType) -> np.ndarray:
    return pc.fill_null(column.cast(kind), 0).to_numpy(zero_copy_only=False)


def _local_scan_fn(keys, sums, ffills, prevs, sum_types, out_schema):
    """Per-partition scan with state carried across Arrow batches. Data
    columns stay Arrow arrays throughout, so no value changes its type."""

    def fn(batches):
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        first_key = last_key = None
        cnt, in_first_group = 0, True
        acc = {c: 0 for c in sums}
        fill, prev = {}, {}
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            col = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            head = tuple(col[k][0].as_py() for k in keys)
            continues = last_key is not None and _same_key(head, last_key)
            if first_key is None:
                first_key = head
            elif not continues:
                in_first_group = False
            change = np.zeros(n, dtype=bool)
            for k in keys:
                change |= _changes(col[k])
            grp = np.cumsum(change)  # 0: the group of the first row
            at = np.arange(n)
            start = np.maximum.accumulate(np.where(change, at, 0))
            pos = at - start
            if continues:
                pos = pos + np.where(grp == 0, cnt, 0)
            out = list(batch.columns) + [pa.array(pos.astype(np.int64))]
            state = {}
            for c in sums:
                x = _numbers(col[c], sum_types[c])
                run = np.cumsum(x)
                run = run - (run[start] - x[start])
                if continues:
                    run = run + np.where(grp == 0, acc[c], 0)
                state[c] = run[-1]
                out.append(pa.array(run, sum_types[c]))
            acc = state
            filled = {}
            for c in ffills:
                # row 0 of ``held`` is what was last seen before this batch
                held = pa.concat_arrays([fill[c] if continues else pa.nulls(1, col[c].type), col[c]])
                seen = np.maximum.accumulate(np.where(col[c].is_valid().to_numpy(zero_copy_only=False), at, -1))
                got = held.take(pa.array(np.where(seen >= start, seen + 1, 0), mask=(seen < start) & (grp > 0)))
                filled[c] = got.slice(n - 1, 1)
                out.append(got)
            fill = filled
            before = {}
            for c in prevs:
                held = pa.concat_arrays([prev[c] if continues else pa.nulls(1, col[c].type), col[c]])
                out.append(held.take(pa.array(at, mask=change)))
                before[c] = col[c].slice(n - 1, 1)
            prev = before
            out += [pa.array((grp == 0) & in_first_group), pa.array(np.full(n, pid, np.int32)), pa.array(np.full(n, _KIND_DATA, np.int32))]
            cnt = int(pos[-1]) + 1
            last_key = tuple(col[k][n - 1].as_py() for k in keys)
            in_first_group = in_first_group and not grp[-1]
            yield pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip(out, out_schema)], schema=out_schema)
        if last_key is None:
            return
        summary = {f.name: pa.nulls(2, f.type) for f in out_schema}
        for i, k in enumerate(keys):
            summary[k] = pa.array([first_key[i], last_key[i]], out_schema.field(k).type)
        summary["_pid"] = pa.array([pid, pid], pa.int32())
        summary["_kind"] = pa.array([_KIND_FIRST, _KIND_LAST], pa.int32())
        summary["_lpos"] = pa.array([None, cnt], pa.int64())
        for c in sums:
            summary[f"_lcum_{c}"] = pa.array([None, acc[c]], sum_types[c])
        for name, carried in [*((f"_lffill_{c}", fill[c]) for c in ffills), *((f"_lprev_{c}", prev[c]) for c in prevs)]:
            summary[name] = pa.concat_arrays([pa.nulls(1, carried.type), carried]).cast(out_schema.field(name).type)
        yield pa.RecordBatch.from_arrays([summary[f.name] for f in out_schema], schema=out_schema)

    return fn


def ordered_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: Sequence[str] = (),
    ffills: Sequence[str] = (),
    prevs: Sequence[str] = (),
    descending: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """Add ``pos`` (0-based rank within ``keys`` by ``order``), ``cum_<c>``
    (inclusive running sum), ``ffill_<c>`` (last non-null value so far,
    inclusive) and ``prev_<c>`` (value on the previous row, null on the first
    row of a key). ``descending`` scans from the other end (so ``prev_`` is
    the *next* row and ``ffill_`` the next non-null value).

    ``order`` must be unique within a key for ``ffill``/``prev`` to be
    deterministic."""
    keys, order = list(keys), list(order)
    sums, ffills, prevs = list(sums), list(ffills), list(prevs)
    taken = {"pos", *[f"cum_{c}" for c in sums], *[f"ffill_{c}" for c in ffills], *[f"prev_{c}" for c in prevs]}
    clash = taken & set(df.columns)
    if clash:
        raise ValueError(f"ordered_scan output columns already present: {sorted(clash)}")
    spark = df.sparkSession
    sort_cols = [F.col(c).desc() if descending and c in order else F.col(c).asc() for c in keys + order]
    if partitions:
        ranged = df.repartitionByRange(int(partitions), *sort_cols)
    else:
        # no fixed count: AQE coalesces small range partitions into larger,
        # still contiguous and ordered ones (a hot key still spans many)
        ranged = df.repartitionByRange(*sort_cols)
    ranged = ranged.sortWithinPartitions(*sort_cols)

    in_schema = df.schema
    fields = list(in_schema.fields)
    fields.append(T.StructField("_lpos", T.LongType()))
    sum_types = {}
    for c in sums:
        dt = in_schema[c].dataType
        st = T.DoubleType() if isinstance(dt, (T.FloatType, T.DoubleType, T.DecimalType)) else T.LongType()
        sum_types[c] = st
        fields.append(T.StructField(f"_lcum_{c}", st))
    for c in ffills:
        fields.append(T.StructField(f"_lffill_{c}", in_schema[c].dataType))
    for c in prevs:
        fields.append(T.StructField(f"_lprev_{c}", in_schema[c].dataType))
    fields.append(T.StructField("_lhead", T.BooleanType()))
    fields.append(T.StructField("_pid", T.IntegerType()))
    fields.append(T.StructField("_kind", T.IntegerType()))
    # summary rows carry nulls in data columns
    out_schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])

    arrow = to_arrow_schema(out_schema)
    kinds = {c: to_arrow_type(t) for c, t in sum_types.items()}
    scanned = ranged.mapInArrow(_local_scan_fn(keys, sums, ffills, prevs, kinds, arrow), out_schema)
    # The data rows and the summary rows must come from the *same* range
    # shuffle (same sampled bounds, same partition ids). Exchange reuse does
    # not guarantee it (the optimiser may rewrite the two branches
    # differently, and each range exchange samples its own bounds), so the
    # pass is materialised once: both branches read the same files, and the
    # Arrow pass runs once.
    from voxtab.session import cut_lineage

    scanned = cut_lineage(scanned)
    data = scanned.where(F.col("_kind") == _KIND_DATA)
    # Summary rows: at most two per partition, so this side is bounded by the
    # partition count whatever the data volume. For the first key of a
    # partition, the carry is the total of the same key over all earlier
    # partitions, where that key can only be the last one.
    is_last = F.col("_kind") == _KIND_LAST
    w = (
        Window.partitionBy(*[F.col(k) for k in keys])
        .orderBy("_pid", "_kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summ = scanned.where(F.col("_kind") != _KIND_DATA)
    carry = summ.select(
        "_pid",
        "_kind",
        *keys,
        F.sum(F.when(is_last, F.col("_lpos"))).over(w).alias("_ccnt"),
        *[F.sum(F.when(is_last, F.col(f"_lcum_{c}"))).over(w).alias(f"_csum_{c}") for c in sums],
        *[F.last(F.when(is_last, F.col(f"_lffill_{c}")), ignorenulls=True).over(w).alias(f"_cfill_{c}") for c in ffills],
        *[F.last(F.when(is_last, F.struct(F.col(f"_lprev_{c}").alias("v"))), ignorenulls=True).over(w)
          .getField("v").alias(f"_cprev_{c}") for c in prevs],
    ).where(F.col("_kind") == _KIND_FIRST).drop("_kind")
    carry = carry.drop(*keys).withColumnRenamed("_pid", "_cpid")
    # only the rows of a partition's first key take its carry (one row per
    # partition; a null key is a key like any other)
    joined = data.join(F.broadcast(carry), F.col("_lhead") & (F.col("_pid") == F.col("_cpid")), "left")
    first_in_part = F.col("_lpos") == 0
    out_cols = [F.col(f.name) for f in in_schema.fields]
    out_cols.append((F.col("_lpos") + F.coalesce(F.col("_ccnt"), F.lit(0))).cast("bigint").alias("pos"))
    for c in sums:
        out_cols.append(
            (F.col(f"_lcum_{c}") + F.coalesce(F.col(f"_csum_{c}"), F.lit(0))).cast(sum_types[c]).alias(f"cum_{c}")
        )
    for c in ffills:
        out_cols.append(F.coalesce(F.col(f"_lffill_{c}"), F.col(f"_cfill_{c}")).alias(f"ffill_{c}"))
    for c in prevs:
        out_cols.append(
            F.when(first_in_part, F.col(f"_cprev_{c}")).otherwise(F.col(f"_lprev_{c}")).alias(f"prev_{c}")
        )
    return joined.select(*out_cols)


def exact_median(df: DataFrame, column: str, keys: Sequence[str] = ()) -> DataFrame:
    """Exact median (mean of the two middle values for an even count, as
    numpy) per key, as a distributed order statistic. Null values are
    ignored; a key with no value gets no row (the caller left-joins)."""
    keys = list(keys)
    base = df.select(*keys, F.col(column).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    if not keys:
        base = base.withColumn("_g", F.lit(0))
        gkeys = ["_g"]
    else:
        gkeys = keys
    # one row per distinct value, so that a value that fills a third of the
    # table is one row of the scan
    values = base.groupBy(*gkeys, "_v").agg(F.count(F.lit(1)).alias("_c"))
    ranked = ordered_scan(values, gkeys, ["_v"], sums=["_c"]).drop("pos")
    counts = ranked.groupBy(*[F.col(k).alias(f"_k_{k}") for k in gkeys]).agg(F.max("cum__c").alias("_n"))
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in gkeys]
    lo, hi = F.floor((F.col("_n") - 1) / 2), F.ceil((F.col("_n") - 1) / 2)
    holds = lambda p: (F.col("cum__c") - F.col("_c") <= p) & (p < F.col("cum__c"))
    mid = (
        ranked.join(counts, same)
        .where(holds(lo) | holds(hi))
        .groupBy(*gkeys)
        .agg(F.avg("_v").alias("median"))
    )
    return mid.select(*keys, "median")


def global_rank(df: DataFrame, order: Sequence[str], name: str = "rank") -> DataFrame:
    """1-based dense row number over the whole table (no single-partition
    window): ``order`` must be unique."""
    scanned = ordered_scan(df.withColumn("_g", F.lit(0)), ["_g"], order)
    return scanned.withColumn(name, F.col("pos") + 1).drop("pos", "_g")


def attach_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a global aggregate (exactly one row, so the
    broadcast side is bounded by construction) to every row of ``df``."""
    return df.withColumn("_one", F.lit(0)).join(
        F.broadcast(one_row.withColumn("_one", F.lit(0))), "_one"
    ).drop("_one")
