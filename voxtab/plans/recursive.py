"""Exact parallel recursive filters on blocked signals.

A cascade of second-order sections is a linear system with state ``s``:
``s' = A s + B x``, ``y = C s + D x``. A block of n samples maps the state at
its start to ``A^n s + e``, where ``e`` is the state it reaches from rest. Such
maps compose associatively (``(n1, e1)`` then ``(n2, e2)`` is
``(n1 + n2, A^n2 e1 + e2)``), so the states at all block starts are a prefix
scan over one small row per block: composed in chunks of ``FAN`` blocks, the
chunks again, until one is left for each recording, and then handed back down.
The output of a block is its response from rest plus ``C A^i s``. Nothing is
truncated, blocks may be of any length, and a recording that holds a third of
all blocks is as many chunks as it needs."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxtab.session import cut_lineage

#: Blocks that are composed in one call.
FAN = 1024
_STATE = T.ArrayType(T.DoubleType())


class System:
    """State-space form of second-order sections ``(b, a)`` in a row."""

    def __init__(self, sections: Sequence[tuple[Sequence[float], Sequence[float]]]):
        size = 2 * len(sections)
        self.a, self.b, self.c, self.d = np.zeros((size, size)), np.zeros(size), np.zeros(size), 1.0
        for i, (num, den) in enumerate(sections):
            b0, b1, b2 = (v / den[0] for v in num)
            a1, a2 = den[1] / den[0], den[2] / den[0]
            z1, z2 = 2 * i, 2 * i + 1
            # transposed direct form II on the output c s + d x of the sections before
            self.a[z1] = (b1 - a1 * b0) * self.c
            self.a[z2] = (b2 - a2 * b0) * self.c
            self.a[z1, z1] -= a1
            self.a[z1, z2] += 1.0
            self.a[z2, z1] -= a2
            self.b[z1], self.b[z2] = (b1 - a1 * b0) * self.d, (b2 - a2 * b0) * self.d
            self.c = b0 * self.c
            self.c[z1] += 1.0
            self.d *= b0
        self.order = size
        self._known: dict[int, tuple] = {}

    def power(self, n: int) -> np.ndarray:
        return np.linalg.matrix_power(self.a, n)

    def of_length(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """For blocks of n samples: ``A^(n-1-i) B``, ``C A^i``, and the
        transform of the impulse response with its size."""
        if n not in self._known:
            reach, seen = self.b[None, :], self.c[None, :]  # A^i B and C A^i, doubled until long enough
            step = self.a.copy()
            while len(reach) < n:
                reach = np.concatenate([reach, reach @ step.T])
                seen = np.concatenate([seen, seen @ step])
                step = step @ step
            reach, seen = reach[:n], seen[:n]
            response = np.r_[self.d, reach[: n - 1] @ self.c]
            size = 1 << max(1, 2 * n - 1).bit_length()
            if len(self._known) > 8:  # lengths beyond the regular one and a few last blocks
                self._known.clear()
            self._known[n] = (reach[::-1].copy(), seen, np.fft.rfft(response, size), size)
        return self._known[n]

    def end(self, x: np.ndarray) -> np.ndarray:
        """State after ``x`` from rest."""
        return self.of_length(len(x))[0].T @ x if len(x) else np.zeros(self.order)

    def run(self, x: np.ndarray, start: np.ndarray) -> np.ndarray:
        if not len(x):
            return x
        _, seen, response, size = self.of_length(len(x))
        return np.fft.irfft(np.fft.rfft(x, size) * response, size)[: len(x)] + seen @ start


def _along(group: pa.Table, system: System, start: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, int]:
    """Order of the rows, state at the start of each, state and length at the
    end."""
    no, n = group["no"].to_numpy(), group["n"].to_numpy()
    ends = group["e"].to_pylist()
    order, states, state, total = np.argsort(no, kind="stable"), [], start, 0
    powers: dict[int, np.ndarray] = {}
    for i in order:
        states.append(state)
        length = int(n[i])
        if length not in powers:
            powers[length] = system.power(length)
        state = powers[length] @ state + np.array(ends[i])
        total += length
    return order, states, state, total


def _starts(maps: DataFrame, keys: list[str], system: System, last: int) -> DataFrame:
    """``maps (keys, no, n, e)`` -> ``(keys, no, s)``: the state at the start
    of every block."""
    key_fields = [maps.schema[k] for k in keys]

    def compose(group: pa.Table) -> pa.Table:
        _, _, state, total = _along(group, system, np.zeros(system.order))
        one = group.select([*keys, "chunk"]).slice(0, 1).rename_columns([*keys, "no"])
        return one.append_column("n", pa.array([total], pa.int64())).append_column("e", pa.array([state.tolist()], pa.list_(pa.float64())))

    def expand(group: pa.Table) -> pa.Table:
        order, states, _, _ = _along(group, system, np.array(group["s0"][0].as_py()))
        some = group.select([*keys, "no"]).take(pa.array(order))
        return some.append_column("s", pa.array([s.tolist() for s in states], pa.list_(pa.float64())))

    chunked = maps.withColumn("chunk", F.floor(F.col("no") / FAN).cast("long"))
    rest = F.array(*[F.lit(0.0)] * system.order)
    out = T.StructType([*key_fields, T.StructField("no", T.LongType()), T.StructField("s", _STATE)])
    if last < FAN:
        return chunked.withColumn("s0", rest).groupBy(*keys, "chunk").applyInArrow(expand, out)
    up = T.StructType([*key_fields, T.StructField("no", T.LongType()), T.StructField("n", T.LongType()), T.StructField("e", _STATE)])
    chunks = cut_lineage(chunked.groupBy(*keys, "chunk").applyInArrow(compose, up))
    above = _starts(chunks, keys, system, last // FAN)
    above = above.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("no").alias("_chunk"), F.col("s").alias("s0"))
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)] + [F.col("chunk") == F.col("_chunk")]
    return chunked.join(above, same).select(*keys, "chunk", "no", "n", "e", "s0").groupBy(*keys, "chunk").applyInArrow(expand, out)


def recursive_filter(blocks: DataFrame, sections: Sequence, keys: Sequence[str]) -> DataFrame:
    """``blocks (keys, block_no, start, samples)`` through the sections from
    rest, as if each recording were one array: the same columns."""
    keys, system = list(keys), System(sections)
    some = blocks.select(*keys, F.col("block_no").cast("long"), F.col("start").cast("long"), F.col("samples").cast(_STATE))
    key_fields = [some.schema[k] for k in keys]
    at = len(keys)

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [np.asarray(v, float) for v in b.column(at + 1).to_pylist()]
            cols = [*b.columns[: at + 1], pa.array([len(v) for v in x], pa.int64()), pa.array([system.end(v).tolist() for v in x], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(cols, names=[*keys, "no", "n", "e"])

    out = T.StructType([*key_fields, T.StructField("no", T.LongType()), T.StructField("n", T.LongType()), T.StructField("e", _STATE)])
    maps = cut_lineage(some.select(*keys, "block_no", "samples").mapInArrow(ends, out))
    last = maps.agg(F.max("no")).first()[0] or 0
    states = _starts(maps, keys, system, last)
    states = states.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("no").alias("_no"), "s")
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)] + [F.col("block_no") == F.col("_no")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            y = [
                system.run(np.asarray(x, float), np.array(s)).tolist()
                for x, s in zip(b.column(at + 2).to_pylist(), b.column(at + 3).to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([*b.columns[: at + 2], pa.array(y, pa.list_(pa.float64()))], names=[*keys, "block_no", "start", "samples"])

    return some.join(states, same).select(*keys, "block_no", "start", "samples", "s").mapInArrow(run, some.schema)
