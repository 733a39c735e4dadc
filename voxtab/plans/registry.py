"""Registry of checked queries: one Spark callable ``(spark, sf_dir) ->
DataFrame`` per operator, plus (where the operator has one) an SQL form in
DuckDB's dialect over the same parquet tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


# Quantisation grid for checked doubles: 1e-6 steps, shifted by an
# irrational fraction so that values with a short decimal expansion (means
# of decimal inputs end in ...5 exactly) never sit on a rounding boundary,
# where summation order would flip the last digit.
_Q_SCALE = 1_000_000.0
_Q_SHIFT = 0.318309886


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Quantise every double/float column to the 1e-6 grid (same arithmetic
    as ``sqlq`` in the oracle SQL)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            x = F.col(f.name).cast("double")
            cols.append((F.round(x * _Q_SCALE + _Q_SHIFT, 0) / _Q_SCALE).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def sqlq(expr: str) -> str:
    """SQL form of ``rounded`` for one expression."""
    scale, shift = f"CAST({_Q_SCALE!r} AS DOUBLE)", f"CAST({_Q_SHIFT!r} AS DOUBLE)"
    return f"(round(CAST({expr} AS DOUBLE) * {scale} + {shift}) / {scale})"


def sql_horner(x: str, coefs) -> str:
    acc = f"CAST({float(coefs[0])!r} AS DOUBLE)"
    for c in coefs[1:]:
        acc = f"({acc} * {x} + CAST({float(c)!r} AS DOUBLE))"
    return acc
