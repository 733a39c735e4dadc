"""Text and table helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxtab.session import ensure_checkpoint_dir

#: Characters that separate words: space and \t \n \x0b \f \r.
SPACE = r"[\x20\x09-\x0D]"
#: Rows of a batch that are worked on at a time.
SLICE_ROWS = 256
SPACE_CHARS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_of(col: str | Column = "text") -> Column:
    """A text column with null read as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE + "+"), "")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(text, UPPER, LOWER)


def bind(value: Column, body) -> Column:
    """``body(v)`` with ``value`` computed once per row: a lambda variable
    is never inlined again by the optimiser."""
    return F.transform(F.array(value), body)[0]


def columns_of(df: DataFrame, **exprs: Column) -> DataFrame:
    """Adds computed columns behind a generator, so that projections above
    read the results and do not repeat the expressions."""
    return df.select("*", F.inline(F.array(F.struct(*[e.alias(n) for n, e in exprs.items()]))))


def crc_mod(col: str, n: int) -> Column:
    """crc32 of an id's decimal text modulo ``n``; a null id counts as the
    empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % n


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns that have one of ``names``: results take the
    place of a column of the same name."""
    return df.drop(*[c for c in df.columns if c.lower() in names])


def add_columns(df: DataFrame, source: str, fields: Sequence[T.StructField], start: Callable, rows: int = SLICE_ROWS) -> DataFrame:
    """``df`` plus ``fields``, computed from the column ``source`` in Arrow
    batches of at most ``rows`` where the rows lie. ``start()`` runs once per
    task and returns a function from an array to the new arrays."""
    require(df, [source])
    df = without(df, *[f.name.lower() for f in fields if f.name != source])
    at, schema = df.columns.index(source), T.StructType([*df.schema.fields, *fields])
    names = [f"c{i}" for i in range(len(schema))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = start()
        for whole in batches:
            for i in range(0, whole.num_rows, rows):  # small results at a time
                b = whole.slice(i, rows)
                yield pa.RecordBatch.from_arrays([*b.columns, *compute(b.column(at))], names=names)

    plain = df.toDF(*names[: len(df.columns)])  # names with dots can't pass
    return plain.mapInArrow(run, T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, schema)])).toDF(*schema.names)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` once into the cluster's shared checkpoint folder and
    reads it back: lineage is cut, the plan runs once, and any executor can
    read the result after another is lost."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/voxtab-{label}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def require(df: DataFrame, names: Sequence[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")
