"""Batch model application with per-item status.

The user's ``load()`` runs once per task (not per file), ``predict(model,
batch)`` on Arrow batches of rows. A failing item becomes a ``failed`` row
with its reason and does not stop the job; if a whole batch fails, every
item of it is counted failed (never lost)."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


def batch_infer(df: DataFrame, load: Callable[[], object], predict: Callable[[object, pd.DataFrame], pd.DataFrame],
                out_schema: T.StructType | str, keys: list[str], per_item_retry: bool = True) -> DataFrame:
    """Apply ``predict`` to batches of ``df`` (Arrow batches, handed to
    the model as pandas; keys stay Arrow columns, so any value of them returns as it
    came).

    ``predict`` returns one output row per input row (same order) with the
    columns of ``out_schema``. The result holds ``keys``, the outputs,
    ``status`` (``success``/``failed``) and ``reason``. When a batch raises
    and ``per_item_retry`` is on, its rows are retried one by one so only
    the bad items fail."""
    if isinstance(out_schema, str):
        out_schema = T._parse_datatype_string(out_schema)
    key_fields = [df.schema[k] for k in keys]
    schema = T.StructType(
        key_fields + list(out_schema.fields) + [T.StructField("status", T.StringType()), T.StructField("reason", T.StringType())]
    )
    out_cols = [f.name for f in out_schema.fields]

    kinds = [to_arrow_type(f.dataType) for f in out_schema.fields]
    names = [f.name for f in schema.fields]

    def outputs(res: pd.DataFrame) -> list[pa.Array]:
        return [pa.Array.from_pandas(res[c], type=t) for c, t in zip(out_cols, kinds, strict=True)]

    def run(batches):
        model = load()
        for b in batches:
            n = b.num_rows
            if n == 0:
                continue
            own = [b.column(b.schema.get_field_index(k)) for k in keys]  # never converted
            pdf = b.to_pandas(integer_object_nulls=True)
            try:
                res = predict(model, pdf).reset_index(drop=True)
                if len(res) != n:
                    raise ValueError(f"predict returned {len(res)} rows for {n}")
                told, status, reason = outputs(res), ["success"] * n, [None] * n
            except Exception as batch_err:  # noqa: BLE001
                parts, status, reason = [], [], []
                for i in range(n):
                    try:
                        if not per_item_retry:
                            raise batch_err
                        parts.append(outputs(predict(model, pdf.iloc[i : i + 1]).iloc[:1]))
                        status.append("success")
                        reason.append(None)
                    except Exception as e:  # noqa: BLE001
                        parts.append([pa.nulls(1, t) for t in kinds])
                        status.append("failed")
                        reason.append(f"{type(e).__name__}: {e}")
                told = [pa.concat_arrays(column) for column in zip(*parts, strict=True)]
            yield pa.RecordBatch.from_arrays([*own, *told, pa.array(status, pa.string()), pa.array(reason, pa.string())], names=names)

    return df.mapInArrow(run, schema)
