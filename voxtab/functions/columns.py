"""Column-level helpers (JVM-side expressions only; nothing here runs Python
per row)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def horner(x, coefs: Sequence[float]) -> Column:
    """Polynomial, highest power first, evaluated as ``(a*x + b)*x + c``
    (the same operation order as a numpy poly1d)."""
    x = col_(x)
    acc = F.lit(float(coefs[0]))
    for c in coefs[1:]:
        acc = acc * x + F.lit(float(c))
    return acc


def db_to_amp(db: float) -> float:
    return 10.0 ** (db / 20.0)


def suffix(path) -> Column:
    """Last suffix of the file name, dot included (``pathlib`` rule: a
    leading dot does not start a suffix, a trailing dot is no suffix)."""
    return F.regexp_extract(file_name(path), r"^.+(\.[^.]+)$", 1)


def file_name(path) -> Column:
    return F.regexp_extract(col_(path), r"([^/]*)$", 1)


def parent_dir(path) -> Column:
    return F.regexp_extract(col_(path), r"^(.*)/[^/]*$", 1)


def stem(path) -> Column:
    """File name without its last suffix."""
    return F.regexp_replace(file_name(path), r"^(.+)\.[^.]+$", "$1")


def utt_id(rel_path) -> Column:
    """Relative path with ``/`` replaced by ``_``."""
    return F.translate(col_(rel_path), "/", "_")


def replace_last(c, old: str, new: str) -> Column:
    """Replace the last occurrence of ``old`` (greedy prefix)."""
    import re

    return F.regexp_replace(col_(c), r"(?s)^(.*)" + re.escape(old), "$1" + new.replace("$", r"\$"))


def path_sort_key(path) -> Column:
    """Order of ``pathlib`` paths: component-wise, not plain string order."""
    return F.split(col_(path), "/")
