"""Scalar expression builders shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def range_guard(col: Column, lo, hi) -> Column:
    """``col`` if it lies in [lo, hi], else null (null stays null)."""
    return F.when(col.between(lo, hi), col)


def valid_flag(col: Column, lo, hi) -> Column:
    """Non-null boolean: true iff ``col`` is present and in [lo, hi]."""
    return F.coalesce(col.between(lo, hi), F.lit(False))


def recode(col: Column, mapping: dict) -> Column:
    """Chained CASE WHEN: values not in ``mapping`` become null."""
    out = None
    for k, v in mapping.items():
        out = F.when(col == k, F.lit(v)) if out is None else out.when(col == k, F.lit(v))
    return out


def guarded_ratio(num: Column, den: Column) -> Column:
    """``num / den`` when ``den > 0``, else null (never inf, never an ANSI error)."""
    return F.when(den > 0, F.try_divide(num.cast("double"), den.cast("double")))


def hash_u64(key: Column, seed) -> Column:
    """Deterministic 60-bit integer from ``md5('<seed>:<key>')``.

    Reproducible in any SQL engine that has md5 (first 15 hex digits).
    """
    h = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("long")


def hash_fraction(key: Column, seed) -> Column:
    """Uniform-looking number in [0, 1) from ``md5('<seed>:<key>')``."""
    return hash_u64(key, seed).cast("double") / F.lit(float(16 ** 15))
