"""Date helpers.

Raw files carry dates as ``yyyymmdd`` integers or strings.  Spark 4 runs with
ANSI mode on, where ``to_date`` raises on an impossible date such as
20150231; ``try_to_date`` keeps the null-based semantics (an unparsable date
simply fails the ``<= cutoff`` predicate later).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def cutoff_lit(cutoff) -> Column:
    """A ``DATE`` literal for a cutoff given as ``date`` or ISO string (a
    Column, e.g. a per-row cutoff, is returned as it is)."""
    if isinstance(cutoff, Column):
        return cutoff
    if isinstance(cutoff, (_dt.date, _dt.datetime)):
        cutoff = cutoff.isoformat()[:10]
    return F.lit(str(cutoff)).cast("date")


def parse_yyyymmdd(col: Column) -> Column:
    return F.try_to_date(col.cast("string"), "yyyyMMdd")


def as_date(df: DataFrame, name: str) -> Column:
    """Column ``name`` of ``df`` as a DATE, whatever its physical type.

    Integers/strings are parsed as ``yyyymmdd``; timestamps are truncated.
    The decision is made from the schema on the driver, so the expression
    stays a plain codegen'd cast/parse.
    """
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, T.DateType):
        return c
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return c.cast("date")
    return parse_yyyymmdd(c)
