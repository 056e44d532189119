"""Registry of named queries over the test tables and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
DECIMALS = 6


def round_doubles(df: DataFrame, decimals: int = DECIMALS) -> DataFrame:
    """Round every double column (both engines do the same before compare)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name).cast("double"), decimals).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def query(name: str, sql: str | None = None, decimals: int = DECIMALS):
    """Register ``fn(spark, sf_dir) -> DataFrame``.  The operators' doubles are
    rounded here, and in the SQL, only so that two engines can be compared."""

    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return round_doubles(fn(spark, sf_dir), decimals)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return deco
