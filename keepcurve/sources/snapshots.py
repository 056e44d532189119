"""Feature-snapshot store and report sinks.

Snapshots are stored as one Parquet dataset partitioned by ``period``;
rewriting a period replaces only that partition (dynamic overwrite) and
readers of one period get partition pruning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_snapshot(df: DataFrame, path: str, partition_col: str = "period") -> None:
    """Overwrite only the periods present in ``df``."""
    (df.write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy(partition_col)
       .parquet(path))


def read_snapshot(spark: SparkSession, path: str, periods: str | Sequence[str] | None = None,
                  partition_col: str = "period") -> DataFrame:
    """Read one or more periods; the filter prunes partitions."""
    df = spark.read.parquet(path)
    if periods is None:
        return df
    if isinstance(periods, str):
        periods = [periods]
    return df.where(F.col(partition_col).isin(list(periods)))


def write_table(df: DataFrame, path: str) -> None:
    """Plain Parquet table sink (LTV table, targeting list)."""
    df.write.mode("overwrite").parquet(path)


def write_report_csv(df: DataFrame, path: str) -> None:
    """Small report (Cox summary, drift report) as CSV with header.

    Reports are already aggregated (one row per feature/covariate), so a
    single output file is written.
    """
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
