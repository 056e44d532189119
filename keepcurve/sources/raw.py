"""Raw role-table readers.

CSV is read once with a declared schema; at scale write it as Parquet first,
so that every later stage gets column pruning and predicate pushdown.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keepcurve.session import cut_lineage
from keepcurve.sources import schemas


CORRUPT = "_corrupt_record"


def _read_csv(spark: SparkSession, paths: str | Sequence[str], schema, quarantine: str | None = None) -> DataFrame:
    """Rows of the declared schema.  Without ``quarantine`` fields that do not
    parse are null, as in the original.  With it, rows that do not parse
    (wrong number of fields, a field of another type) go to the Parquet table
    of that path with their file, and only whole rows are returned, written
    once so that every consumer sees the same rows whatever it selects."""
    if isinstance(paths, str):
        paths = [paths]
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if quarantine is None:
        return reader.schema(schema).csv(list(paths))
    marked = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    rows = reader.schema(marked).option("columnNameOfCorruptRecord", CORRUPT).csv(list(paths))
    bad = rows.where(F.col(CORRUPT).isNotNull())
    # a field that nobody reads is not parsed, so all are: what did parse is kept beside the record
    bad.select(F.col(CORRUPT).alias("record"), F.input_file_name().alias("file"), *schema.fieldNames()).write.mode("append").parquet(quarantine)
    return cut_lineage(rows).where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def quarantined(spark: SparkSession, quarantine: str) -> DataFrame:
    """Records put aside, per file: ``(file, n)``."""
    return spark.read.parquet(quarantine).select("file").groupBy("file").agg(F.count("*").alias("n"))


def load_labels(spark: SparkSession, path: str, quarantine: str | None = None) -> DataFrame:
    """Label file of one period (``msno, is_churn``)."""
    return _read_csv(spark, path, schemas.LABELS, quarantine)


def load_members(spark: SparkSession, path: str, quarantine: str | None = None) -> DataFrame:
    """Static member table."""
    return _read_csv(spark, path, schemas.MEMBERS, quarantine)


def union_deliveries(parts: Sequence[DataFrame], dedup: bool, by: str | None = None) -> DataFrame:
    """Union successive deliveries of one table by column name.

    ``dedup=True`` removes full-row duplicates (overlapping deliveries);
    ``dropDuplicates`` plans a partial + final hash aggregate, so copies are
    collapsed map-side before the shuffle.

    With ``by`` (a key with few rows a value, such as the member) the rows are
    dealt out by it first, as they are, and rows without it are left out: the
    dedup and every aggregate by that key then stay within their task, so wide
    aggregate buffers never meet a shuffle.
    """
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if by is not None:
        out = out.where(F.col(by).isNotNull()).repartition(by)
    return out.dropDuplicates() if dedup else out


def load_transactions(spark: SparkSession, paths: Sequence[str], dedup: bool = True, quarantine: str | None = None) -> DataFrame:
    """S3: transactions; later deliveries overlap earlier ones, so dedup.

    The default dedups every period (the original only deduplicated when a
    second file was present, so duplicates inside one file counted twice).
    """
    return union_deliveries([_read_csv(spark, p, schemas.TRANSACTIONS, quarantine) for p in paths], dedup)


def load_user_logs(spark: SparkSession, paths: Sequence[str], quarantine: str | None = None) -> DataFrame:
    """Activity logs; deliveries cover disjoint dates, so no dedup."""
    return union_deliveries([_read_csv(spark, p, schemas.USER_LOGS, quarantine) for p in paths], dedup=False)
