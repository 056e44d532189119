"""Activity logs as mergeable state per delivery.

The state of a delivery is its logs summed per (member, day), written once
when the delivery arrives.  States add up: of several deliveries, and of a day
that two deliveries share.  A snapshot of any cutoff, or of several, reads the
states of the members' days and never the raw logs: sums over windows are sums
of days, active days are days that occur, recency is the last of them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keepcurve.functions.dates import cutoff_lit
from keepcurve.operators import features as fe

MEASURES = (*fe.PLAY_COLUMNS, "num_unq", "total_secs")


def log_state(logs: DataFrame, key: str = "msno", date_col: str | None = None) -> DataFrame:
    """``(<key>, log_date, <measures>)``: a row per member and day of ``logs``;
    rows without a date are left out."""
    d = fe._log_date(logs, date_col)
    return logs.where(d.isNotNull()).groupBy(F.col(key), d.alias("log_date")).agg(*[F.sum(m).alias(m) for m in MEASURES])


def write_log_state(logs: DataFrame, path: str, delivery: str, key: str = "msno", date_col: str | None = None) -> None:
    """Store a delivery's state; the same delivery again replaces its own."""
    state = log_state(logs, key, date_col).withColumn("delivery", F.lit(delivery))
    state.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("delivery").parquet(path)


def read_log_state(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def log_features_from_state(state: DataFrame, cutoffs: Mapping[str, object], key: str = "msno", cohort: DataFrame | None = None,
                            windows=fe.LOOKBACK_WINDOWS_DAYS, period_col: str = "period") -> DataFrame:
    """The log features of ``features.user_log_features`` per period, for all
    ``cutoffs`` (period -> date) in one pass over the states.  ``cohort`` is a
    table of (period, member); others are left out."""
    latest = max(str(c)[:10] for c in cutoffs.values())
    tags = F.explode(F.array(*[F.struct(F.lit(p).alias(period_col), cutoff_lit(c).alias("cutoff_date")) for p, c in cutoffs.items()]))
    rows = state.where(F.col("log_date") <= cutoff_lit(latest)).select(key, "log_date", *MEASURES, tags.alias("_tag")).select("*", "_tag.*").drop("_tag")
    rows = rows.where(F.col("log_date") <= F.col("cutoff_date")).withColumn(fe.AGE, F.datediff("cutoff_date", "log_date"))
    keys = [period_col, key]
    return fe._semi(fe._log_member_aggregate(fe._may_be_in(rows, cohort, keys), keys, windows), cohort, keys)
