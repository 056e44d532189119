"""Transactions as mergeable state per delivery.

Deliveries overlap and are deduplicated by whole rows, so a delivery is stored
with a digest per row: of the next one, rows whose digest an earlier delivery
holds are left out before their state is taken.  Only digests of the new
delivery's dates are read.  The state itself is, each as one Parquet table,

  * ``days``: per (member, day) the number of transactions, cancellations and
    discounts, the sum of discounts and the fields of the day's latest row;
  * ``plans``: the distinct (member, day, list price);
  * ``sketches``: per (member, day) a HyperLogLog sketch of the list prices.

States of several deliveries add up, so a snapshot of any cutoff reads days
and never the raw rows.  Distinct plans are counted exactly from ``plans``, or
estimated for every window from ``sketches``, whose union needs no shuffle by
price and no deduplication (a row seen twice changes no sketch).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keepcurve.functions.dates import as_date, cutoff_lit
from keepcurve.operators import features as fe
from keepcurve.session import cut_lineage

SKETCH_LG_K = 12  # relative standard error 1.6 %; a few hundred values are counted as good as exactly
DATE = "transaction_date"
TABLES = ("days", "plans", "sketches")


@dataclass(frozen=True)
class TxState:
    days: DataFrame
    plans: DataFrame
    sketches: DataFrame


def row_digest(df: DataFrame) -> Column:
    """md5 of all fields with their names, nulls apart from every value; rows
    are told apart whatever the order of their columns."""
    return F.md5(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}))


def _dated(tx: DataFrame) -> DataFrame:
    t = tx.withColumn("membership_expire_date", as_date(tx, "membership_expire_date")).withColumn(DATE, as_date(tx, DATE))
    return t.where(F.col(DATE).isNotNull())


def tx_state(tx: DataFrame, key: str = "msno", tie_break: str | None = "tx_id") -> TxState:
    """The state of transactions without repeated rows; rows without a date are left out."""
    t = _dated(tx)
    t = t.withColumn("discount", F.col("plan_list_price") - F.col("actual_amount_paid")).withColumn("_recency", fe._recency(t, tie_break))
    fields = [*fe.LATEST_TX_FIELDS, "membership_expire_date", *([tie_break] if tie_break in t.columns else [])]
    days = t.groupBy(key, DATE).agg(*[F.max_by(c, "_recency").alias(c) for c in fields], F.count("*").alias("n"),
                                    F.sum(F.col("is_cancel").cast("long")).alias("cancelled"), F.sum("discount").alias("discount"),
                                    F.count("discount").alias("discounts"))
    priced = t.where(F.col("plan_list_price").isNotNull())
    sketch = F.hll_sketch_agg("plan_list_price", F.lit(SKETCH_LG_K)).alias("sketch")
    return TxState(days, priced.select(key, DATE, "plan_list_price").distinct(), priced.groupBy(key, DATE).agg(sketch))


def write_tx_state(tx: DataFrame, path: str, delivery: str, earlier: Sequence[str] = (), key: str = "msno",
                   tie_break: str | None = "tx_id") -> None:
    """Store a delivery's state below ``path``, without its repeated rows and
    without rows that a delivery in ``earlier`` holds.

    Written again, a delivery replaces its own tables, so a run that failed is
    run again; if its rows changed, the deliveries that named it as earlier
    must be written again too."""
    spark = tx.sparkSession
    rows = tx.dropDuplicates()
    rows = rows.withColumns({"_digest": row_digest(tx), "_day": as_date(tx, DATE)}).where(F.col("_day").isNotNull())
    if earlier:
        known = spark.read.parquet(*[f"{path}/digests/{d}" for d in earlier])
        span = rows.agg(F.min("_day").alias("lo"), F.max("_day").alias("hi")).first()
        known = known.where(F.col("_day").between(F.lit(span["lo"]), F.lit(span["hi"])))
        rows = rows.join(known, ["_digest", "_day"], "left_anti")
    rows = cut_lineage(rows)
    state = tx_state(rows.drop("_digest", "_day"), key, tie_break)
    for name in TABLES:
        getattr(state, name).write.mode("overwrite").parquet(f"{path}/{name}/{delivery}")
    rows.select("_digest", "_day").write.mode("overwrite").parquet(f"{path}/digests/{delivery}")


def read_tx_state(spark: SparkSession, path: str, deliveries: Sequence[str]) -> TxState:
    return TxState(*[spark.read.parquet(*[f"{path}/{name}/{d}" for d in deliveries]) for name in TABLES])


def _per_cutoff(df: DataFrame, cutoffs: Mapping[str, object], period_col: str) -> DataFrame:
    """Each row once per period whose cutoff it precedes, with its age there."""
    latest = max(str(c)[:10] for c in cutoffs.values())
    tags = F.explode(F.array(*[F.struct(F.lit(p).alias(period_col), cutoff_lit(c).alias("cutoff_date")) for p, c in cutoffs.items()]))
    tagged = df.where(F.col(DATE) <= cutoff_lit(latest)).select("*", tags.alias("_tag")).select("*", "_tag.*").drop("_tag")
    return tagged.where(F.col(DATE) <= F.col("cutoff_date")).withColumn(fe.AGE, F.datediff("cutoff_date", DATE))


def tx_features_from_state(state: TxState, cutoffs: Mapping[str, object], key: str = "msno", tie_break: str | None = "tx_id",
                           cohort: DataFrame | None = None, windows: Sequence[int] = fe.LOOKBACK_WINDOWS_DAYS,
                           period_col: str = "period") -> DataFrame:
    """``features.transaction_features`` per period (period -> cutoff), from
    the states alone.  ``cohort`` is a table of (period, member)."""
    keys = [period_col, key]
    days = _per_cutoff(state.days, cutoffs, period_col).withColumn(
        "membership_expires_in_days", F.datediff("membership_expire_date", "cutoff_date"))
    totals = [*(fe.Feature(f"n_transactions_last_{d}d", "sum", "n", (0, d)) for d in windows),
              fe.Feature("n_cancellations_lifetime", "sum", "cancelled"), fe.Feature("n_transactions_lifetime", "sum", "n"),
              fe.Feature("_discount", "sum", "discount"), fe.Feature("_discounts", "sum", "discounts")]
    plans = fe._plans_in_window(fe._may_be_in(_per_cutoff(state.plans, cutoffs, period_col), cohort, keys), keys)
    out = fe._tx_totals(fe._may_be_in(days, cohort, keys), plans, keys, windows, totals, tie_break, latest=True)
    return fe._semi(out, cohort, keys)


def distinct_plans_estimate(state: TxState, cutoffs: Mapping[str, object], key: str = "msno",
                            windows: Sequence[int] = fe.LOOKBACK_WINDOWS_DAYS, period_col: str = "period") -> DataFrame:
    """A4, approximate: ``(period, member, n_distinct_plans_last_<d>d ...)`` by
    merging the days' sketches per window; members with a price before the cutoff."""
    keys = [period_col, key]
    days = _per_cutoff(state.sketches, cutoffs, period_col)
    inside = lambda d: F.when(F.col(fe.AGE).between(0, d), F.col("sketch"))
    merged = days.groupBy(*keys).agg(*[F.hll_union_agg(inside(d)).alias(f"_{d}") for d in windows])
    return merged.select(*keys, *[F.hll_sketch_estimate(f"_{d}").alias(f"n_distinct_plans_last_{d}d") for d in windows])
