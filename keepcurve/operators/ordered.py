"""Distributed global ordering: prefix sums, row numbers, ranks, quantiles.

``Window.orderBy`` without ``partitionBy`` moves every row into one task, so
it is never used on member-sized data here.  Instead (survey section 4.3):

1. rows are range-partitioned by (group, value, tie-break) with Spark's own
   sampled split points over the whole key, whatever its types, so a value
   with many rows is divided by its tie-break and no range grows with it;
2. the result is written to the checkpoint folder, which fixes each row's
   range for all that follows;
3. totals per (group, range), a table of at most groups x ranges rows, and
   their exclusive prefix give each range's offset;
4. a window within each range, plus the offset.

There is one path for every input size.  Order is Spark's: NaN above all
numbers (so first when descending), rows with a null value are dropped.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keepcurve.session import cut_lineage


def row_prefix(df: DataFrame, value_col: str, tiebreak_col: str | None = None,
               measures: Mapping[str, Column] | None = None, partition_cols: Sequence[str] = (),
               descending: bool = False, n_ranges: int | None = None,
               rn_col: str = "rn", n_col: str = "n_total") -> DataFrame:
    """Row numbers and running sums in a global order, without a global sort.

    Order is ``value_col`` (ascending, or descending) then ``tiebreak_col``
    ascending, within each ``partition_cols`` group.  Rows with a null value
    are dropped.  ``n_ranges`` (default: the session's shuffle partitions) is
    the number of sorted ranges.

    Adds: ``rn`` (1-based), ``n_total`` (rows in the group) and, for each
    measure ``m``, ``cum_m`` (inclusive running sum) and ``tot_m``.
    """
    measures = dict(measures or {})
    groups = list(partition_cols)
    order = ([F.col(value_col).desc() if descending else F.col(value_col).asc()]
             + ([F.col(tiebreak_col).asc()] if tiebreak_col else []))
    base = df.where(F.col(value_col).isNotNull())
    for m, expr in measures.items():
        base = base.withColumn(f"_m_{m}", expr)
    n_ranges = n_ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = base.repartitionByRange(n_ranges, *[F.col(g) for g in groups], *order)
    ranged = cut_lineage(ranged.withColumn("_range", F.spark_partition_id()))

    totals = ranged.groupBy(*groups, "_range").agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(f"_m_{m}").alias(f"_sum_{m}") for m in measures])
    whole = Window.partitionBy(*groups)
    before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    key = [*groups, "_range"]
    offsets = totals.select(
        *[F.col(k).alias(f"_key{i}") for i, k in enumerate(key)],
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        F.sum("_rows").over(whole).alias(n_col),
        *[F.coalesce(F.sum(f"_sum_{m}").over(before), F.lit(0)).alias(f"_before_{m}") for m in measures],
        *[F.sum(f"_sum_{m}").over(whole).alias(f"tot_{m}") for m in measures])
    out = ranged.join(offsets, [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(key)])
    inside = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = out.withColumn(rn_col, (F.col("_rows_before") + F.count(F.lit(1)).over(inside)).cast("long"))
    for m in measures:
        out = out.withColumn(f"cum_{m}", F.col(f"_before_{m}") + F.sum(f"_m_{m}").over(inside))
    return out.drop("_range", "_rows_before", *[f"_key{i}" for i in range(len(key))],
                    *[f"_m_{m}" for m in measures], *[f"_before_{m}" for m in measures])


def value_prefix(df: DataFrame, value_col: str, measures: Mapping[str, Column] | None = None,
                 partition_cols: Sequence[str] = (), descending: bool = False,
                 n_ranges: int | None = None) -> DataFrame:
    """One row per (group, distinct value) with tie-collapsed totals.

    Ties are collapsed first by a partial + final aggregate (a hot value
    becomes one row map-side).  Output columns: partition cols, value,
    ``n`` (rows at the value), ``n_before`` (rows strictly before in the
    order), ``n_total``; and for each measure ``m``: ``m`` (sum at the
    value), ``m_before`` and ``tot_m``.
    """
    measures = dict(measures or {})
    P = list(partition_cols)
    from pyspark.sql import types as T

    if isinstance(df.schema[value_col].dataType, (T.DoubleType, T.FloatType)):
        # -0.0 and 0.0 are one value
        df = df.withColumn(value_col, F.when(F.col(value_col) == 0, F.lit(0.0).cast(df.schema[value_col].dataType))
                           .otherwise(F.col(value_col)))
    distinct = (df.where(F.col(value_col).isNotNull())
                  .groupBy(*P, value_col)
                  .agg(F.count(F.lit(1)).alias("n"), *[F.sum(e).alias(m) for m, e in measures.items()]))
    ms = {"n": F.col("n"), **{m: F.col(m) for m in measures}}
    out = row_prefix(distinct, value_col, None, ms, P, descending, n_ranges, rn_col="_rank", n_col="_nd")
    out = (out.drop("_rank", "_nd").withColumnRenamed("tot_n", "n_total")
              .withColumn("n_before", F.col("cum_n") - F.col("n")).drop("cum_n"))
    for m in measures:
        out = out.withColumn(f"{m}_before", F.col(f"cum_{m}") - F.col(m)).drop(f"cum_{m}")
    return out


def average_ranks(df: DataFrame, value_col: str, out_col: str = "rank_avg", pct_col: str | None = None,
                  partition_cols: Sequence[str] = (), n_ranges: int | None = None) -> DataFrame:
    """Ties-averaged rank of each row (1-based), and optionally rank/n.

    Equivalent to pandas ``rank(method='average'[, pct=True])``; rows with a
    null value get a null rank.  Ranks are computed on the distinct-value
    table and joined back on (group, value); the planner broadcasts that
    table only when it is measured small, and AQE splits a skewed join key.
    """
    P = list(partition_cols)
    vp = value_prefix(df, value_col, None, P, False, n_ranges)
    ranks = vp.select(*[F.col(p).alias(f"_p{i}") for i, p in enumerate(P)], F.col(value_col).alias("_v"),
                      (F.col("n_before") + (F.col("n") + 1) / 2.0).alias(out_col),
                      F.col("n_total").alias("_nt"))
    cond = [F.col(value_col) == F.col("_v")] + [F.col(p) == F.col(f"_p{i}") for i, p in enumerate(P)]
    out = df.join(ranks, cond, "left").drop("_v", *[f"_p{i}" for i in range(len(P))])
    if pct_col:
        out = out.withColumn(pct_col, F.col(out_col) / F.col("_nt"))
    return out.drop("_nt")


def exact_quantiles(df: DataFrame, value_col: str, probs: Sequence[float],
                    partition_cols: Sequence[str] = (), n_ranges: int | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation (numpy/pandas default).

    Position ``h = (n - 1) q``; the value at order position ``j`` is the
    distinct value whose cumulative count range covers ``j``.  One aggregate
    over the distinct values picks the values at floor(h) and ceil(h) of
    every probability.  Output: partition cols, ``q`` (index), ``prob``,
    ``value``.
    """
    P = list(partition_cols)
    vp = value_prefix(df, value_col, None, P, False, n_ranges)
    value = F.col(value_col).cast("double")
    last = F.col("n_before") + F.col("n") - 1

    def at(position: Column) -> Column:
        return F.max(F.when((F.col("n_before") <= position) & (position <= last), value))

    h = [(F.col("n_total") - 1) * F.lit(float(q)) for q in probs]
    found = vp.groupBy(*P).agg(F.first("n_total").alias("_n"), *[at(F.floor(x)).alias(f"_lo{i}") for i, x in enumerate(h)],
                               *[at(F.ceil(x)).alias(f"_hi{i}") for i, x in enumerate(h)])
    rows = []
    for i, q in enumerate(probs):
        position = (F.col("_n") - 1) * F.lit(float(q))
        v = F.col(f"_lo{i}") + (position - F.floor(position)) * (F.col(f"_hi{i}") - F.col(f"_lo{i}"))
        rows.append(F.struct(F.lit(i).alias("q"), F.lit(float(q)).alias("prob"), v.alias("value")))
    return found.where("_n IS NOT NULL").select(*P, F.explode(F.array(*rows)).alias("_row")).select(*P, "_row.*")
