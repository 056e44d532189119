"""Uplift evaluation and targeting.

The Qini curve needs cumulative treated / control / outcome counts in
score order over the whole population: computed with the bucketed
``row_prefix`` (order: score descending, key ascending as the tie-break,
so the row-level curve is deterministic).  The Qini coefficient of a curve
with uniform spacing 1/n reduces to one aggregate -- no lag window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepcurve.functions.exprs import hash_fraction
from keepcurve.operators.ordered import row_prefix


def qini_curve(df: DataFrame, score: str, key: str, treatment: str = "treatment",
               outcome: str = "observed_retained", partition_cols: Sequence[str] = ()) -> DataFrame:
    """``qini(k) = Y_T(k) - Y_C(k) * n_T(k) / n_C(k)`` (ratio 0 while
    ``n_C(k) = 0``) at every rank ``k``, with ``population_fraction = k/n``."""
    t = F.col(treatment).cast("long")
    y = F.col(outcome).cast("long")
    ms = {"t": t, "c": 1 - t, "yt": y * t, "yc": y * (1 - t)}
    p = row_prefix(df.select(*partition_cols, key, score, treatment, outcome), score, key, ms,
                   partition_cols, descending=True)
    ratio = F.when(F.col("cum_c") > 0, F.col("cum_t") / F.col("cum_c")).otherwise(F.lit(0.0))
    return p.select(*partition_cols, key, score, "rn",
                    (F.col("rn") / F.col("n_total")).alias("population_fraction"),
                    (F.col("cum_yt") - F.col("cum_yc") * ratio).alias("qini"))


def thin_curve(curve: DataFrame, points: int, x: str = "population_fraction", y: str = "qini", place: str = "rn",
               partition_cols: Sequence[str] = ()) -> DataFrame:
    """X4 for plots: about ``points`` rows of a curve, evenly spaced by rank,
    with ``max_error``: the largest vertical distance between the whole curve
    and the straight line from a kept row to the next one.  First and last
    rows are always kept, so the area between the thinned and the whole curve
    is at most the mean of ``max_error``."""
    P = list(partition_cols)
    n = curve.groupBy(*P).agg(F.max(place).alias("_n"))
    c = curve.join(n, P) if P else curve.withColumn("_n", F.lit(n.first()["_n"]))
    # steps of equal rank; a row that begins a step also ends the one before
    step = F.floor((F.col(place) - 1) * points / F.col("_n"))
    c = c.withColumn("_step", step).withColumn("_start", F.floor((F.col(place) - 2) * points / F.col("_n")) != F.col("_step"))
    both = c.withColumn("_in", F.explode(F.when(F.col("_start") & (F.col(place) > 1), F.array(F.col("_step") - 1, F.col("_step"))).otherwise(F.array("_step"))))
    at = F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    ends = both.groupBy(*P, "_in").agg(F.min_by(at, place).alias("_a"), F.max_by(at, place).alias("_b"))
    j = both.join(ends, [*P, "_in"])
    dx = F.col("_b.x") - F.col("_a.x")
    line = F.col("_a.y") + F.when(dx != 0, (F.col(x) - F.col("_a.x")) / dx * (F.col("_b.y") - F.col("_a.y"))).otherwise(F.lit(0.0))
    out = j.groupBy(*P, "_in").agg(F.min_by(F.struct(place, x, y), place).alias("_row"), F.max(F.abs(F.col(y) - line)).alias("max_error"))
    last = c.where(F.col(place) == F.col("_n")).select(*P, F.struct(place, x, y).alias("_row"), F.lit(0.0).alias("max_error"))
    first_is_last = out.select(*P, "_row", "max_error").unionByName(last)
    return first_is_last.groupBy(*P, F.col(f"_row.{place}").alias(place)).agg(
        F.first(f"_row.{x}").alias(x), F.first(f"_row.{y}").alias(y), F.max("max_error").alias("max_error"))


def qini_coefficient(curve: DataFrame, partition_cols: Sequence[str] = ()) -> DataFrame:
    """Trapezoid area between the curve and the diagonal to its end
    point, over x = 1/n .. 1 (uniform spacing h = 1/n):
    ``h * (sum f - (f_1 + f_n) / 2)`` with ``f = qini - x * qini_n``."""
    a = curve.groupBy(*partition_cols).agg(
        F.count(F.lit(1)).alias("n"), F.sum("qini").alias("s"),
        F.max_by("qini", "rn").alias("last"), F.min_by("qini", "rn").alias("first"))
    n = F.col("n").cast("double")
    sum_f = F.col("s") - F.col("last") * (n + 1) / 2.0
    f1 = F.col("first") - F.col("last") / n
    coef = F.when(n > 1, (sum_f - f1 / 2.0) / n).otherwise(F.lit(0.0))
    return a.select(*partition_cols, coef.alias("qini_coefficient"), F.col("last").alias("qini_at_full"))


def random_score(df: DataFrame, key: str, seed: int = 0, out_col: str = "random_score") -> DataFrame:
    """Reproducible random ranking from ``md5(seed:key)``."""
    return df.withColumn(out_col, hash_fraction(F.col(key), seed))


def targeting_list(uplift: DataFrame, ltv_table: DataFrame, keys: Sequence[str] = ("msno", "period"),
                   uplift_col: str = "predicted_uplift", ltv_col: str = "ltv") -> DataFrame:
    """X7 + O2: expected value of an offer = uplift x LTV, highest first.

    Joined on (member, period): the LTV table pools periods, and a join on
    the member alone would fan a member out to one row per period (D9).
    The global ``orderBy`` is a range-partitioned distributed sort.
    """
    j = uplift.join(ltv_table, list(keys))
    return (j.withColumn("expected_value_of_offer", F.col(uplift_col) * F.col(ltv_col))
             .orderBy(F.col("expected_value_of_offer").desc_nulls_last(), *[F.col(k) for k in keys]))


def top_targets(targets: DataFrame, n: int = 10) -> DataFrame:
    """O3: top-n by expected value (TakeOrderedAndProject, a bounded heap per task)."""
    return targets.limit(n)


def uplift_by_segment(targets: DataFrame, seg_col: str = "retention_priority_segment",
                      uplift_col: str = "predicted_uplift") -> DataFrame:
    """A10: mean predicted uplift per retention segment."""
    return targets.groupBy(seg_col).agg(F.avg(uplift_col).alias("mean_predicted_uplift"))
