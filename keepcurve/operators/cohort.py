"""Cohorts, sampling and splits.

Exact, reproducible sampling orders rows by ``md5('<seed>:<key>')`` inside
each stratum and keeps a fixed count per stratum.  The order is computed
with :func:`keepcurve.operators.ordered.row_prefix` (bucketed, no
single-task window), so a stratum holding most rows is still spread over
many tasks.  ``sample_bernoulli`` keeps the original per-row ``sampleBy``
behaviour (expected, not exact, proportions).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepcurve.functions.exprs import hash_u64
from keepcurve.operators.ordered import row_prefix

SAMPLE_FRACTION = 0.25
RANDOM_SEED = 42


def sample_bernoulli(labels: DataFrame, strata_col: str, fractions: Mapping, seed: int = RANDOM_SEED) -> DataFrame:
    """M1 (original behaviour): per-row Bernoulli draw per stratum."""
    return labels.sampleBy(strata_col, fractions=dict(fractions), seed=seed)


def hash_order(df: DataFrame, key: str, strata: Sequence[str], seed: int) -> DataFrame:
    """Adds ``rn`` (1-based position by md5 hash, key as tie-break) and
    ``n_total`` within each stratum."""
    h = df.withColumn("_h", hash_u64(F.col(key), seed))
    return row_prefix(h, "_h", key, None, list(strata)).drop("_h")


def stratified_sample(df: DataFrame, key: str, strata_col: str, fraction: float = SAMPLE_FRACTION,
                      seed: int = RANDOM_SEED) -> DataFrame:
    """M1 exact: keep ``floor(fraction * n_s)`` rows of every stratum ``s``."""
    o = hash_order(df, key, [strata_col], seed)
    return o.where(F.col("rn") <= F.floor(F.col("n_total") * F.lit(fraction))).drop("rn", "n_total")


def stratified_split(df: DataFrame, key: str, strata_col: str, test_fraction: float = 0.2,
                     seed: int = RANDOM_SEED, split_col: str = "split",
                     names: tuple[str, str] = ("train", "valid")) -> DataFrame:
    """M2/M5: per stratum, the first ``ceil(test_fraction * n_s)`` rows in
    hash order form the held-out side; the rest is train."""
    o = hash_order(df, key, [strata_col], seed)
    held = F.col("rn") <= F.ceil(F.col("n_total") * F.lit(test_fraction))
    return o.withColumn(split_col, F.when(held, names[1]).otherwise(names[0])).drop("rn", "n_total")


def cohort_labels(labels: DataFrame, sampled: DataFrame, key: str = "msno") -> DataFrame:
    """J1 + A7: labels of exactly the sampled members (semi join: a member
    listed twice in ``sampled`` does not duplicate label rows)."""
    return labels.join(sampled.select(key).distinct(), key, "left_semi")


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """D15 guard: keys that occur more than once (empty when unique)."""
    return df.groupBy(key).count().where(F.col("count") > 1)


def oot_split(snapshots: DataFrame, train_period: str, period_col: str = "period",
              split_col: str = "split") -> DataFrame:
    """M3: out-of-time split: the train period vs every later period."""
    return snapshots.withColumn(split_col, F.when(F.col(period_col) == train_period, "train").otherwise("oot"))


def ab_assignment(df: DataFrame, key: str, seed: int = RANDOM_SEED, col: str = "treatment") -> DataFrame:
    """M6: seeded 50/50 assignment from the low bit of the md5 hash."""
    return df.withColumn(col, (hash_u64(F.col(key), seed) % 2).cast("int"))


def pooled(snapshots: Sequence[DataFrame]) -> DataFrame:
    """Pool periods by column name."""
    out = snapshots[0]
    for s in snapshots[1:]:
        out = out.unionByName(s)
    return out


def naive_split_overlap(pooled_rows: DataFrame, key: str, period_col: str, label_col: str,
                        train_size: int, test_fraction: float = 0.2, seed: int = RANDOM_SEED) -> DataFrame:
    """M4: pooled random split (rows = member x period, stratified on the
    label), train side cut to its first ``train_size`` rows in a second hash
    order, and the number of members that sit on both sides.

    Returns one row: ``n_train, n_test, n_members_both_sides``.
    """
    rows = pooled_rows.withColumn("_rk", F.concat_ws("|", F.col(key).cast("string"), F.col(period_col)))
    o = hash_order(rows, "_rk", [label_col], seed)
    o = o.withColumn("_test", F.col("rn") <= F.ceil(F.col("n_total") * F.lit(test_fraction)))
    test = o.where("_test").select(key)
    train = o.where(~F.col("_test")).drop("rn", "n_total").withColumn("_h", hash_u64(F.col("_rk"), seed + 1))
    train = (row_prefix(train, "_h", "_rk", None, (), rn_col="_trn", n_col="_tn")
             .where(F.col("_trn") <= F.lit(int(train_size))).select(key))
    both = train.distinct().join(test.distinct(), key, "left_semi")
    tagged = (train.select(F.lit("train").alias("_t"))
              .unionByName(test.select(F.lit("test").alias("_t")))
              .unionByName(both.select(F.lit("both").alias("_t"))))
    return tagged.agg(F.count_if(F.col("_t") == "train").alias("n_train"),
                      F.count_if(F.col("_t") == "test").alias("n_test"),
                      F.count_if(F.col("_t") == "both").alias("n_members_both_sides"))
