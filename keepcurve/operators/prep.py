"""Feature preparation for models.

Fit steps are one aggregate each (exact medians through the distributed
quantile helper, then means/std); transforms are projections.  Spark ML
stages are used where their semantics match (``Imputer``,
``StringIndexer``, ``OneHotEncoder``, ``VectorAssembler``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepcurve.operators.ordered import exact_quantiles


def _long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    kv = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
                             for c in cols])).alias("kv")
    return df.select(*cols).select(kv).select("kv.*")


def median_impute_fit(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """N1 fit, part 1: exact median per column (nulls ignored)."""
    long = _long(df, cols)
    return exact_quantiles(long, "value", [0.5], ["feature"]).select("feature", F.col("value").alias("median"))


def standardize_fit(df: DataFrame, cols: Sequence[str], ddof: int = 0) -> DataFrame:
    """N1 fit: median, then mean and std (population std by default, as a
    standard scaler does) of the median-filled columns."""
    long = _long(df, cols)
    med = exact_quantiles(long, "value", [0.5], ["feature"]).select("feature", F.col("value").alias("median"))
    filled = long.join(med, "feature").withColumn("v", F.coalesce("value", "median"))
    std = F.stddev_pop("v") if ddof == 0 else F.stddev_samp("v")
    return med.join(filled.groupBy("feature").agg(F.avg("v").alias("mean"), std.alias("std")), "feature")


def impute_scale_transform(df: DataFrame, stats: Mapping[str, tuple], keep: Sequence[str] = ()) -> DataFrame:
    """N1 transform: ``(coalesce(x, median) - mean) / std`` (std 0 -> centred only)."""
    out = []
    for c, (median, mean, std) in stats.items():
        x = F.coalesce(F.col(c).cast("double"), F.lit(float(median)) if median is not None else F.lit(None))
        x = x - F.lit(float(mean or 0.0))
        if std:
            x = x / F.lit(float(std))
        out.append(x.alias(c))
    return df.select(*keep, *out)


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weights ``n / (2 n_c)`` per class and
    ``scale_pos_weight = n_neg / max(n_pos, 1)`` (one aggregate)."""
    c = df.groupBy().agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("n_pos"))
    rows = F.array(F.struct(F.lit(0).alias("class"), (F.col("n") - F.col("n_pos")).alias("n_class")),
                   F.struct(F.lit(1).alias("class"), F.col("n_pos").alias("n_class")))
    out = c.select("n", "n_pos", F.explode(rows).alias("r")).select("n", "n_pos", "r.*")
    return out.select("class", "n_class",
                      F.when(F.col("n_class") > 0, F.col("n") / (2.0 * F.col("n_class"))).alias("balanced_weight"),
                      ((F.col("n") - F.col("n_pos")) / F.greatest(F.col("n_pos"), F.lit(1))).alias("scale_pos_weight"))


def mode_impute_fit(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """N2 fit: most frequent value per column; the smallest of equally
    frequent ones."""
    counts = _long(df, cols).where(F.col("value").isNotNull()).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("order"), "value")).alias("best")
    return counts.groupBy("feature").agg(best).select("feature", F.col("best.value").alias("mode"))


def one_hot_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows per category after the mode fill (the column sums of the
    one-hot matrix)."""
    filled = _long(df, cols).join(mode_impute_fit(df, cols), "feature").withColumn("category", F.coalesce("value", "mode"))
    return filled.groupBy("feature", "category").agg(F.count(F.lit(1)).alias("n"))
