"""Champion selection and the champion/challenger promotion gate.

The model registry is a metrics table: ``model, version, alias, metric,
value`` (one row per logged metric).  Everything is a DataFrame join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the original gate.
PROMOTION_METRIC = "pr_auc"
PROMOTION_TOLERANCE = 0.005


def select_champion(metrics: DataFrame, metric: str = PROMOTION_METRIC, order_col: str = "ord") -> DataFrame:
    """Arg-max of ``metric`` over models; the earliest (lowest
    ``order_col``) wins ties.  Input columns: model, <order_col>, metric, value."""
    m = metrics.where(F.col("metric") == metric)
    best = F.max_by(F.struct("model", "value"), F.struct(F.col("value"), -F.col(order_col)))
    return m.agg(best.alias("b")).select(F.col("b.model").alias("model"), F.col("b.value").alias("value"))


def champion_metric(registry: DataFrame, metric: str = PROMOTION_METRIC, model: str | None = None) -> DataFrame:
    """G1: the champion's metric (zero rows when there is no champion)."""
    r = registry.where((F.col("alias") == "champion") & (F.col("metric") == metric))
    if model is not None:
        r = r.where(F.col("model") == model)
    return r.select("model", F.col("version").alias("champion_version"), F.col("value").alias("champion_value"))


def promotion_gate(candidate: DataFrame, registry: DataFrame, metric: str = PROMOTION_METRIC,
                   tolerance: float = PROMOTION_TOLERANCE) -> DataFrame:
    """Promote iff there is no champion or cand >= champ - tolerance.

    ``candidate``: model, version, metric, value.  Returns one row per
    candidate: model, candidate_version, candidate_value, champion_version,
    champion_value, promoted.
    """
    c = candidate.where(F.col("metric") == metric).select(
        "model", F.col("version").alias("candidate_version"), F.col("value").alias("candidate_value"))
    champ = champion_metric(registry, metric)
    j = c.join(champ, "model", "left")
    promote = F.col("champion_value").isNull() | (
        F.col("candidate_value") >= F.col("champion_value") - F.lit(tolerance))
    return j.withColumn("promoted", promote)


def apply_gate(registry: DataFrame, candidate: DataFrame, metric: str = PROMOTION_METRIC,
               tolerance: float = PROMOTION_TOLERANCE) -> DataFrame:
    """The registry after the gate: the candidate's metrics are logged, and
    where it is promoted the champion alias moves to it.  Columns as the
    registry's: model, version, alias, metric, value."""
    decided = promotion_gate(candidate, registry, metric, tolerance).select(
        F.col("model").alias("_model"), F.col("candidate_version").alias("_version"), F.coalesce("promoted", F.lit(False)).alias("_won"))
    won = F.coalesce(F.col("_won"), F.lit(False))
    keeps = ~(won & F.coalesce(F.col("alias") == "champion", F.lit(False)))
    old = registry.join(decided.drop("_version"), F.col("model") == F.col("_model"), "left").withColumn("alias", F.when(keeps, F.col("alias")))
    new = candidate.join(decided, (F.col("model") == F.col("_model")) & (F.col("version") == F.col("_version")), "left")
    new = new.withColumn("alias", F.when(won, F.lit("champion")))
    columns = ["model", "version", "alias", "metric", "value"]
    return old.select(columns).unionByName(new.select(columns))
