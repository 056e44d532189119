"""Evaluation operators over a scored DataFrame (E1-E9, C4 consumers).

Input: one row per scored unit with a 0/1 label and a score.  Every metric
is a Spark aggregate; the ranking metrics (ROC-AUC, average precision,
calibration quantiles) use the tie-collapsed distributed prefix from
:mod:`keepcurve.operators.ordered`, so equal scores are handled exactly
(ties averaged) and no global sort runs in one task.

Optional ``partition_cols`` (e.g. model, split, period) compute the metric
per group in the same job.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepcurve.operators.ordered import exact_quantiles, value_prefix

# Log-loss clipping uses float64 machine epsilon; the F1
# threshold grid is 0.01, 0.02, ..., 0.99 (99 points).
LOG_LOSS_EPS = float(np.finfo(np.float64).eps)
F1_THRESHOLDS = [float(t) for t in np.linspace(0.01, 0.99, 99)]


def _pos(label: str) -> Column:
    return F.col(label).cast("double")


def roc_auc(df: DataFrame, label: str = "label", score: str = "score",
            partition_cols: Sequence[str] = ()) -> DataFrame:
    """ROC-AUC = P(score_pos > score_neg) + 0.5 P(tie), via per-score
    positive/negative counts and the running negative count below each score."""
    P = list(partition_cols)
    vp = value_prefix(df, score, {"pos": _pos(label), "neg": 1.0 - _pos(label)}, P)
    num = F.sum(F.col("pos") * (F.col("neg_before") + 0.5 * F.col("neg")))
    den = F.first("tot_pos") * F.first("tot_neg")
    return vp.groupBy(*P).agg(F.when(den > 0, num / den).alias("roc_auc"))


def average_precision(df: DataFrame, label: str = "label", score: str = "score",
                      partition_cols: Sequence[str] = ()) -> DataFrame:
    """AP = sum_k (R_k - R_{k-1}) P_k over distinct thresholds, descending
    (step sum, not the trapezoid)."""
    P = list(partition_cols)
    vp = value_prefix(df, score, {"pos": _pos(label), "neg": 1.0 - _pos(label)}, P, descending=True)
    tp = F.col("pos_before") + F.col("pos")
    fp = F.col("neg_before") + F.col("neg")
    prec = tp / (tp + fp)
    tot = F.first("tot_pos")
    return vp.groupBy(*P).agg(F.when(tot > 0, F.sum(F.col("pos") * prec) / tot).alias("pr_auc"))


def log_loss(df: DataFrame, label: str = "label", score: str = "score", eps: float = LOG_LOSS_EPS,
             partition_cols: Sequence[str] = ()) -> DataFrame:
    """Mean binary cross-entropy with scores clipped to [eps, 1 - eps]."""
    p = F.least(F.greatest(F.col(score).cast("double"), F.lit(eps)), F.lit(1 - eps))
    y = _pos(label)
    ll = -(y * F.ln(p) + (1 - y) * F.ln(1 - p))
    return df.groupBy(*partition_cols).agg(F.avg(ll).alias("log_loss"))


def brier_score(df: DataFrame, label: str = "label", score: str = "score",
                partition_cols: Sequence[str] = ()) -> DataFrame:
    """Mean squared difference of score and label."""
    d = F.col(score).cast("double") - _pos(label)
    return df.groupBy(*partition_cols).agg(F.avg(d * d).alias("brier_score"))


def _f1(tp: Column, fp: Column, fn: Column) -> Column:
    den = 2 * tp + fp + fn
    return F.when(den > 0, (2 * tp).cast("double") / den).otherwise(F.lit(0.0))


def confusion_counts(df: DataFrame, threshold: float | Column, label: str = "label", score: str = "score",
                     partition_cols: Sequence[str] = ()) -> DataFrame:
    """Confusion counts of ``score >= threshold`` (one pass)."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    pred = F.col(score) >= t
    y = F.col(label) == 1
    return df.groupBy(*partition_cols).agg(
        F.count_if(pred & y).alias("tp"), F.count_if(pred & ~y).alias("fp"),
        F.count_if(~pred & y).alias("fn"), F.count_if(~pred & ~y).alias("tn"))


def f1_at_threshold(df: DataFrame, threshold: float, label: str = "label", score: str = "score",
                    partition_cols: Sequence[str] = ()) -> DataFrame:
    """E5: F1 of the positive class at ``score >= threshold`` (0 if undefined)."""
    c = confusion_counts(df, threshold, label, score, partition_cols)
    return c.select(*partition_cols, _f1(F.col("tp"), F.col("fp"), F.col("fn")).alias("f1_at_threshold"))


def best_f1_threshold(df: DataFrame, label: str = "label", score: str = "score",
                      thresholds: Sequence[float] = F1_THRESHOLDS, partition_cols: Sequence[str] = ()) -> DataFrame:
    """Threshold of the grid with the highest F1; the lowest wins ties.

    Each score goes to the number of thresholds at or below it; positives and
    rows per such bucket (at most one more than thresholds) are one hash
    aggregate, and sums over the buckets above a threshold give its counts.
    """
    P = list(partition_cols)
    grid = F.array(*[F.lit(float(t)) for t in sorted(thresholds)])
    reached = F.size(F.filter(grid, lambda t: t <= F.col(score)))
    cells = (df.where(F.col(score).isNotNull()).withColumn("reached", reached)
               .groupBy(*P, "reached").agg(F.count_if(F.col(label) == 1).alias("pos"), F.count(F.lit(1)).alias("rows")))
    positives = df.groupBy(*P).agg(F.count_if(F.col(label) == 1).alias("all_pos"))
    places = F.explode(F.transform(grid, lambda t, i: F.struct((i + 1).alias("place"), t.alias("threshold"))))
    g = positives.select(*P, "all_pos", places.alias("g")).select(*P, "all_pos", "g.*")
    on = [g[p].eqNullSafe(cells[p]) for p in P] + [cells["reached"] >= g["place"]]
    c = g.join(F.broadcast(cells), on, "left").groupBy(*[g[p] for p in P], "all_pos", "place", "threshold").agg(
        F.coalesce(F.sum("pos"), F.lit(0)).alias("tp"), F.coalesce(F.sum("rows"), F.lit(0)).alias("pp"))
    c = c.withColumn("f1", _f1(F.col("tp"), F.col("pp") - F.col("tp"), F.col("all_pos") - F.col("tp")))
    best = c.groupBy(*P).agg(F.min(F.struct((-F.col("f1")).alias("loss"), "place", "threshold")).alias("b"))
    return best.select(*P, F.col("b.threshold").alias("threshold"), (-F.col("b.loss")).alias("f1"))


def classification_report(df: DataFrame, threshold: float, label: str = "label", score: str = "score",
                          partition_cols: Sequence[str] = ()) -> DataFrame:
    """Precision / recall / F1 / support for class 0 and class 1."""
    c = confusion_counts(df, threshold, label, score, partition_cols)

    def cls(k: int, tp: str, fp: str, fn: str) -> Column:
        tpc, fpc, fnc = F.col(tp), F.col(fp), F.col(fn)
        prec = F.when(tpc + fpc > 0, tpc / (tpc + fpc)).otherwise(0.0)
        rec = F.when(tpc + fnc > 0, tpc / (tpc + fnc)).otherwise(0.0)
        return F.struct(F.lit(k).alias("class"), prec.alias("precision"), rec.alias("recall"),
                        _f1(tpc, fpc, fnc).alias("f1"), (tpc + fnc).alias("support"))

    rows = F.array(cls(1, "tp", "fp", "fn"), cls(0, "tn", "fn", "fp"))
    return c.select(*partition_cols, F.explode(rows).alias("r")).select(*partition_cols, "r.*")


def calibration_curve(df: DataFrame, label: str = "label", score: str = "score", n_bins: int = 10,
                      strategy: str = "quantile", partition_cols: Sequence[str] = ()) -> DataFrame:
    """Reliability curve.  Quantile strategy: exact edges at
    0, 1/n, ..., 1 (linear interpolation); bin = number of inner edges
    strictly below the score; empty bins are dropped.

    Output: ``bin, n, mean_predicted, fraction_positives``.
    """
    P = list(partition_cols)
    probs = [i / n_bins for i in range(n_bins + 1)]
    if strategy == "uniform":
        inner = F.array(*[F.lit(float(p)) for p in probs[1:-1]])
        scored = df.withColumn("_inner", inner)
    elif P:
        q = exact_quantiles(df, score, probs, P)
        edges = q.groupBy(*P).agg(F.sort_array(F.collect_list(F.struct("q", "value"))).alias("_e"))
        edges = edges.select(*P, F.slice(F.transform("_e", lambda s: s["value"]), 2, n_bins - 1).alias("_inner"))
        scored = df.join(edges, P)  # one row of n_bins - 1 edges per group
    else:
        # n_bins + 1 numbers: a bounded collect, then literals in the plan.
        qs = sorted(exact_quantiles(df, score, probs).collect(), key=lambda r: r["q"])
        scored = df.withColumn("_inner", F.array(*[F.lit(float(r["value"])) for r in qs[1:-1]]))
    b = F.aggregate("_inner", F.lit(0), lambda acc, e: acc + F.when(e < F.col(score), 1).otherwise(0))
    return (scored.withColumn("bin", b)
                  .groupBy(*P, "bin")
                  .agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(score).cast("double")).alias("mean_predicted"),
                       F.avg(_pos(label)).alias("fraction_positives")))


def metric_table(df: DataFrame, threshold: float, label: str = "label", score: str = "score",
                 partition_cols: Sequence[str] = ()) -> DataFrame:
    """One long table ``(groups..., metric, value)`` with roc_auc,
    pr_auc, log_loss, brier_score, f1_at_threshold and threshold."""
    P = list(partition_cols)
    parts = [roc_auc(df, label, score, P), average_precision(df, label, score, P),
             log_loss(df, label, score, partition_cols=P), brier_score(df, label, score, P),
             f1_at_threshold(df, threshold, label, score, P)]
    longs = []
    for part in parts:
        name = [c for c in part.columns if c not in P][0]
        longs.append(part.select(*P, F.lit(name).alias("metric"), F.col(name).cast("double").alias("value")))
    base = df.select(*P).distinct() if P else None
    thr = (base.select(*P, F.lit("threshold").alias("metric"), F.lit(float(threshold)).alias("value"))
           if base is not None else df.sparkSession.range(1).select(F.lit("threshold").alias("metric"),
                                                                    F.lit(float(threshold)).alias("value")))
    out = thr
    for x in longs:
        out = out.unionByName(x)
    return out
