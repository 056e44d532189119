"""Survival analysis on right-censored (duration, event) rows.

* Kaplan-Meier: events/censorings collapse per distinct duration (partial
  aggregate), the at-risk count is a suffix sum and the survival curve a
  running product, both from the distributed ordered prefix -- no global
  window.  Greenwood variance gives the log(-log) confidence band.
* Breslow baseline: per-duration event counts over the running sum of
  partial hazards of the risk set.
* Cox preprocessing: one aggregate for medians (exact quantiles), one for
  mean / sample std after fill + clip; transform is a projection.
* Spearman: ties-averaged ranks (distributed) + ``corr``.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepcurve.operators.ordered import average_ranks, exact_quantiles, row_prefix, value_prefix

# Fixed values of the original pipeline's survival stage.
COX_COVARIATES = [
    "is_auto_renew",
    "n_cancellations_lifetime",
    "last_plan_list_price",
    "total_secs_last_90d",
    "active_days_last_90d",
    "completion_ratio",
    "engagement_momentum",
    "days_since_last_transaction",
    "membership_expires_in_days",
]
BINARY_COX_COVARIATES = ["is_auto_renew"]
MOMENTUM_CLIP = 5.0
Z_95 = 1.959963984540054


def survival_frame(snapshots: DataFrame, duration: str = "tenure_days") -> DataFrame:
    """P14 + U3: pooled periods, rows with a positive, non-null duration."""
    return snapshots.where(F.col(duration).isNotNull() & (F.col(duration) > 0))


def survival_drops(snapshots: DataFrame, duration: str = "tenure_days", partition_cols: Sequence[str] = ("period",)) -> DataFrame:
    """Rows kept, and rows that ``survival_frame`` drops because the
    duration is null or not positive, per group."""
    d = F.col(duration)
    return snapshots.groupBy(*partition_cols).agg(F.count_if(d > 0).alias("n_kept"), F.count_if(d.isNull()).alias("n_null"),
                                                  F.count_if(d <= 0).alias("n_not_positive"))


def kaplan_meier(df: DataFrame, duration: str = "tenure_days", event: str = "is_churn",
                 partition_cols: Sequence[str] = (), z: float = Z_95) -> DataFrame:
    """K1/K2: product-limit curve at every distinct duration (per stratum).

    Output: groups, ``t, at_risk, events, censored, survival, var_sum,
    ci_lower, ci_upper``.  Empty strata produce no rows (P15).
    """
    P = list(partition_cols)
    ev = F.col(event).cast("long")
    vp = value_prefix(df, duration, {"events": ev, "censored": 1 - ev}, P)
    at_risk = F.col("n_total") - F.col("n_before")
    step = vp.select(*P, F.col(duration).alias("t"), at_risk.alias("at_risk"), "events", "censored")
    f = 1.0 - F.col("events") / F.col("at_risk")
    gw = F.when(F.col("at_risk") > F.col("events"),
                F.col("events") / (F.col("at_risk") * (F.col("at_risk") - F.col("events"))))
    step = step.withColumn("_lf", F.when(f > 0, F.ln(f)).otherwise(F.lit(0.0))) \
               .withColumn("_z", F.when(f <= 0, 1).otherwise(0)) \
               .withColumn("_gw", F.coalesce(gw, F.lit(0.0))) \
               .withColumn("_gwinf", F.when(gw.isNull(), 1).otherwise(0))
    cum = row_prefix(step, "t", None, {"lf": F.col("_lf"), "z": F.col("_z"), "gw": F.col("_gw"),
                                        "gwinf": F.col("_gwinf")}, P, rn_col="_rn", n_col="_nn")
    s = F.when(F.col("cum_z") > 0, F.lit(0.0)).otherwise(F.exp(F.col("cum_lf")))
    out = cum.select(*P, "t", "at_risk", "events", "censored", s.alias("survival"),
                     F.when(F.col("cum_gwinf") == 0, F.col("cum_gw")).alias("var_sum"))
    v = F.ln(F.col("survival"))
    ok = (F.col("survival") > 0) & (F.col("survival") < 1) & F.col("var_sum").isNotNull()
    half = F.lit(z) * F.sqrt(F.col("var_sum")) / v
    lower = F.exp(-F.exp(F.ln(-v) - half))
    upper = F.exp(-F.exp(F.ln(-v) + half))
    return out.select("*", F.when(ok, lower).when(F.col("survival") == 1, 1.0).alias("ci_lower"),
                      F.when(ok, upper).when(F.col("survival") == 1, 1.0).alias("ci_upper"))


def median_survival(km: DataFrame, partition_cols: Sequence[str] = ()) -> DataFrame:
    """K3: first t with S(t) <= 0.5; null when the curve never gets there."""
    return km.groupBy(*partition_cols).agg(
        F.min(F.when(F.col("survival") <= 0.5, F.col("t"))).alias("median_survival"))


# ------------------------------------------------------------------ Cox prep

def cox_prep_fit(df: DataFrame, covariates: Sequence[str] = COX_COVARIATES,
                 binary: Sequence[str] = BINARY_COX_COVARIATES, clip: Mapping[str, float] | None = None) -> DataFrame:
    """N4 fit: per covariate ``median`` (exact, linear interpolation), then
    mean and sample std of the filled + clipped column.

    Returns a long table ``covariate, median, mean, std`` (std/mean null for
    binary covariates, which stay unscaled).
    """
    clip = {"engagement_momentum": MOMENTUM_CLIP} if clip is None else dict(clip)
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("covariate"),
                                                  F.col(c).cast("double").alias("value"))
                                         for c in covariates])).alias("kv")).select("kv.*")
    # one number per covariate; a covariate without values has no row
    medians = {r["covariate"]: r["value"] for r in exact_quantiles(long, "value", [0.5], ["covariate"]).collect()}
    rows = []
    for c in [c for c in covariates if c in medians]:
        v = F.coalesce(F.col(c).cast("double"), F.lit(medians[c]))
        if c in clip:
            v = F.least(v, F.lit(clip[c]))
        scaled = [F.lit(None).cast("double")] * 2 if c in binary else [F.avg(v), F.stddev_samp(v)]
        rows.append(F.struct(F.lit(c).alias("covariate"), F.lit(medians[c]).cast("double").alias("median"),
                             scaled[0].alias("mean"), scaled[1].alias("std")))
    if not rows:
        return df.sparkSession.createDataFrame([], "covariate string, median double, mean double, std double")
    return df.agg(F.array(*rows).alias("_rows")).select(F.explode("_rows").alias("_row")).select("_row.*")


def cox_prep_transform(df: DataFrame, stats: Mapping[str, tuple], clip: Mapping[str, float] | None = None,
                       keep: Sequence[str] = ()) -> DataFrame:
    """N4 transform: fill with the fitted medians, clip, z-score continuous
    covariates.  ``stats`` maps covariate -> (median, mean, std) (a few
    numbers collected from :func:`cox_prep_fit`)."""
    clip = {"engagement_momentum": MOMENTUM_CLIP} if clip is None else dict(clip)
    cols = []
    for c, (median, mean, std) in stats.items():
        x = F.coalesce(F.col(c).cast("double"), F.lit(float(median)))
        if c in clip:
            x = F.least(x, F.lit(float(clip[c])))
        if mean is not None:
            x = (x - F.lit(float(mean))) / F.lit(float(std)) if std else x - F.lit(float(mean))
        cols.append(x.alias(c))
    return df.select(*keep, *cols)


def collect_stats(stats_df: DataFrame) -> dict[str, tuple]:
    """Bounded collect: one row per covariate."""
    return {r["covariate"]: (r["median"], r["mean"], r["std"]) for r in stats_df.collect()}


def linear_predictor(coefs: Mapping[str, float], means: Mapping[str, float] | None = None) -> Column:
    """beta . (x - mean) as a Spark expression (means default to 0)."""
    means = means or {}
    terms = [F.lit(float(b)) * (F.col(c) - F.lit(float(means.get(c, 0.0)))) for c, b in coefs.items()]
    return sum(terms[1:], terms[0]) if terms else F.lit(0.0)


def partial_hazard(df: DataFrame, coefs: Mapping[str, float], means: Mapping[str, float] | None = None,
                   out_col: str = "partial_hazard") -> DataFrame:
    """K6: ``exp(beta . (x - mean))``."""
    return df.withColumn(out_col, F.exp(linear_predictor(coefs, means)))


def breslow_baseline(df: DataFrame, duration: str, event: str, theta: str,
                     partition_cols: Sequence[str] = ()) -> DataFrame:
    """K7: Breslow baseline hazard and survival at each distinct duration.

    ``h0(t) = d(t) / sum_{T_j >= t} theta_j``; ``H0`` is its running sum and
    ``S0 = exp(-H0)``.  Output: ``t, events, risk_sum, baseline_hazard,
    cum_hazard, baseline_survival``.
    """
    P = list(partition_cols)
    vp = value_prefix(df, duration, {"events": F.col(event).cast("double"), "th": F.col(theta)}, P)
    risk = F.col("tot_th") - F.col("th_before")
    step = vp.select(*P, F.col(duration).alias("t"), "events", risk.alias("risk_sum")) \
             .withColumn("baseline_hazard", F.col("events") / F.col("risk_sum"))
    cum = row_prefix(step, "t", None, {"h": F.col("baseline_hazard")}, P, rn_col="_rn", n_col="_nn")
    return cum.select(*P, "t", "events", "risk_sum", "baseline_hazard", F.col("cum_h").alias("cum_hazard"),
                      F.exp(-F.col("cum_h")).alias("baseline_survival"))


def spearman(df: DataFrame, a: str, b: str, partition_cols: Sequence[str] = ()) -> DataFrame:
    """K9: Spearman rho = Pearson correlation of ties-averaged ranks.

    Rows with a null in either column are dropped first.
    """
    P = list(partition_cols)
    d = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    r = average_ranks(average_ranks(d, a, "_ra", None, P), b, "_rb", None, P)
    return r.groupBy(*P).agg(F.corr("_ra", "_rb").alias("spearman"))
