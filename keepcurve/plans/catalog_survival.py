"""Queries: survival, Cox preprocessing, Breslow, LTV, segments.

Oracle-checked queries use fixed, documented query parameters where the
original used a fitted model: the partial hazard uses ``DEMO_COEFS`` on the
Cox-preprocessed covariates, and the churn probability is the closed-form
recency score.  The fitted Cox model has its own rows-only query.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from keepcurve.operators import ltv as lt
from keepcurve.operators import survival as sv
from keepcurve.plans.catalog_features import snapshots, with_both
from keepcurve.plans.registry import query
from keepcurve.session import cut_lineage

# Fixed query parameters (not a fitted model): coefficients applied to the
# preprocessed Cox covariates for the oracle-checked hazard queries.
DEMO_COEFS = {
    "is_auto_renew": -0.5,
    "n_cancellations_lifetime": 0.1,
    "last_plan_list_price": -0.05,
    "total_secs_last_90d": 0.05,
    "active_days_last_90d": -0.1,
    "completion_ratio": -0.1,
    "engagement_momentum": 0.05,
    "days_since_last_transaction": 0.2,
    "membership_expires_in_days": -0.1,
}
RECENCY_HALF_LIFE = 180.0


def surv(spark, sf_dir, cols):
    """The columns ``cols`` of the pooled survival frame, materialised once per
    query (stage hand-off, like the snapshot files of the original): later
    stages run several jobs over it.  Sources that none of the columns needs
    are not read."""
    cols = list(cols)
    frame = sv.survival_frame(snapshots(spark, sf_dir).select(*dict.fromkeys([*cols, "tenure_days"])))
    return cut_lineage(frame.select(*cols))


def churn_score(col: str = "days_since_last_transaction"):
    d = F.col(col)
    return d / (d + RECENCY_HALF_LIFE)


SURV_SQL = with_both() + """,
surv AS (SELECT * FROM (SELECT * FROM snap1 UNION ALL SELECT * FROM snap2)
         WHERE tenure_days IS NOT NULL AND tenure_days > 0)"""


KM_COLS = ["tenure_days", "is_churn"]


def km_sql(strata: str | None = None) -> str:
    s = f"{strata}, " if strata else ""
    part = f"PARTITION BY {strata} " if strata else ""
    return f""",
g AS (SELECT {s}tenure_days AS t, count(*) AS n, sum(is_churn) AS ev FROM surv GROUP BY {s}tenure_days),
r AS (SELECT {s}t, CAST(sum(n) OVER ({part}ORDER BY t DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS at_risk,
             CAST(ev AS BIGINT) AS events, CAST(n - ev AS BIGINT) AS censored FROM g),
f AS (SELECT *, 1.0 - events / at_risk AS f,
             CASE WHEN at_risk > events THEN events / (at_risk * (at_risk - events)) END AS gw FROM r),
c AS (SELECT *, sum(CASE WHEN f > 0 THEN ln(f) ELSE 0 END) OVER w AS lf,
             sum(CASE WHEN f <= 0 THEN 1 ELSE 0 END) OVER w AS zc,
             sum(coalesce(gw, 0)) OVER w AS gws, sum(CASE WHEN gw IS NULL THEN 1 ELSE 0 END) OVER w AS gwi
      FROM f WINDOW w AS ({part}ORDER BY t ROWS UNBOUNDED PRECEDING)),
k AS (SELECT {s}t, at_risk, events, censored, CASE WHEN zc > 0 THEN 0.0 ELSE exp(lf) END AS survival,
             CASE WHEN gwi = 0 THEN gws END AS var_sum FROM c),
kk AS (SELECT *, CASE WHEN survival > 0 AND survival < 1 AND var_sum IS NOT NULL THEN 1 ELSE 0 END AS ok,
              ln(CASE WHEN survival > 0 AND survival < 1 THEN survival ELSE 0.5 END) AS v FROM k)"""


KM_SELECT = """SELECT {s}t, at_risk, events, censored, round(survival, 6) AS survival, round(var_sum, 6) AS var_sum,
  round(CASE WHEN ok = 1 THEN exp(-exp(ln(-v) - {z} * sqrt(var_sum) / v)) WHEN survival = 1 THEN 1.0 END, 6) AS ci_lower,
  round(CASE WHEN ok = 1 THEN exp(-exp(ln(-v) + {z} * sqrt(var_sum) / v)) WHEN survival = 1 THEN 1.0 END, 6) AS ci_upper
FROM kk"""


@query("survival_frame", f"{SURV_SQL} SELECT msno, period, tenure_days, is_churn FROM surv")
def q_survival_frame(spark, sf_dir):
    """P14 + U3: pooled periods, positive tenure only."""
    return surv(spark, sf_dir, ["msno", "period", "tenure_days", "is_churn"])


@query("survival_dropped", with_both() + """
SELECT period, count(*) FILTER (WHERE tenure_days > 0) AS n_kept, count(*) FILTER (WHERE tenure_days IS NULL) AS n_null,
       count(*) FILTER (WHERE tenure_days <= 0) AS n_not_positive FROM (SELECT * FROM snap1 UNION ALL SELECT * FROM snap2) GROUP BY period""")
def q_survival_dropped(spark, sf_dir):
    """How many rows the survival frame keeps and drops, per period."""
    return sv.survival_drops(snapshots(spark, sf_dir))


@query("km_curve", SURV_SQL + km_sql() + "\n" + KM_SELECT.format(s="", z=sv.Z_95))
def q_km_curve(spark, sf_dir):
    """K1: Kaplan-Meier curve with Greenwood log(-log) band."""
    return sv.kaplan_meier(surv(spark, sf_dir, KM_COLS), "tenure_days", "is_churn")


@query("km_by_stratum", SURV_SQL + km_sql("is_auto_renew") + "\n" + KM_SELECT.format(s="is_auto_renew, ", z=sv.Z_95))
def q_km_by_stratum(spark, sf_dir):
    """K2 + P15: one curve per auto-renew stratum (empty strata absent)."""
    return sv.kaplan_meier(surv(spark, sf_dir, [*KM_COLS, "is_auto_renew"]), "tenure_days", "is_churn", ["is_auto_renew"])


@query("km_median", SURV_SQL + km_sql() + "\nSELECT min(t) FILTER (WHERE survival <= 0.5) AS median_survival FROM k")
def q_km_median(spark, sf_dir):
    """K3: median survival time (null when never reached)."""
    return sv.median_survival(sv.kaplan_meier(surv(spark, sf_dir, KM_COLS), "tenure_days", "is_churn"))


# ---------------------------------------------------------------- Cox prep

def cox_prep_sql() -> str:
    parts = []
    for c in sv.COX_COVARIATES:
        med = f"(SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) FROM surv)"
        v = f"coalesce(CAST({c} AS DOUBLE), {med})"
        if c == "engagement_momentum":
            v = f"least({v}, {sv.MOMENTUM_CLIP})"
        if c in sv.BINARY_COX_COVARIATES:
            parts.append(f"SELECT '{c}' AS covariate, {med} AS median, CAST(NULL AS DOUBLE) AS mean, "
                         f"CAST(NULL AS DOUBLE) AS std")
        else:
            parts.append(f"SELECT '{c}' AS covariate, {med} AS median, avg(v) AS mean, stddev_samp(v) AS std "
                         f"FROM (SELECT {v} AS v FROM surv)")
    return ",\ncp AS (" + "\nUNION ALL\n".join(parts) + ")"


def theta_sql() -> str:
    terms = []
    for c, b in sv_coefs().items():
        med = f"(SELECT median FROM cp WHERE covariate = '{c}')"
        x = f"coalesce(CAST({c} AS DOUBLE), {med})"
        if c == "engagement_momentum":
            x = f"least({x}, {sv.MOMENTUM_CLIP})"
        if c not in sv.BINARY_COX_COVARIATES:
            x = (f"(({x} - (SELECT mean FROM cp WHERE covariate = '{c}')) / "
                 f"(SELECT std FROM cp WHERE covariate = '{c}'))")
        terms.append(f"{b!r} * ({x} - 0.0)")
    return ",\nph AS (SELECT msno, period, tenure_days, is_churn, days_since_last_transaction, exp(" + \
        " + ".join(terms) + ") AS theta FROM surv)"


def sv_coefs():
    return DEMO_COEFS


PH_SQL = SURV_SQL + cox_prep_sql() + theta_sql()


THETA_KEEP = ["msno", "period", "tenure_days", "is_churn", "last_actual_amount_paid", "last_payment_plan_days"]


def demo_theta(spark, sf_dir):
    s = surv(spark, sf_dir, dict.fromkeys([*THETA_KEEP, *sv.COX_COVARIATES]))
    s = s.withColumn("dslt_raw", F.col("days_since_last_transaction"))
    stats = sv.collect_stats(sv.cox_prep_fit(s))  # 9 rows
    x = sv.cox_prep_transform(s, stats, keep=[*THETA_KEEP, "dslt_raw"])
    return cut_lineage(sv.partial_hazard(x, DEMO_COEFS, out_col="theta"))


@query("cox_preprocess", SURV_SQL + cox_prep_sql() +
       "\nSELECT covariate, round(median, 6) AS median, round(mean, 6) AS mean, round(std, 6) AS std FROM cp")
def q_cox_preprocess(spark, sf_dir):
    """N4 fit: median fill, momentum clip at 5, z-score stats (sample std)."""
    return sv.cox_prep_fit(surv(spark, sf_dir, sv.COX_COVARIATES))


@query("partial_hazard", PH_SQL + "\nSELECT msno, period, round(theta, 6) AS partial_hazard FROM ph")
def q_partial_hazard(spark, sf_dir):
    """K6: exp(beta . x) on preprocessed covariates (fixed beta)."""
    return demo_theta(spark, sf_dir).select("msno", "period", F.col("theta").alias("partial_hazard"))


BRESLOW_SQL = PH_SQL + """,
bg AS (SELECT tenure_days AS t, sum(is_churn) AS events, sum(theta) AS th FROM ph GROUP BY tenure_days),
br AS (SELECT t, events, sum(th) OVER (ORDER BY t DESC ROWS UNBOUNDED PRECEDING) AS risk_sum FROM bg),
bh AS (SELECT *, events / risk_sum AS baseline_hazard FROM br),
bc AS (SELECT *, sum(baseline_hazard) OVER (ORDER BY t ROWS UNBOUNDED PRECEDING) AS cum_hazard FROM bh)"""


@query("breslow_baseline", BRESLOW_SQL + """
SELECT t, CAST(events AS DOUBLE) AS events, round(risk_sum, 10) AS risk_sum,
       round(baseline_hazard, 10) AS baseline_hazard, round(cum_hazard, 10) AS cum_hazard,
       round(exp(-cum_hazard), 10) AS baseline_survival FROM bc""", decimals=10)
def q_breslow_baseline(spark, sf_dir):
    """K7: Breslow baseline hazard / survival over the pooled frame."""
    return sv.breslow_baseline(demo_theta(spark, sf_dir), "tenure_days", "is_churn", "theta")


# --------------------------------------------------------------------- LTV

G = lt.LTV_INTEGRATION_GRID_POINTS
LIFE_SQL = BRESLOW_SQL + f""",
s0 AS (SELECT t, exp(-cum_hazard) AS s0 FROM bc),
hz AS (SELECT max(t) AS H FROM s0),
g0 AS (SELECT ph.msno, ph.period, ph.theta, least(CAST(ph.tenure_days AS DOUBLE), hz.H - {lt.HORIZON_EPS!r}) AS t0c,
              CAST(hz.H AS DOUBLE) AS H, r.i,
              CASE WHEN r.i = {G - 1} THEN 1.0 ELSE r.i * (1.0 / {G - 1}) END AS fr
       FROM ph, hz, range({G}) r(i)),
g1 AS (SELECT *, t0c + (H - t0c) * fr AS u FROM g0),
g2 AS (SELECT g1.*, coalesce(s0.s0, (SELECT s0 FROM s0 ORDER BY t LIMIT 1)) AS sv FROM g1 ASOF LEFT JOIN s0 ON g1.u >= s0.t),
g3 AS (SELECT *, pow(sv, theta) AS si, u - t0c AS x FROM g2),
g4 AS (SELECT *, first_value(si) OVER (PARTITION BY msno, period ORDER BY i) AS si0 FROM g3),
g5 AS (SELECT *, si / (CASE WHEN si0 > {lt.SURVIVAL_FLOOR!r} THEN si0 ELSE {lt.SURVIVAL_FLOOR!r} END) AS cnd FROM g4),
g6 AS (SELECT *, lag(x) OVER w AS xp, lag(cnd) OVER w AS cp2 FROM g5 WINDOW w AS (PARTITION BY msno, period ORDER BY i)),
life AS (SELECT msno, period, greatest(sum((x - xp) * (cnd + cp2) / 2.0), 0) AS expected_remaining_days
         FROM g6 GROUP BY msno, period),
rv AS (SELECT msno, period, CAST(last_actual_amount_paid AS DOUBLE) / nullif(CAST(last_payment_plan_days AS DOUBLE), 0.0) AS r
       FROM surv),
rev AS (SELECT msno, period, coalesce(r, (SELECT quantile_cont(r, 0.5) FROM rv)) AS daily_revenue FROM rv),
lt AS (SELECT s.msno, s.period, s.tenure_days, l.expected_remaining_days, v.daily_revenue,
              l.expected_remaining_days * v.daily_revenue * {lt.ASSUMED_GROSS_MARGIN_RATE} AS ltv,
              s.days_since_last_transaction / (s.days_since_last_transaction + {RECENCY_HALF_LIFE}) AS churn_probability
       FROM surv s JOIN life l USING (msno, period) JOIN rev v USING (msno, period)),
rk AS (SELECT *, (rank() OVER (ORDER BY ltv) + (count(*) OVER (PARTITION BY ltv) - 1) / 2.0) / count(*) OVER () AS vp,
              (rank() OVER (ORDER BY churn_probability) + (count(*) OVER (PARTITION BY churn_probability) - 1) / 2.0)
                / count(*) OVER () AS rp FROM lt),
seg AS (SELECT * EXCLUDE (vp, rp), CASE WHEN vp >= 0.5 AND rp >= 0.5 THEN 'high_value_at_risk'
                                     WHEN vp >= 0.5 THEN 'high_value_stable'
                                     WHEN rp >= 0.5 THEN 'low_value_at_risk' ELSE 'low_value_stable' END
                   AS retention_priority_segment FROM rk)"""

LTV_COLS = ["tenure_days", "expected_remaining_days", "daily_revenue", "ltv", "churn_probability",
            "retention_priority_segment"]


def ltv_table(spark, sf_dir):
    th = demo_theta(spark, sf_dir)
    base = sv.breslow_baseline(th, "tenure_days", "is_churn", "theta")
    d = lt.expected_remaining_life(th, base, "tenure_days", "theta")
    d = lt.daily_revenue(d)
    d = cut_lineage(lt.ltv(d).withColumn("churn_probability", churn_score("dslt_raw")))
    return lt.retention_segments(d).select("msno", "period", *LTV_COLS)


@query("expected_remaining_life", LIFE_SQL +
       "\nSELECT msno, period, round(expected_remaining_days, 6) AS expected_remaining_days FROM life")
def q_expected_remaining_life(spark, sf_dir):
    """L1: truncated conditional remaining lifetime, 100-point trapezoid."""
    th = demo_theta(spark, sf_dir)
    base = sv.breslow_baseline(th, "tenure_days", "is_churn", "theta")
    return lt.expected_remaining_life(th, base, "tenure_days", "theta").select("msno", "period",
                                                                                 "expected_remaining_days")


@query("daily_revenue", LIFE_SQL + "\nSELECT msno, period, round(daily_revenue, 6) AS daily_revenue FROM rev")
def q_daily_revenue(spark, sf_dir):
    """L2: revenue per plan day, median-filled."""
    cols = ["msno", "period", "last_actual_amount_paid", "last_payment_plan_days"]
    return lt.daily_revenue(surv(spark, sf_dir, cols)).select("msno", "period", "daily_revenue")


@query("ltv_table", LIFE_SQL + """
SELECT msno, period, tenure_days, round(expected_remaining_days, 6) AS expected_remaining_days,
       round(daily_revenue, 6) AS daily_revenue, round(ltv, 6) AS ltv, round(churn_probability, 6) AS churn_probability,
       retention_priority_segment FROM seg""")
def q_ltv_table(spark, sf_dir):
    """L3 + S7 columns: LTV = remaining days x daily revenue x margin."""
    return ltv_table(spark, sf_dir)


@query("retention_segments", LIFE_SQL + "\nSELECT msno, period, retention_priority_segment FROM seg")
def q_retention_segments(spark, sf_dir):
    """L4 + W2: quadrants on pooled percentile ranks."""
    return ltv_table(spark, sf_dir).select("msno", "period", "retention_priority_segment")


@query("ltv_segment_summary", LIFE_SQL + """
SELECT retention_priority_segment, count(msno) AS n_members, round(sum(ltv), 2) AS total_ltv,
       round(avg(ltv), 4) AS avg_ltv FROM seg GROUP BY retention_priority_segment""")
def q_ltv_segment_summary(spark, sf_dir):
    """Members, total and mean LTV per segment."""
    s = lt.segment_summary(ltv_table(spark, sf_dir))
    return s.select("retention_priority_segment", "n_members", F.round("total_ltv", 2).alias("total_ltv"),
                    F.round("avg_ltv", 4).alias("avg_ltv"))


@query("ltv_run_metrics", LIFE_SQL + """
SELECT 'median_ltv' AS metric, round(quantile_cont(ltv, 0.5), 4) AS value FROM seg
UNION ALL SELECT 'mean_expected_remaining_days', round(avg(expected_remaining_days), 4) FROM seg
UNION ALL SELECT 'high_value_at_risk_total_ltv',
                 round(sum(ltv) FILTER (WHERE retention_priority_segment = 'high_value_at_risk'), 2) FROM seg""")
def q_ltv_run_metrics(spark, sf_dir):
    """Run-level LTV metrics."""
    m = lt.run_metrics(ltv_table(spark, sf_dir))
    v = (F.when(F.col("metric") == "high_value_at_risk_total_ltv", F.round("value", 2))
          .otherwise(F.round("value", 4)))
    return m.select("metric", v.alias("value"))


@query("concordance_index", PH_SQL + """
SELECT CAST(count(*) FILTER (WHERE a.theta > b.theta) AS BIGINT) AS concordant,
       CAST(count(*) FILTER (WHERE a.theta = b.theta) AS BIGINT) AS tied,
       CAST(count(*) AS BIGINT) AS comparable,
       round((count(*) FILTER (WHERE a.theta > b.theta) + 0.5 * count(*) FILTER (WHERE a.theta = b.theta))
             / count(*), 6) AS concordance_index
FROM ph a JOIN ph b ON a.is_churn = 1 AND (b.tenure_days > a.tenure_days
                                          OR (b.tenure_days = a.tenure_days AND b.is_churn = 0))""")
def q_concordance_index(spark, sf_dir):
    """K8: exact Harrell C of the partial hazard (oracle: brute-force pairs)."""
    from keepcurve.operators.concordance import concordance_index

    return concordance_index(demo_theta(spark, sf_dir), "tenure_days", "is_churn", "theta")
