"""Queries: uplift evaluation, targeting, drift, promotion gate, model prep.

The experiment table is the period2 population with the seeded 50/50
assignment (M6) and ``observed_retained = 1 - is_churn``; there is no
simulated effect, so Qini ~ 0 is the expected value.  The predicted uplift
used by the oracle-checked queries is closed-form: ``s (1 - s)`` of the
recency churn score ``s``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from keepcurve.functions.exprs import hash_fraction
from keepcurve.operators import cohort as co
from keepcurve.operators import drift as dr
from keepcurve.operators import metrics as me
from keepcurve.operators import prep as pr
from keepcurve.operators import promotion as pm
from keepcurve.operators import uplift as up
from keepcurve.operators.ordered import row_prefix
from keepcurve.plans.catalog_eval import H
from keepcurve.plans.catalog_features import snapshot, snapshots, with_both
from keepcurve.plans.catalog_survival import LIFE_SQL, RECENCY_HALF_LIFE, churn_score, ltv_table
from keepcurve.plans.registry import query
from keepcurve.session import cut_lineage, ensure_checkpoint_dir
from keepcurve.sources.model_registry import ModelRegistry

SEED = co.RANDOM_SEED
HOLDOUT = 0.3
RANDOM_RANK_SEED = 0

# Fixed value: the 42 numeric model features of the original classifier.
NUMERIC_FEATURES = [
    "age", "age_is_valid", "gender_male", "tenure_days", "last_payment_plan_days", "last_plan_list_price",
    "last_actual_amount_paid", "is_auto_renew", "days_since_last_transaction", "membership_expires_in_days",
    "n_transactions_last_7d", "n_transactions_last_30d", "n_transactions_last_90d", "n_transactions_last_180d",
    "n_distinct_plans_last_180d", "n_cancellations_lifetime", "n_transactions_lifetime", "avg_discount_lifetime",
    "total_secs_last_7d", "num_100_last_7d", "num_unq_last_7d", "active_days_last_7d",
    "total_secs_last_30d", "num_100_last_30d", "num_unq_last_30d", "active_days_last_30d",
    "total_secs_last_90d", "num_100_last_90d", "num_unq_last_90d", "active_days_last_90d",
    "total_secs_last_180d", "num_100_last_180d", "num_unq_last_180d", "active_days_last_180d",
    "days_since_last_log", "num_25_lifetime", "num_50_lifetime", "num_75_lifetime", "num_985_lifetime",
    "num_100_lifetime", "completion_ratio", "engagement_momentum",
]
CATEGORICAL_FEATURES = ["city", "registered_via", "last_payment_method_id"]


def experiment(spark, sf_dir):
    """Period2 population with assignment, outcome and closed-form uplift."""
    s = snapshot(spark, sf_dir, "period2")
    e = co.ab_assignment(s, "msno", SEED)
    sc = churn_score()
    return cut_lineage(e.select("msno", "period", "treatment", (1 - F.col("is_churn")).alias("observed_retained"),
                                (sc * (1 - sc)).alias("predicted_uplift")))


def holdout(spark, sf_dir):
    e = co.stratified_split(experiment(spark, sf_dir), "msno", "treatment", HOLDOUT, SEED, names=("train", "test"))
    return e.where(F.col("split") == "test").drop("split")


EXP_SQL = with_both() + f""",
ex AS (SELECT msno, period, CAST({H('msno')} % 2 AS INTEGER) AS treatment, 1 - is_churn AS observed_retained,
              (days_since_last_transaction / (days_since_last_transaction + {RECENCY_HALF_LIFE}))
              * (1 - days_since_last_transaction / (days_since_last_transaction + {RECENCY_HALF_LIFE}))
              AS predicted_uplift FROM snap2),
ho AS (SELECT * EXCLUDE (h, rn, n) FROM (
         SELECT *, row_number() OVER (PARTITION BY treatment ORDER BY h, msno) AS rn,
                count(*) OVER (PARTITION BY treatment) AS n FROM (SELECT *, {H('msno')} AS h FROM ex))
       WHERE rn <= ceil(n * {HOLDOUT}))"""


def qini_sql(src: str, score: str) -> str:
    return f""",
qc AS (SELECT msno, {score} AS score, row_number() OVER w AS rn, count(*) OVER () AS n,
              sum(treatment) OVER w AS ct, sum(1 - treatment) OVER w AS cc,
              sum(observed_retained * treatment) OVER w AS yt, sum(observed_retained * (1 - treatment)) OVER w AS yc
       FROM {src} WINDOW w AS (ORDER BY {score} DESC, msno ROWS UNBOUNDED PRECEDING)),
qq AS (SELECT *, rn / n AS population_fraction, yt - yc * CASE WHEN cc > 0 THEN ct / cc ELSE 0 END AS qini FROM qc),
qa AS (SELECT count(*) AS n, sum(qini) AS s, max_by(qini, rn) AS last, min_by(qini, rn) AS first FROM qq)"""


QCOEF = ("CASE WHEN n > 1 THEN ((s - last * (n + 1) / 2.0) - (first - last / n) / 2.0) / n ELSE 0.0 END")


@query("qini_curve", EXP_SQL + qini_sql("ho", "predicted_uplift") + """
SELECT msno, round(score, 6) AS predicted_uplift, rn, round(population_fraction, 6) AS population_fraction,
       round(qini, 6) AS qini FROM qq""")
def q_qini_curve(spark, sf_dir):
    """X4 + W3 + W4: row-level Qini curve on the 30 % hold-out."""
    return up.qini_curve(holdout(spark, sf_dir), "predicted_uplift", "msno")


THIN_POINTS = 50


@query("qini_curve_thinned", EXP_SQL + qini_sql("ho", "predicted_uplift") + f""",
th AS (SELECT rn, population_fraction AS x, qini AS y, floor((rn - 1) * {THIN_POINTS}::DOUBLE / n) AS step FROM qq),
kp AS (SELECT rn, x, y, step, lead(rn) OVER (ORDER BY rn) AS rn1, lead(x) OVER (ORDER BY rn) AS x1, lead(y) OVER (ORDER BY rn) AS y1
  FROM (SELECT * FROM th QUALIFY row_number() OVER (PARTITION BY step ORDER BY rn) = 1 OR rn = (SELECT max(rn) FROM th))),
er AS (SELECT kp.rn, max(abs(th.y - (kp.y + (th.x - kp.x) / (kp.x1 - kp.x) * (kp.y1 - kp.y)))) AS e FROM kp JOIN th ON th.rn BETWEEN kp.rn AND kp.rn1 GROUP BY kp.rn)
SELECT rn, round(x, 6) AS population_fraction, round(y, 6) AS qini, round(coalesce(e, 0), 6) AS max_error FROM kp LEFT JOIN er USING (rn)""")
def q_qini_curve_thinned(spark, sf_dir):
    """50 evenly spaced points of the Qini curve and how far it strays from the lines between them."""
    curve = cut_lineage(up.qini_curve(holdout(spark, sf_dir), "predicted_uplift", "msno"))
    return up.thin_curve(curve, THIN_POINTS)


@query("qini_coefficient", EXP_SQL + qini_sql("ho", "predicted_uplift") +
       f"\nSELECT round({QCOEF}, 6) AS qini_coefficient, round(last, 6) AS qini_at_full FROM qa")
def q_qini_coefficient(spark, sf_dir):
    """Area between the Qini curve and the diagonal."""
    return up.qini_coefficient(up.qini_curve(holdout(spark, sf_dir), "predicted_uplift", "msno"))


@query("qini_random", EXP_SQL + f""",
hr AS (SELECT *, CAST({H('msno', RANDOM_RANK_SEED)} AS DOUBLE) / 1152921504606846976.0 AS random_score FROM ho)"""
       + qini_sql("hr", "random_score") +
       f"\nSELECT round({QCOEF}, 6) AS qini_coefficient, round(last, 6) AS qini_at_full FROM qa")
def q_qini_random(spark, sf_dir):
    """Qini coefficient of a seeded random ranking (sanity check ~0)."""
    h = up.random_score(holdout(spark, sf_dir), "msno", RANDOM_RANK_SEED)
    return up.qini_coefficient(up.qini_curve(h, "random_score", "msno"))


TARGET_SQL = LIFE_SQL + f""",
ex AS (SELECT msno, period, (days_since_last_transaction / (days_since_last_transaction + {RECENCY_HALF_LIFE}))
              * (1 - days_since_last_transaction / (days_since_last_transaction + {RECENCY_HALF_LIFE}))
              AS predicted_uplift FROM snap2),
tg AS (SELECT e.msno, e.period, e.predicted_uplift, s.ltv, s.churn_probability, s.retention_priority_segment,
              e.predicted_uplift * s.ltv AS expected_value_of_offer
       FROM ex e JOIN seg s USING (msno, period))"""
TARGET_COLS = ["msno", "period", "predicted_uplift", "ltv", "churn_probability", "retention_priority_segment",
               "expected_value_of_offer"]


def targets(spark, sf_dir):
    e = experiment(spark, sf_dir).select("msno", "period", "predicted_uplift")
    lt = ltv_table(spark, sf_dir).select("msno", "period", "ltv", "churn_probability", "retention_priority_segment")
    return up.targeting_list(e, lt).select(*TARGET_COLS)


@query("targeting_list", TARGET_SQL + """
SELECT msno, period, round(predicted_uplift, 6) AS predicted_uplift, round(ltv, 6) AS ltv,
       round(churn_probability, 6) AS churn_probability, retention_priority_segment,
       round(expected_value_of_offer, 6) AS expected_value_of_offer,
       row_number() OVER (ORDER BY expected_value_of_offer DESC, msno, period) AS place FROM tg""")
def q_targeting_list(spark, sf_dir):
    """X7 + J6 + O2: uplift x LTV on (member, period), highest first, with the
    place in that order."""
    t = targets(spark, sf_dir).withColumn("_tie", F.struct("msno", "period"))
    return row_prefix(t, "expected_value_of_offer", "_tie", descending=True, rn_col="place").drop("_tie", "n_total")


@query("targeting_top10", TARGET_SQL + """
SELECT msno, period, round(predicted_uplift, 6) AS predicted_uplift, round(ltv, 6) AS ltv,
       round(churn_probability, 6) AS churn_probability, retention_priority_segment,
       round(expected_value_of_offer, 6) AS expected_value_of_offer
FROM tg ORDER BY expected_value_of_offer DESC, msno, period LIMIT 10""")
def q_targeting_top10(spark, sf_dir):
    """O3: top 10 offer targets."""
    return up.top_targets(targets(spark, sf_dir), 10)


@query("uplift_by_segment", TARGET_SQL + """
SELECT retention_priority_segment, round(avg(predicted_uplift), 6) AS mean_predicted_uplift
FROM tg GROUP BY retention_priority_segment""")
def q_uplift_by_segment(spark, sf_dir):
    """A10: mean predicted uplift per LTV/risk segment."""
    return up.uplift_by_segment(targets(spark, sf_dir))


# ------------------------------------------------------------------- drift

def _drift_sql(features: list[str]) -> str:
    casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in features)
    cols = ", ".join(features)
    names = ", ".join(f"('{c}')" for c in features)
    qs = "[" + ", ".join(repr(i / dr.N_BINS) for i in range(dr.N_BINS + 1)) + "]"
    nb = dr.N_BINS
    return with_both() + f""",
lr AS (UNPIVOT (SELECT {casts} FROM snap1) ON {cols} INTO NAME feature VALUE v),
lc AS (UNPIVOT (SELECT {casts} FROM snap2) ON {cols} INTO NAME feature VALUE v),
e AS (SELECT feature, list_sort(list_distinct(quantile_cont(v, {qs}))) AS q FROM lr GROUP BY feature),
b AS (SELECT feature, 'r' AS side, v FROM lr UNION ALL SELECT feature, 'c' AS side, v FROM lc),
bb AS (SELECT b.feature, b.side,
              CASE WHEN v >= q[1] AND v <= q[len(q)] THEN
                   CASE WHEN v = q[len(q)] THEN len(q) - 2 ELSE len(list_filter(q, lambda x: x <= v)) - 1 END
              END AS bin FROM b JOIN e USING (feature)),
grid AS (SELECT feature, unnest(range(0, greatest(len(q) - 1, 1))) AS bin, len(q) AS ne FROM e),
cnt AS (SELECT g.feature, g.bin, g.ne, count(bb.side) FILTER (WHERE bb.side = 'r') AS r,
               count(bb.side) FILTER (WHERE bb.side = 'c') AS c
        FROM grid g LEFT JOIN bb ON g.feature = bb.feature AND g.bin = bb.bin GROUP BY g.feature, g.bin, g.ne),
tot AS (SELECT feature, sum(r) AS rt, sum(c) AS ct FROM cnt GROUP BY feature),
ps AS (SELECT feature, any_value(ne) AS ne,
              sum(((c + 1) / (ct + {nb}) - (r + 1) / (rt + {nb})) * ln(((c + 1) / (ct + {nb})) / ((r + 1) / (rt + {nb}))))
              AS psi FROM cnt JOIN tot USING (feature) GROUP BY feature),
ns AS (SELECT feature, count(*) FILTER (WHERE side = 'r') AS nr, count(*) FILTER (WHERE side = 'c') AS nc
       FROM b GROUP BY feature),
fl AS (SELECT * FROM (VALUES {names}) t(feature)),
rep AS (SELECT fl.feature, CASE WHEN coalesce(nr, 0) = 0 OR coalesce(nc, 0) = 0 THEN NULL
                               WHEN ne < 3 THEN 0.0 ELSE psi END AS psi
        FROM fl LEFT JOIN ns USING (feature) LEFT JOIN ps USING (feature)),
rs AS (SELECT feature, psi, CASE WHEN psi IS NULL THEN 'no data' WHEN psi > {dr.PSI_SIGNIFICANT_THRESHOLD} THEN 'SIGNIFICANT DRIFT'
                                 WHEN psi > {dr.PSI_MODERATE_THRESHOLD} THEN 'moderate drift' ELSE 'stable' END AS status
       FROM rep)"""


def _drift(spark, sf_dir, features):
    """Both sides from one pass (pooled snapshot pruned to the features,
    materialised once), split by period."""
    pooled = cut_lineage(snapshots(spark, sf_dir).select("period", *features))
    return dr.drift_report(pooled.where(F.col("period") == "period1"), pooled.where(F.col("period") == "period2"),
                           features)


@query("psi", _drift_sql(["days_since_last_transaction"]) + "\nSELECT feature, round(psi, 6) AS psi FROM rs")
def q_psi(spark, sf_dir):
    """PSI of one feature, period1 (reference) -> period2."""
    return _drift(spark, sf_dir, ["days_since_last_transaction"]).select("feature", "psi")


@query("drift_report", _drift_sql(NUMERIC_FEATURES) + """
SELECT feature, round(psi, 6) AS psi, status, CAST(row_number() OVER (ORDER BY psi DESC NULLS LAST, feature) AS INTEGER) AS place FROM rs""")
def q_drift_report(spark, sf_dir):
    """R2 + O1: PSI and status for all 42 numeric features in one job, with
    the place in the report's order (42 rows)."""
    order = Window.orderBy(F.col("psi").desc_nulls_last(), "feature")
    return _drift(spark, sf_dir, NUMERIC_FEATURES).withColumn("place", F.row_number().over(order))


@query("drift_flagged", _drift_sql(NUMERIC_FEATURES) +
       f"\nSELECT feature, round(psi, 6) AS psi, status FROM rs WHERE psi > {dr.PSI_MODERATE_THRESHOLD}")
def q_drift_flagged(spark, sf_dir):
    """Features past the moderate threshold."""
    return dr.flagged(_drift(spark, sf_dir, NUMERIC_FEATURES))


# --------------------------------------------------------------- promotion

def scored_models(spark, sf_dir):
    """OOT (period2) scores of three closed-form 'models' in one table."""
    s = snapshot(spark, sf_dir, "period2")
    rec = churn_score()
    freq = 1.0 / (1.0 + F.col("n_transactions_lifetime"))
    rows = F.array(F.struct(F.lit("recency").alias("model"), F.lit(0).alias("ord"), rec.alias("score")),
                   F.struct(F.lit("frequency").alias("model"), F.lit(1).alias("ord"), freq.alias("score")),
                   F.struct(F.lit("random").alias("model"), F.lit(2).alias("ord"),
                            hash_fraction(F.col("msno"), RANDOM_RANK_SEED).alias("score")))
    return s.select(F.col("is_churn").alias("label"), F.explode(rows).alias("m")).select("label", "m.*")


MODELS_SQL = with_both() + f""",
sm AS (SELECT 'recency' AS model, 0 AS ord, is_churn AS label,
              days_since_last_transaction / (days_since_last_transaction + {RECENCY_HALF_LIFE}) AS score FROM snap2
       UNION ALL SELECT 'frequency', 1, is_churn, 1.0 / (1.0 + n_transactions_lifetime) FROM snap2
       UNION ALL SELECT 'random', 2, is_churn, CAST({H('msno', RANDOM_RANK_SEED)} AS DOUBLE) / 1152921504606846976.0
       FROM snap2),
d AS (SELECT model, ord, score, CAST(sum(label) AS DOUBLE) AS pos, CAST(sum(1 - label) AS DOUBLE) AS neg
      FROM sm GROUP BY model, ord, score),
c AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM d
      WINDOW w AS (PARTITION BY model ORDER BY score DESC ROWS UNBOUNDED PRECEDING)),
ap AS (SELECT model, any_value(ord) AS ord, sum(pos * tp / (tp + fp)) / sum(pos) AS pr_auc FROM c GROUP BY model)"""


def model_ap(spark, sf_dir):
    return cut_lineage(me.average_precision(scored_models(spark, sf_dir), "label", "score", ["model", "ord"]))


@query("select_champion", MODELS_SQL + "\nSELECT model, round(pr_auc, 6) AS value FROM ap ORDER BY pr_auc DESC, ord LIMIT 1")
def q_select_champion(spark, sf_dir):
    """Best model by OOT PR-AUC, the first listed wins ties."""
    ap = model_ap(spark, sf_dir).select("model", "ord", F.lit("pr_auc").alias("metric"),
                                        F.col("pr_auc").alias("value"))
    return pm.select_champion(ap)


@query("promotion_gate", MODELS_SQL + f"""
SELECT 'churn-classifier' AS model, 2 AS candidate_version, round(c.pr_auc, 6) AS candidate_value,
       1 AS champion_version, round(h.pr_auc, 6) AS champion_value,
       c.pr_auc >= h.pr_auc - {pm.PROMOTION_TOLERANCE} AS promoted
FROM ap c, ap h WHERE c.model = 'frequency' AND h.model = 'recency'""")
def q_promotion_gate(spark, sf_dir):
    """G1 + G3: registry (champion = recency model, v1) vs candidate
    (frequency model, v2) on OOT PR-AUC with a 0.005 tolerance."""
    return pm.promotion_gate(*_candidate_and_registry(spark, sf_dir))


def _candidate_and_registry(spark, sf_dir):
    ap = model_ap(spark, sf_dir)

    def logged(name, version, *alias):
        return ap.where(F.col("model") == name).select(
            F.lit("churn-classifier").alias("model"), F.lit(version).alias("version"), *alias,
            F.lit("pr_auc").alias("metric"), F.col("pr_auc").alias("value"))

    return logged("frequency", 2), logged("recency", 1, F.lit("champion").alias("alias"))


@query("promotion_applied", MODELS_SQL + f""",
g AS (SELECT c.pr_auc >= h.pr_auc - {pm.PROMOTION_TOLERANCE} AS promoted, c.pr_auc AS cv, h.pr_auc AS hv
      FROM ap c, ap h WHERE c.model = 'frequency' AND h.model = 'recency')
SELECT 'churn-classifier' AS model, 1 AS version, CASE WHEN promoted THEN NULL ELSE 'champion' END AS alias,
       'pr_auc' AS metric, round(hv, 6) AS value FROM g
UNION ALL SELECT 'churn-classifier', 2, CASE WHEN promoted THEN 'champion' END, 'pr_auc', round(cv, 6) FROM g""")
def q_promotion_applied(spark, sf_dir):
    """The registry table after the gate has been applied."""
    candidate, registry = _candidate_and_registry(spark, sf_dir)
    return pm.apply_gate(registry, candidate)


# -------------------------------------------------------------------- prep

def _unpivot_sql(features, include_nulls=True):
    casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in features)
    inc = " INCLUDE NULLS" if include_nulls else ""
    return f"SELECT * FROM (SELECT {casts} FROM snap1) UNPIVOT{inc} (v FOR feature IN ({', '.join(features)}))"


PREP_SQL = with_both() + f""",
lg AS ({_unpivot_sql(NUMERIC_FEATURES)}),
md AS (SELECT feature, quantile_cont(v, 0.5) AS median FROM lg GROUP BY feature),
st AS (SELECT feature, any_value(median) AS median, avg(coalesce(v, median)) AS mean,
              stddev_pop(coalesce(v, median)) AS std FROM lg JOIN md USING (feature) GROUP BY feature)"""


@query("median_impute", PREP_SQL + "\nSELECT feature, round(median, 6) AS median FROM md")
def q_median_impute(spark, sf_dir):
    """N1 (impute): exact median of every numeric feature, period1."""
    return pr.median_impute_fit(snapshot(spark, sf_dir, "period1"), NUMERIC_FEATURES)


@query("standardize", PREP_SQL + "\nSELECT feature, round(median, 6) AS median, round(mean, 6) AS mean, round(std, 6) AS std FROM st")
def q_standardize(spark, sf_dir):
    """N1 (scale): mean and population std after median fill, period1."""
    return pr.standardize_fit(cut_lineage(snapshot(spark, sf_dir, "period1")), NUMERIC_FEATURES)


@query("class_weights", with_both() + """,
cw AS (SELECT count(*) AS n, count(*) FILTER (WHERE is_churn = 1) AS n_pos FROM snap1)
SELECT 0 AS class, n - n_pos AS n_class, round(CASE WHEN n - n_pos > 0 THEN n / (2.0 * (n - n_pos)) END, 6) AS balanced_weight,
       round((n - n_pos) / greatest(n_pos, 1), 6) AS scale_pos_weight FROM cw
UNION ALL
SELECT 1, n_pos, round(CASE WHEN n_pos > 0 THEN n / (2.0 * n_pos) END, 6), round((n - n_pos) / greatest(n_pos, 1), 6) FROM cw""")
def q_class_weights(spark, sf_dir):
    """Balanced class weights and scale_pos_weight, period1."""
    return pr.class_weights(snapshot(spark, sf_dir, "period1").select(F.col("is_churn").alias("label")), "label")


@query("registry_store", MODELS_SQL + f""",
g AS (SELECT c.pr_auc >= h.pr_auc - {pm.PROMOTION_TOLERANCE} AS promoted, c.pr_auc AS cv, h.pr_auc AS hv
      FROM ap c, ap h WHERE c.model = 'frequency' AND h.model = 'recency')
SELECT 'churn-classifier' AS model, 1 AS version, CASE WHEN promoted THEN NULL ELSE 'champion' END AS alias, 'pr_auc' AS metric, round(hv, 6) AS value FROM g
UNION ALL SELECT 'churn-classifier', 2, CASE WHEN promoted THEN 'champion' END, 'pr_auc', round(cv, 6) FROM g""")
def q_registry_store(spark, sf_dir):
    """G1 + G3: version 1 logged and promoted, version 2 gated against it, in a
    stored registry that is opened and read again."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/registry-{uuid.uuid4().hex}"
    candidate, first = _candidate_and_registry(spark, sf_dir)
    registry = ModelRegistry(spark, path)
    registry.gate(first.drop("alias"))
    registry.gate(candidate)
    return ModelRegistry(spark, path).table()
