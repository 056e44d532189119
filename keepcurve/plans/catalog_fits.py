"""Queries of fitted models that SQL fits again from the same tables.

Small models (two to six columns, a few trees), so that the SQL can do every
step of the fit: boosting rounds, Newton steps, the max-min formula of
isotonic regression.  The operators are those of the full-size queries.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from keepcurve.functions.exprs import hash_u64
from keepcurve.operators import boosting as bo
from keepcurve.operators import cohort as co
from keepcurve.operators import cox
from keepcurve.operators import features as fe
from keepcurve.operators import isotonic as iso
from keepcurve.operators import metrics as me
from keepcurve.operators import models as mo
from keepcurve.operators import promotion as pm
from keepcurve.operators import survival as sv
from keepcurve.operators.concordance import concordance_index
from keepcurve.operators.ordered import row_prefix
from keepcurve.plans.catalog_eval import SCORED_SQL, H, _split_sql, scored
from keepcurve.plans.catalog_features import transactions, with_both
from keepcurve.plans.fit_sql import auc_sql, boost_ctes, boost_levels_ctes, cox_ctes, isotonic_ctes, logistic_ctes, pr_auc_sql
from keepcurve.plans.registry import query
from keepcurve.session import cut_lineage
from keepcurve.sources import testdata as td

SEED, HOLDOUT = co.RANDOM_SEED, 0.3
# Columns of the small models and their cut points.
CUTS = {
    "days_since_last_transaction": [30, 60, 120, 240, 400],
    "n_transactions_lifetime": [2, 4, 6, 8, 10, 14],
    "tenure_days": [400, 800, 1200, 1500],
    "age": [20, 30, 45, 60, 75],
    "gender_male": [0],
    "last_payment_plan_days": [30, 60, 90],
}
BOOST = bo.BoostParams(trees=2, depth=2, rate=0.3, rows=1.0, columns=1.0)
# The original's 300 trees of depth 5; every tree sees all rows and columns, as SQL has not the operator's draws.
IN_SAMPLE = bo.BoostParams(rows=1.0, columns=1.0)
UPLIFT = bo.BoostParams(trees=2, depth=2, rate=0.5, rows=1.0, columns=1.0, loss="squared")
LOGIT = ["days_since_last_transaction", "n_transactions_lifetime"]
COX = ["days_since_last_transaction", "n_cancellations_lifetime"]
F_SQL = ", ".join(CUTS)


def _period(spark, sf_dir, period):
    """Labels, member and transaction features of one period (no logs)."""
    cutoff, lab = td.CUTOFFS[period], td.labels(spark, sf_dir, period)
    return (lab.join(fe.member_features(td.members(spark, sf_dir), cutoff), "msno", "left")
            .join(fe.transaction_features(transactions(spark, sf_dir, period), cutoff), "msno", "left")
            .withColumns({"label": F.col("is_churn"), "period": F.lit(period)}))


def _both(spark, sf_dir):
    """Period1 with its validation split, and period2."""
    p1 = co.stratified_split(_period(spark, sf_dir, "period1"), "msno", "label", 0.2, SEED)
    return cut_lineage(p1), cut_lineage(_period(spark, sf_dir, "period2"))


BOTH_SQL = f"""{with_both()},
p1 AS MATERIALIZED ({_split_sql("(SELECT *, is_churn AS label FROM snap1)", 'label', 0.2)}),
p2 AS MATERIALIZED (SELECT *, is_churn AS label FROM snap2)"""


def _weighted(name: str, src: str, where: str = "true") -> str:
    """Rows of ``src`` with the positives' weight neg / max(pos, 1)."""
    return f"""{name} AS MATERIALIZED (SELECT *, CASE WHEN label = 1 THEN (SELECT count(*) FILTER (WHERE label = 0)::DOUBLE
  / greatest(count(*) FILTER (WHERE label = 1), 1) FROM {src} WHERE {where}) ELSE 1.0 END AS w FROM {src} WHERE {where})"""


def _rows(name: str, train: str, others: dict[str, str]) -> str:
    parts = [f"SELECT 'fit' AS part, msno, period, label AS y, w, true AS fit, {F_SQL} FROM {train}"]
    parts += [f"SELECT '{part}', msno, period, label, 1.0, false, {F_SQL} FROM {src}" for part, src in others.items()]
    return f"{name} AS MATERIALIZED (" + " UNION ALL ".join(parts) + ")"


def _boosted_sql(p: str, train: str, others: dict[str, str]) -> str:
    return _rows(p + "_rows", train, others) + ",\n" + boost_ctes(p, p + "_rows", CUTS, BOOST.trees, BOOST.depth, BOOST.rate)


CHURN_SQL = f"""{BOTH_SQL}, {_weighted('tr', 'p1', "split = 'train'")},
{_boosted_sql('bm', 'tr', {'valid': "(SELECT * FROM p1 WHERE split = 'valid')", 'oot': 'p2'})},
sc AS MATERIALIZED (SELECT part, msno, period, y AS label, round(1 / (1 + exp(-m_)), 9) AS score FROM bm)"""


def _churn_model(p1):
    train = mo.scale_pos_weight_col(p1.where("split = 'train'"), "label", "w")
    return bo.fit_boosted(train, list(CUTS), "label", "msno", weight_col="w", params=BOOST, cuts=CUTS)


def _score(model, df, keep=("msno", "label")):
    return cut_lineage(model.score(df, list(keep)).withColumn("score", F.round("score", 9)))


@query("model_matrix", f"""{with_both()}
SELECT msno, is_churn AS label, {', '.join(f"coalesce(CAST({c} AS DOUBLE), (SELECT min({c}) - 1.0 FROM snap1)) AS v_{c}, CAST({c} IS NULL AS INTEGER) AS missing_{c}"
                                           for c in CUTS)} FROM snap1""")
def q_model_matrix(spark, sf_dir):
    """The model matrix of the tree models: filled values and missing flags."""
    s, cols = _period(spark, sf_dir, "period1"), list(CUTS)
    x = mo.tree_features(s, mo.missing_fills(s, cols), cols, [], ["msno", "label"]).withColumn("f", vector_to_array("features"))
    n = len(cols)
    return x.select("msno", "label", *[F.col("f")[k].alias(f"v_{c}") for k, c in enumerate(cols)],
                    *[F.col("f")[n + k].cast("int").alias(f"missing_{c}") for k, c in enumerate(cols)])


LOGIT_SQL = f"""{BOTH_SQL},
st AS (SELECT {', '.join(f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS q{k}" for k, c in enumerate(LOGIT))} FROM p1 WHERE split = 'train'),
sm AS (SELECT {', '.join(f"avg(coalesce({c}, q{k})) AS m{k}, stddev_pop(coalesce({c}, q{k})) AS d{k}" for k, c in enumerate(LOGIT))}
       FROM p1, st WHERE split = 'train'),
cw AS (SELECT label, count(*) AS nc, sum(count(*)) OVER () AS n FROM p1 WHERE split = 'train' GROUP BY label),
lr AS MATERIALIZED (SELECT label AS y, n / (2.0 * nc) AS w, (coalesce({LOGIT[0]}, q0) - m0) / d0 AS x1, (coalesce({LOGIT[1]}, q1) - m1) / d1 AS x2
  FROM p1 JOIN cw USING (label), st, sm WHERE split = 'train'),
{logistic_ctes('lm', 'lr')}"""


@query("logreg_fit", f"""{LOGIT_SQL}
SELECT 'intercept' AS term, round(b0, 4) AS coef FROM lm UNION ALL SELECT '{LOGIT[0]}', round(b1, 4) FROM lm UNION ALL SELECT '{LOGIT[1]}', round(b2, 4) FROM lm""",
       decimals=4)
def q_logreg_fit(spark, sf_dir):
    """Class-weighted penalised logistic regression on the training side."""
    p1, _ = _both(spark, sf_dir)
    lr = mo.fit_logreg(p1.where("split = 'train'"), LOGIT, [], "label", tol=1e-14)
    fitted = lr.model.stages[-1]
    rows = [("intercept", float(fitted.intercept)), *zip(LOGIT, map(float, fitted.coefficients))]
    return spark.createDataFrame(rows, "term string, coef double")


@query("logreg_scores", f"""{LOGIT_SQL}
SELECT label, count(*) AS n, round(avg(q), 4) AS mean_score, round(min(q), 4) AS least, round(max(q), 4) AS most FROM (
  SELECT label, 1 / (1 + exp(-(b0 + b1 * (coalesce({LOGIT[0]}, q0) - m0) / d0 + b2 * (coalesce({LOGIT[1]}, q1) - m1) / d1))) AS q FROM p2, st, sm, lm) GROUP BY label""",
       decimals=4)
def q_logreg_scores(spark, sf_dir):
    """C4: out-of-time probabilities of the logistic regression, by label."""
    p1, p2 = _both(spark, sf_dir)
    s = mo.fit_logreg(p1.where("split = 'train'"), LOGIT, [], "label", tol=1e-14).score(p2, ["label"])
    return s.groupBy("label").agg(F.count("*").alias("n"), F.avg("score").alias("mean_score"), F.min("score").alias("least"), F.max("score").alias("most"))


@query("boosted_scores", f"{CHURN_SQL}\nSELECT msno, label, round(score, 6) AS score FROM sc WHERE part = 'oot'")
def q_boosted_scores(spark, sf_dir):
    """C2 + C4: boosted trees on period1's training side, scores out of time."""
    p1, p2 = _both(spark, sf_dir)
    return _score(_churn_model(p1), p2)


@query("isotonic_calibration", f"{SCORED_SQL},\n{isotonic_ctes('iso', 'scored')}\nSELECT round(score, 6) AS score, round(calibrated, 6) AS calibrated FROM iso")
def q_isotonic_calibration(spark, sf_dir):
    """Isotonic regression of the label on the recency score."""
    s = cut_lineage(scored(spark, sf_dir))
    return iso.calibrate_blocks(iso.fit_isotonic_blocks(s), s.select("score").distinct(), out_col="calibrated")


@query("isotonic_boosted", f"""{CHURN_SQL}, va AS MATERIALIZED (SELECT * FROM sc WHERE part = 'valid'),
{isotonic_ctes('iso', 'va')},
kn AS MATERIALIZED (SELECT score AS s, calibrated AS v FROM iso),
ca AS (SELECT o.msno, o.score, a.s AS s0, a.v AS v0, b.s AS s1, b.v AS v1 FROM (SELECT * FROM sc WHERE part = 'oot') o
  ASOF LEFT JOIN kn a ON o.score >= a.s ASOF LEFT JOIN kn b ON o.score <= b.s)
SELECT msno, round(CASE WHEN s0 IS NULL THEN v1 WHEN s1 IS NULL OR s0 = s1 THEN v0 ELSE v0 + (score - s0) / (s1 - s0) * (v1 - v0) END, 6) AS score FROM ca""")
def q_isotonic_boosted(spark, sf_dir):
    """Boosted trees, calibrated on the validation side, scored out of time."""
    p1, p2 = _both(spark, sf_dir)
    model = _churn_model(p1)
    blocks = iso.fit_isotonic_blocks(_score(model, p1.where("split = 'valid'")))
    return iso.calibrate_blocks(blocks, _score(model, p2)).select("msno", "score")


POOL_SQL = """{base},
surv AS MATERIALIZED (SELECT *, is_churn AS label FROM (SELECT * FROM snap1 UNION ALL SELECT * FROM snap2) WHERE tenure_days IS NOT NULL AND tenure_days > 0),
cs AS (SELECT {medians} FROM surv), cd AS (SELECT {stats} FROM surv, cs),
cx AS MATERIALIZED (SELECT msno, period, tenure_days AS t, is_churn AS e, {xs} FROM surv, cs, cd)""".format(
    base=with_both(),
    medians=", ".join(f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS q{k}" for k, c in enumerate(COX, 1)),
    stats=", ".join(f"avg(coalesce({c}, q{k})) AS m{k}, stddev_samp(coalesce({c}, q{k})) AS d{k}" for k, c in enumerate(COX, 1)),
    xs=", ".join(f"(coalesce({c}, q{k}) - m{k}) / d{k} AS x{k}" for k, c in enumerate(COX, 1)))
COX_SQL = POOL_SQL + ",\n" + cox_ctes("cf", "cx", cox.PENALIZER)


def _pooled(spark, sf_dir):
    return cut_lineage(sv.survival_frame(co.pooled([_period(spark, sf_dir, p) for p in td.CUTOFFS])))


def _cox(pooled):
    stats = sv.collect_stats(sv.cox_prep_fit(pooled, COX, binary=(), clip={}))
    x = cut_lineage(sv.cox_prep_transform(pooled, stats, clip={}, keep=["msno", "period", "tenure_days", "is_churn"]))
    return x, cox.cox_fit(x, "tenure_days", "is_churn", COX, penalizer=cox.PENALIZER)


@query("cox_fit_two", COX_SQL + "\n" + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS covariate, round(b{k}, 6) AS coef, round(exp(b{k}), 6) AS exp_coef, round(s{k}, 6) AS se_coef, round(b{k} / s{k}, 6) AS z,
       round(b{k} - {cox.Z_95} * s{k}, 6) AS coef_lower_95, round(b{k} + {cox.Z_95} * s{k}, 6) AS coef_upper_95 FROM cf""" for k, c in enumerate(COX, 1)))
def q_cox_fit_two(spark, sf_dir):
    """K4 + K5: Cox fit on two covariates and its summary."""
    _, fit = _cox(_pooled(spark, sf_dir))
    return cox.cox_summary(spark, fit).drop("p")


@query("boosted_vs_cox", f"""{COX_SQL.replace('WITH', 'WITH RECURSIVE', 1)}, {_weighted('tr', 'surv')},
{_rows('bm_rows', 'tr', {})},
{boost_levels_ctes('bm', 'bm_rows', CUTS, IN_SAMPLE.trees, IN_SAMPLE.depth, IN_SAMPLE.rate)},
j AS MATERIALIZED (SELECT b.msno, b.period, b.y AS label, round(1 / (1 + exp(-m_)), 9) AS score, round(exp(b1 * x1 + b2 * x2), 9) AS risk, t, e
  FROM bm b JOIN cx USING (msno, period), cf),
r AS (SELECT rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS ra,
             rank() OVER (ORDER BY risk) + (count(*) OVER (PARTITION BY risk) - 1) / 2.0 AS rb FROM j),
pr AS (SELECT CASE WHEN a.risk > b.risk THEN 1.0 WHEN a.risk = b.risk THEN 0.5 ELSE 0.0 END AS ok FROM j a JOIN j b ON a.e = 1 AND (b.t > a.t OR (b.t = a.t AND b.e = 0)))
SELECT 'spearman_corr_clf_vs_cox_risk' AS metric, round(corr(ra, rb), 6) AS value FROM r
UNION ALL SELECT 'cox_concordance_index', round(avg(ok), 6) FROM pr
UNION ALL SELECT 'classifier_in_sample_roc_auc', round({auc_sql('j')}, 6)""")
def q_boosted_vs_cox(spark, sf_dir):
    """Cox risk against the in-sample boosted classifier, all its trees, on the pooled frame."""
    pooled = _pooled(spark, sf_dir)
    x, fit = _cox(pooled)
    risk = sv.partial_hazard(x, dict(zip(fit["covariates"], fit["coef"])), None, "risk").withColumn("risk", F.round("risk", 9))
    lab = mo.scale_pos_weight_col(pooled, "label", "w")
    model = bo.fit_boosted(lab, list(CUTS), "label", "msno", weight_col="w", params=IN_SAMPLE, cuts=CUTS)
    j = _score(model, lab, ("msno", "period", "label")).join(risk.select("msno", "period", "tenure_days", "is_churn", "risk"), ["msno", "period"])
    j = cut_lineage(j)
    parts = [("spearman_corr_clf_vs_cox_risk", sv.spearman(j, "score", "risk"), "spearman"),
             ("cox_concordance_index", concordance_index(j, "tenure_days", "is_churn", "risk"), "concordance_index"),
             ("classifier_in_sample_roc_auc", me.roc_auc(j, "label", "score"), "roc_auc")]
    rows = [df.select(F.lit(name).alias("metric"), F.col(c).alias("value")) for name, df, c in parts]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


NAIVE_SQL = f"""{CHURN_SQL},
po AS MATERIALIZED (SELECT *, msno || '|' || period AS rk FROM (SELECT * EXCLUDE (split) FROM p1 UNION ALL BY NAME SELECT * FROM p2)),
ps AS MATERIALIZED ({_split_sql('po', 'label', 0.2, ('train', 'test'), 'rk')}),
pt AS MATERIALIZED (SELECT * EXCLUDE (trn) FROM (SELECT *, row_number() OVER (ORDER BY {H('rk', SEED + 1)}, rk) AS trn FROM ps WHERE split = 'train')
  WHERE trn <= (SELECT count(*) FROM p1 WHERE split = 'train')), {_weighted('nt', 'pt')},
{_boosted_sql('nm', 'nt', {'test': "(SELECT * FROM ps WHERE split = 'test')"})},
ns AS MATERIALIZED (SELECT part, y AS label, round(1 / (1 + exp(-m_)), 9) AS score FROM nm WHERE part = 'test'),
os AS MATERIALIZED (SELECT * FROM sc WHERE part = 'oot')"""


@query("oot_vs_naive_boosted", f"""{NAIVE_SQL}
SELECT 'oot_time_split' AS evaluation, round({auc_sql('os')}, 6) AS roc_auc UNION ALL SELECT 'naive_random_split', round({auc_sql('ns')}, 6)""")
def q_oot_vs_naive_boosted(spark, sf_dir):
    """E10 + M4: one booster on a time split and on a pooled random split whose
    training side is cut to the same size."""
    p1, p2 = _both(spark, sf_dir)
    oot = _score(_churn_model(p1), p2)
    pooled = co.pooled([p1.drop("split"), p2]).withColumn("rk", F.concat_ws("|", F.col("msno").cast("string"), "period"))
    split = cut_lineage(co.stratified_split(pooled, "rk", "label", 0.2, SEED, names=("train", "test")))
    size = p1.where("split = 'train'").count()
    train = row_prefix(split.where("split = 'train'").withColumn("_h", hash_u64(F.col("rk"), SEED + 1)), "_h", "rk", rn_col="_trn", n_col="_tn")
    train = mo.scale_pos_weight_col(cut_lineage(train.where(F.col("_trn") <= size)), "label", "w")
    naive = bo.fit_boosted(train, list(CUTS), "label", "rk", weight_col="w", params=BOOST, cuts=CUTS)
    sides = {"oot_time_split": oot, "naive_random_split": _score(naive, split.where("split = 'test'"))}
    a, b = [me.roc_auc(s, "label", "score").select(F.lit(name).alias("evaluation"), "roc_auc") for name, s in sides.items()]
    return a.unionByName(b)


ARM_SQL = [f"""a{arm}_rows AS MATERIALIZED (SELECT msno, is_train, y, 1.0 AS w, is_train AND treatment = {arm} AS fit, {F_SQL} FROM ex),
{boost_ctes(f'a{arm}', f'a{arm}_rows', CUTS, UPLIFT.trees, UPLIFT.depth, UPLIFT.rate, 'squared')}""" for arm in (1, 0)]
EFFECT_SQL = f"""{with_both()},
ab AS (SELECT *, CAST({H('msno')} % 2 AS INTEGER) AS treatment, 1 - is_churn AS y FROM snap2),
ex AS MATERIALIZED (SELECT *, split = 'train' AS is_train FROM ({_split_sql('ab', 'treatment', HOLDOUT, ('train', 'test'))})),
{ARM_SQL[0]},
{ARM_SQL[1]}
SELECT a1.msno, round(a1.m_ - a0.m_, 6) AS predicted_uplift FROM a1 JOIN a0 USING (msno) WHERE NOT a1.is_train"""


@query("uplift_boosted", EFFECT_SQL)
def q_uplift_boosted(spark, sf_dir):
    """X2 + X3: one boosted regressor per arm, effects on the hold-out."""
    e = co.ab_assignment(_period(spark, sf_dir, "period2"), "msno", SEED).withColumn("y", 1 - F.col("is_churn"))
    e = cut_lineage(co.stratified_split(e, "msno", "treatment", HOLDOUT, SEED, names=("train", "test")))
    learner = bo.fit_boosted_learner(e.where("split = 'train'"), list(CUTS), "treatment", "y", "msno", UPLIFT, CUTS)
    return learner.effect(e.where("split = 'test'"), ["msno"])


@query("retrain_gate_boosted", f"""{CHURN_SQL}, os AS MATERIALIZED (SELECT * FROM sc WHERE part = 'oot'),
ch AS MATERIALIZED (SELECT label, days_since_last_transaction / (days_since_last_transaction + 180.0) AS score FROM p2),
v AS (SELECT {pr_auc_sql('os')} AS cand, {pr_auc_sql('ch')} AS champ)
SELECT 'churn-classifier' AS model, 2 AS candidate_version, round(cand, 6) AS candidate_value, 1 AS champion_version, round(champ, 6) AS champion_value,
       cand >= champ - {pm.PROMOTION_TOLERANCE} AS promoted FROM v""")
def q_retrain_gate_boosted(spark, sf_dir):
    """G2 + G3: a boosted candidate, evaluated out of time, against the recency champion."""
    p1, p2 = _both(spark, sf_dir)
    candidate = me.metric_table(_score(_churn_model(p1), p2), 0.5, "label", "score").select(
        F.lit("churn-classifier").alias("model"), F.lit(2).alias("version"), "metric", "value")
    d = F.col("days_since_last_transaction")
    champion = me.metric_table(cut_lineage(p2.select("label", (d / (d + 180.0)).alias("score"))), 0.5, "label", "score").select(
        F.lit("churn-classifier").alias("model"), F.lit(1).alias("version"), F.lit("champion").alias("alias"), "metric", "value")
    return pm.promotion_gate(candidate, champion)
