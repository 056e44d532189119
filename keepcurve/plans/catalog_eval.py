"""Queries: cohorts, sampling, splits and evaluation metrics.

The scored table for metric queries is closed-form (never a fitted model):
score = days_since_last_transaction / (days_since_last_transaction + 180)
for every labelled member of a period, label = is_churn.  Integer days give
many tied scores, which exercises the tie handling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keepcurve.operators import cohort as co
from keepcurve.operators import features as fe
from keepcurve.operators import metrics as me
from keepcurve.operators import ordered as od
from keepcurve.plans.catalog_features import C1, C2, transactions, with_period
from keepcurve.plans.oracle_sql import tx_asof_sql, tx_latest_sql, tx_window_sql
from keepcurve.plans.registry import query
from keepcurve.sources import testdata as td

SEED = co.RANDOM_SEED
THRESHOLD = 0.5


def H(key: str, seed: int = SEED) -> str:
    """SQL twin of ``hash_u64``."""
    return f"CAST(('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 15)) AS BIGINT)"


def scored(spark: SparkSession, sf_dir: str, period: str = "period2") -> DataFrame:
    cutoff = td.CUTOFFS[period]
    lab = td.labels(spark, sf_dir, period)
    lt = fe.latest_transaction(transactions(spark, sf_dir, period), cutoff, cohort=lab)
    d = F.col("days_since_last_transaction")
    return lab.join(lt, "msno").select("msno", F.col("is_churn").alias("label"), (d / (d + 180.0)).alias("score"))


SCORED_SQL = f"""{with_period('period2')}, tx_asof AS ({tx_asof_sql(C2)}), tx_latest AS ({tx_latest_sql(C2)}),
scored AS (SELECT l.msno, l.is_churn AS label,
                  t.days_since_last_transaction / (t.days_since_last_transaction + 180.0) AS score
           FROM labels_p l JOIN tx_latest t USING (msno))"""

DIST_SQL = """, d AS (SELECT score, CAST(sum(label) AS DOUBLE) AS pos, CAST(sum(1 - label) AS DOUBLE) AS neg
           FROM scored GROUP BY score)"""

AUC_SQL = f"""{SCORED_SQL}{DIST_SQL},
c AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                AS neg_before FROM d)
SELECT round(sum(pos * (neg_before + 0.5 * neg)) / (sum(pos) * sum(neg)), 6) AS roc_auc FROM c"""

AP_SQL = f"""{SCORED_SQL}{DIST_SQL},
c AS (SELECT *, sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
                sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp FROM d)
SELECT round(sum(pos * tp / (tp + fp)) / sum(pos), 6) AS pr_auc FROM c"""

EPS = me.LOG_LOSS_EPS
LOGLOSS_EXPR = (f"avg(-(label * ln(least(greatest(score, {EPS!r}), 1 - {EPS!r})) + (1 - label) * "
                f"ln(1 - least(greatest(score, {EPS!r}), 1 - {EPS!r}))))")
LOGLOSS_SQL = f"{SCORED_SQL} SELECT round({LOGLOSS_EXPR}, 6) AS log_loss FROM scored"
BRIER_SQL = f"{SCORED_SQL} SELECT round(avg((score - label) * (score - label)), 6) AS brier_score FROM scored"

CONF_SQL = f""", conf AS (SELECT count(*) FILTER (WHERE score >= {THRESHOLD} AND label = 1) AS tp,
       count(*) FILTER (WHERE score >= {THRESHOLD} AND label = 0) AS fp,
       count(*) FILTER (WHERE score < {THRESHOLD} AND label = 1) AS fn,
       count(*) FILTER (WHERE score < {THRESHOLD} AND label = 0) AS tn FROM scored)"""


def f1_sql(tp, fp, fn):
    return f"CASE WHEN 2 * {tp} + {fp} + {fn} > 0 THEN 2.0 * {tp} / (2 * {tp} + {fp} + {fn}) ELSE 0.0 END"


F1_SQL = f"{SCORED_SQL}{CONF_SQL} SELECT round({f1_sql('tp', 'fp', 'fn')}, 6) AS f1_at_threshold FROM conf"

THR_VALUES = ", ".join(f"({i}, {t!r})" for i, t in enumerate(me.F1_THRESHOLDS))
BEST_F1_SQL = f"""{SCORED_SQL},
th AS (SELECT * FROM (VALUES {THR_VALUES}) v(i, t)),
g AS (SELECT th.i, th.t, count(*) FILTER (WHERE s.score >= th.t AND s.label = 1) AS tp,
             count(*) FILTER (WHERE s.score >= th.t) AS pp,
             (SELECT count(*) FILTER (WHERE label = 1) FROM scored) AS p_all
      FROM th, scored s GROUP BY th.i, th.t),
f AS (SELECT i, t, {f1_sql('tp', '(pp - tp)', '(p_all - tp)')} AS f1 FROM g)
SELECT t AS threshold, round(f1, 6) AS f1 FROM f ORDER BY f1 DESC, i ASC LIMIT 1"""

REPORT_SQL = f"""{SCORED_SQL}{CONF_SQL}
SELECT 1 AS class, round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 6) AS precision,
       round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 6) AS recall,
       round({f1_sql('tp', 'fp', 'fn')}, 6) AS f1, tp + fn AS support FROM conf
UNION ALL
SELECT 0, round(CASE WHEN tn + fn > 0 THEN tn / (tn + fn) ELSE 0 END, 6),
       round(CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0 END, 6),
       round({f1_sql('tn', 'fn', 'fp')}, 6), tn + fp FROM conf"""

CALIB_SQL = f"""{SCORED_SQL},
e AS (SELECT quantile_cont(score, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) AS q FROM scored),
b AS (SELECT s.*, CAST(len(list_filter(e.q[2:10], lambda x: x < s.score)) AS INTEGER) AS bin FROM scored s, e)
SELECT bin, count(*) AS n, round(avg(score), 6) AS mean_predicted, round(avg(label), 6) AS fraction_positives
FROM b GROUP BY bin"""

def _metrics_sql() -> str:
    parts = [("roc_auc", AUC_SQL), ("pr_auc", AP_SQL), ("log_loss", LOGLOSS_SQL), ("brier_score", BRIER_SQL),
             ("f1_at_threshold", F1_SQL)]
    sel = [f"SELECT 'threshold' AS metric, {THRESHOLD} AS value"]
    for name, sql in parts:
        sel.append(f"SELECT '{name}' AS metric, CAST(({sql}) AS DOUBLE) AS value")
    return "\nUNION ALL\n".join(sel)


# ------------------------------------------------------------------ cohorts

@query("cohort_labels", f"""{with_period('period1')}
SELECT msno, is_churn FROM labels_p WHERE msno IN (
  SELECT msno FROM (SELECT msno, row_number() OVER (PARTITION BY is_churn ORDER BY h, msno) AS rn,
                           count(*) OVER (PARTITION BY is_churn) AS n
                    FROM (SELECT *, {H('msno')} AS h FROM labels_p))
  WHERE rn <= floor(n * {co.SAMPLE_FRACTION}))""")
def q_cohort_labels(spark, sf_dir):
    """J1 + A7: labels of the sampled members (semi join on distinct keys)."""
    lab = td.labels(spark, sf_dir, "period1")
    return co.cohort_labels(lab, co.stratified_sample(lab, "msno", "is_churn", co.SAMPLE_FRACTION, SEED))


@query("stratified_sample_exact", f"""{with_period('period1')}
SELECT msno, is_churn FROM (
  SELECT *, row_number() OVER (PARTITION BY is_churn ORDER BY h, msno) AS rn,
         count(*) OVER (PARTITION BY is_churn) AS n FROM (SELECT *, {H('msno')} AS h FROM labels_p))
WHERE rn <= floor(n * {co.SAMPLE_FRACTION})""")
def q_stratified_sample_exact(spark, sf_dir):
    """M1: exact 25 % of each churn class, md5-ordered."""
    return co.stratified_sample(td.labels(spark, sf_dir, "period1"), "msno", "is_churn", co.SAMPLE_FRACTION, SEED)


def _split_sql(src: str, strata: str, frac: float, names=("train", "valid"), key: str = "msno") -> str:
    return f"""SELECT * EXCLUDE (h, rn, n), CASE WHEN rn <= ceil(n * {frac}) THEN '{names[1]}' ELSE '{names[0]}' END AS split
FROM (SELECT *, row_number() OVER (PARTITION BY {strata} ORDER BY h, {key}) AS rn,
             count(*) OVER (PARTITION BY {strata}) AS n FROM (SELECT *, {H(key)} AS h FROM {src}))"""


@query("stratified_split", f"{with_period('period1')} {_split_sql('labels_p', 'is_churn', 0.2)}")
def q_stratified_split(spark, sf_dir):
    """M2: 80/20 train/valid split stratified on the label."""
    return co.stratified_split(td.labels(spark, sf_dir, "period1"), "msno", "is_churn", 0.2, SEED)


POOLED_SQL = ("WITH " + td.role_sql() + "," + td.period_sql("period1", "p1") + "," + td.period_sql("period2", "p2")
              + """, pooled AS (SELECT msno, 'period1' AS period, is_churn FROM labels_p1
                 UNION ALL SELECT msno, 'period2' AS period, is_churn FROM labels_p2)""")


def _pooled_labels(spark, sf_dir):
    return co.pooled([td.labels(spark, sf_dir, p).withColumn("period", F.lit(p)) for p in ("period1", "period2")])


@query("oot_split", f"""{POOLED_SQL}
SELECT msno, period, is_churn, CASE WHEN period = 'period1' THEN 'train' ELSE 'oot' END AS split FROM pooled""")
def q_oot_split(spark, sf_dir):
    """M3 + U3: out-of-time split over the pooled periods."""
    return co.oot_split(_pooled_labels(spark, sf_dir), "period1").select("msno", "period", "is_churn", "split")


@query("naive_split_overlap", f"""{POOLED_SQL},
tr1 AS ({_split_sql('labels_p1', 'is_churn', 0.2)}),
k AS (SELECT count(*) FILTER (WHERE split = 'train') AS k FROM tr1),
rows AS (SELECT *, msno || '|' || period AS rk FROM pooled),
o AS (SELECT *, row_number() OVER (PARTITION BY is_churn ORDER BY {H('rk')}, rk) AS rn,
             count(*) OVER (PARTITION BY is_churn) AS n FROM rows),
test AS (SELECT * FROM o WHERE rn <= ceil(n * 0.2)),
train AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY {H('rk', SEED + 1)}, rk) AS trn
                         FROM o WHERE rn > ceil(n * 0.2)) WHERE trn <= (SELECT k FROM k))
SELECT (SELECT count(*) FROM train) AS n_train, (SELECT count(*) FROM test) AS n_test,
       (SELECT count(DISTINCT msno) FROM train WHERE msno IN (SELECT msno FROM test)) AS n_members_both_sides""")
def q_naive_split_overlap(spark, sf_dir):
    """M4: pooled random split, train cut to the period1 train size, and the
    members that leak across the split."""
    p1 = co.stratified_split(td.labels(spark, sf_dir, "period1"), "msno", "is_churn", 0.2, SEED)
    k = p1.where(F.col("split") == "train").count()  # one scalar
    return co.naive_split_overlap(_pooled_labels(spark, sf_dir), "msno", "period", "is_churn", k, 0.2, SEED)


@query("ab_assignment", f"""{with_period('period2')}
SELECT msno, CAST({H('msno')} % 2 AS INTEGER) AS treatment FROM labels_p""")
def q_ab_assignment(spark, sf_dir):
    """M6: seeded 50/50 offer assignment of the period2 population."""
    return co.ab_assignment(td.labels(spark, sf_dir, "period2"), "msno", SEED).select("msno", "treatment")


@query("treatment_split", f"""{with_period('period2')}, ab AS (SELECT msno, is_churn, CAST({H('msno')} % 2 AS INTEGER) AS treatment FROM labels_p)
{_split_sql('ab', 'treatment', 0.3, ('train', 'test'))}""")
def q_treatment_split(spark, sf_dir):
    """M5: 70/30 split stratified on treatment."""
    ab = co.ab_assignment(td.labels(spark, sf_dir, "period2"), "msno", SEED)
    return co.stratified_split(ab, "msno", "treatment", 0.3, SEED, names=("train", "test"))


# ------------------------------------------------------------------ metrics

@query("roc_auc", AUC_SQL)
def q_roc_auc(spark, sf_dir):
    return me.roc_auc(scored(spark, sf_dir), "label", "score")


@query("pr_auc", AP_SQL)
def q_pr_auc(spark, sf_dir):
    return me.average_precision(scored(spark, sf_dir), "label", "score")


@query("log_loss", LOGLOSS_SQL)
def q_log_loss(spark, sf_dir):
    return me.log_loss(scored(spark, sf_dir), "label", "score")


@query("brier_score", BRIER_SQL)
def q_brier_score(spark, sf_dir):
    return me.brier_score(scored(spark, sf_dir), "label", "score")


@query("f1_at_threshold", F1_SQL)
def q_f1_at_threshold(spark, sf_dir):
    return me.f1_at_threshold(scored(spark, sf_dir), THRESHOLD, "label", "score")


@query("best_f1_threshold", BEST_F1_SQL)
def q_best_f1_threshold(spark, sf_dir):
    return me.best_f1_threshold(scored(spark, sf_dir), "label", "score")


@query("classification_report", REPORT_SQL)
def q_classification_report(spark, sf_dir):
    return me.classification_report(scored(spark, sf_dir), THRESHOLD, "label", "score")


@query("calibration_curve", CALIB_SQL)
def q_calibration_curve(spark, sf_dir):
    return me.calibration_curve(scored(spark, sf_dir), "label", "score", 10)


@query("model_metrics", _metrics_sql())
def q_model_metrics(spark, sf_dir):
    return me.metric_table(scored(spark, sf_dir), THRESHOLD, "label", "score")


@query("percentile_rank_avg", f"""{SCORED_SQL}
SELECT msno, score, round((rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0)
                          / count(*) OVER (), 6) AS rank_pct FROM scored""")
def q_percentile_rank_avg(spark, sf_dir):
    """Pandas-style rank(pct=True), ties averaged, distributed."""
    s = scored(spark, sf_dir).select("msno", "score")
    return od.average_ranks(s, "score", "_r", "rank_pct").drop("_r")


@query("spearman", f"""{SCORED_SQL}, tx_win AS ({tx_window_sql()}),
j AS (SELECT s.msno, s.score AS a, CAST(w.n_transactions_lifetime AS DOUBLE) AS b FROM scored s JOIN tx_win w USING (msno)),
r AS (SELECT rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1) / 2.0 AS ra,
             rank() OVER (ORDER BY b) + (count(*) OVER (PARTITION BY b) - 1) / 2.0 AS rb FROM j)
SELECT round(corr(ra, rb), 6) AS spearman FROM r""")
def q_spearman(spark, sf_dir):
    """K9: Spearman correlation of the recency score and lifetime order count."""
    from keepcurve.operators.survival import spearman
    s = scored(spark, sf_dir)
    w = fe.transaction_window_features(transactions(spark, sf_dir, "period2"), C2)
    j = s.join(w, "msno").select("msno", F.col("score").alias("a"),
                                 F.col("n_transactions_lifetime").cast("double").alias("b"))
    return spearman(j, "a", "b")
