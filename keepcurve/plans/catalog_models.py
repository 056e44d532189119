"""Rows-only queries: fitted models (no SQL oracle -- fits are iterative).

They follow the original flow: train on period1 with a stratified 80/20
validation split, pick thresholds on validation, evaluate out-of-time on
period2; Cox on the pooled survival frame; the T-learner on the hold-out of
the experiment table; the retrain gate against the registry table.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from keepcurve.operators import boosting as bo
from keepcurve.operators import cohort as co
from keepcurve.operators import cox
from keepcurve.operators import isotonic as iso
from keepcurve.operators import ltv as lt
from keepcurve.operators import metrics as me
from keepcurve.operators import models as mo
from keepcurve.operators import prep
from keepcurve.operators import promotion as pm
from keepcurve.operators import survival as sv
from keepcurve.operators import uplift as up
from keepcurve.operators.concordance import concordance_index
from keepcurve.operators.ordered import row_prefix
from keepcurve.plans.catalog_eval import H
from keepcurve.plans.catalog_features import snapshot, snapshots, with_both
from keepcurve.plans.catalog_survival import SURV_SQL, churn_score, cox_prep_sql, surv
from keepcurve.plans.catalog_uplift import CATEGORICAL_FEATURES, HOLDOUT, NUMERIC_FEATURES, SEED
from keepcurve.plans.catalog_sinks import _table_path
from keepcurve.plans.registry import query
from keepcurve.session import cut_lineage, together
from keepcurve.sources import snapshots as store

KEEP = ["msno", "label"]


def _both(spark, sf_dir):
    """Both periods' snapshots, from one pass over the sources, written once."""
    return cut_lineage(snapshots(spark, sf_dir).withColumn("label", F.col("is_churn")))


def _periods(both):
    """Period1 with its validation split, and period2."""
    p1, p2 = (both.where(F.col("period") == p) for p in ("period1", "period2"))
    return cut_lineage(co.stratified_split(p1, "msno", "label", 0.2, SEED)), p2


def _threshold(scored_valid):
    return float(me.best_f1_threshold(scored_valid, "label", "score").first()["threshold"])


def _metrics(name, scored_oot, thr):
    return me.metric_table(scored_oot, thr, "label", "score").select(F.lit(name).alias("model"), "metric", "value")


def _gbt(p1):
    """Weights, sentinels and trees from the training rows; the validation rows choose the length."""
    train = mo.scale_pos_weight_col(p1.where(F.col("split") == "train"), "label", "w")
    valid = p1.where(F.col("split") == "valid")
    return mo.fit_gbt(train, NUMERIC_FEATURES, CATEGORICAL_FEATURES, "label", valid=valid, weight_col="w")


def _boosted(p1):
    """Histogram-boosted trees on the training rows with their missing values;
    the validation rows' PR-AUC chooses the length."""
    train = mo.scale_pos_weight_col(p1.where(F.col("split") == "train"), "label", "w")
    return bo.fit_boosted(train, NUMERIC_FEATURES + CATEGORICAL_FEATURES, "label", "msno", valid=p1.where(F.col("split") == "valid"), weight_col="w")


def _trees(spark, model, n):
    """The number of trees as a row of the metric table."""
    return spark.range(1).select(F.lit(model).alias("model"), F.lit("n_trees").alias("metric"), F.lit(float(n)).alias("value"))


@query("churn_model_metrics")
def q_churn_model_metrics(spark, sf_dir):
    """Logistic regression, boosted trees and isotonic-
    calibrated trees; thresholds on validation, metrics out of time."""
    p1, p2 = _periods(_both(spark, sf_dir))
    train, valid = p1.where(F.col("split") == "train"), p1.where(F.col("split") == "valid")

    def logreg():
        lr = mo.fit_logreg(train, NUMERIC_FEATURES, CATEGORICAL_FEATURES, "label")
        return _metrics("logreg", lr.score(p2, KEEP), _threshold(lr.score(valid, KEEP)))

    def boosted():
        g = _boosted(p1)
        gv, oot = together(lambda: cut_lineage(g.score(valid, KEEP)), lambda: cut_lineage(g.score(p2, KEEP)))

        def isotonic():
            blocks = iso.fit_isotonic_blocks(gv)
            calibrated = [cut_lineage(iso.calibrate_blocks(blocks, s)) for s in (oot, gv)]
            return _metrics("gbt_isotonic", calibrated[0], _threshold(calibrated[1]))

        raw, calibrated = together(lambda: _metrics("gbt", oot, _threshold(gv)), isotonic)
        return raw.unionByName(_trees(spark, "gbt", g.n_trees)).unionByName(calibrated)

    out, trees = together(logreg, boosted)
    return out.unionByName(trees)


@query("oot_vs_naive_split")
def q_oot_vs_naive_split(spark, sf_dir):
    """E10 + M4: the same tree model on a pooled random split (train cut to
    the period1 train size) vs the genuine out-of-time split."""
    p1, p2 = _periods(_both(spark, sf_dir))

    def out_of_time():
        stopped = _gbt(p1)
        return cut_lineage(stopped.score(p2, KEEP)), stopped

    def random_split():
        pooled = co.pooled([p1.drop("split"), p2])
        pooled = co.stratified_split(pooled.withColumn("_rk", F.concat_ws("|", F.col("msno").cast("string"), "period")),
                                     "_rk", "label", 0.2, SEED, names=("train", "test"))
        k = p1.where(F.col("split") == "train").count()
        # first k train rows in a second seeded hash order (distributed prefix, not a k-row limit in one task)
        tr = pooled.where(F.col("split") == "train").withColumn("_h2", F.xxhash64("_rk", F.lit(SEED)))
        tr = (row_prefix(tr, "_h2", "_rk", None, (), rn_col="_trn", n_col="_tn")
              .where(F.col("_trn") <= F.lit(int(k))).drop("_h2", "_trn", "_tn"))
        tr = mo.scale_pos_weight_col(tr, "label", "w")
        g = mo.fit_gbt(tr, NUMERIC_FEATURES, CATEGORICAL_FEATURES, "label", weight_col="w")
        return cut_lineage(g.score(pooled.where(F.col("split") == "test"), KEEP)), g

    (oot, stopped), (naive, g) = together(out_of_time, random_split)
    sides = (("oot_time_split", oot, stopped), ("naive_random_split", naive, g))
    auc = lambda name, df, m: me.roc_auc(df, "label", "score").select(F.lit(name).alias("evaluation"), "roc_auc", F.lit(m.n_trees).alias("n_trees"))
    parts = together(*[partial(auc, *side) for side in sides])
    return parts[0].unionByName(parts[1])


@query("uplift_t_learner")
def q_uplift_t_learner(spark, sf_dir):
    """T-learner (one tree regressor per arm) on 70 % of the
    experiment, Qini of its uplift and of a random ranking on the 30 %."""
    s = snapshot(spark, sf_dir, "period2")
    e = co.ab_assignment(s, "msno", SEED).withColumn("observed_retained", 1 - F.col("is_churn"))
    e = cut_lineage(co.stratified_split(e, "msno", "treatment", HOLDOUT, SEED, names=("train", "test")))
    train, test = e.where(F.col("split") == "train"), e.where(F.col("split") == "test")
    tl = mo.fit_t_learner(train, NUMERIC_FEATURES + CATEGORICAL_FEATURES, "treatment", "observed_retained")
    scored = tl.effect(test, ["msno", "treatment", "observed_retained"])
    model, rnd = together(lambda: up.qini_coefficient(up.qini_curve(scored, "predicted_uplift", "msno")),
                          lambda: up.qini_coefficient(up.qini_curve(up.random_score(test, "msno", 0), "random_score", "msno")))
    return (model.select(F.lit("t_learner").alias("ranking"), "qini_coefficient")
            .unionByName(rnd.select(F.lit("random").alias("ranking"), "qini_coefficient")))


def _cox_input(spark, sf_dir, extra=()):
    s = surv(spark, sf_dir, dict.fromkeys(["msno", "period", "tenure_days", "is_churn", *sv.COX_COVARIATES, *extra]))
    stats = sv.collect_stats(sv.cox_prep_fit(s))
    return s, cut_lineage(sv.cox_prep_transform(s, stats, keep=["msno", "period", "tenure_days", "is_churn"]))


@query("cox_summary")
def q_cox_summary(spark, sf_dir):
    """K4 + K5: penalised Cox fit (Efron ties) and its summary table."""
    _, x = _cox_input(spark, sf_dir)
    fit = cox.cox_fit(x, "tenure_days", "is_churn", sv.COX_COVARIATES, penalizer=cox.PENALIZER)
    return cox.cox_summary(spark, fit)


def _event_sum(c: str) -> str:
    x = f"coalesce(CAST({c} AS DOUBLE), (SELECT median FROM cp WHERE covariate = '{c}'))"
    if c == "engagement_momentum":
        x = f"least({x}, {sv.MOMENTUM_CLIP})"
    if c not in sv.BINARY_COX_COVARIATES:
        x = f"({x} - (SELECT mean FROM cp WHERE covariate = '{c}')) / (SELECT std FROM cp WHERE covariate = '{c}')"
    return f"SELECT '{c}' AS covariate, round(sum({x}), 4) AS event_sum, true AS converged FROM surv WHERE is_churn = 1"


@query("cox_gradient_zero", SURV_SQL + cox_prep_sql() + "\n" + "\nUNION ALL ".join(_event_sum(c) for c in sv.COX_COVARIATES), decimals=4)
def q_cox_gradient_zero(spark, sf_dir):
    """K4: at the optimum the covariates' sums over the events equal what the
    fit expects there (risk-set means, plus the penalty's share)."""
    _, x = _cox_input(spark, sf_dir)
    fit = cox.cox_fit(x, "tenure_days", "is_churn", sv.COX_COVARIATES, penalizer=cox.PENALIZER)
    expected = fit["expected"] + fit["n"] * cox.PENALIZER * fit["coef"]
    rows = [(c, float(e), bool(fit["converged"])) for c, e in zip(fit["covariates"], expected)]
    return spark.createDataFrame(rows, "covariate string, event_sum double, converged boolean")


@query("survival_vs_classifier")
def q_survival_vs_classifier(spark, sf_dir):
    """Fitted Cox risk vs an in-sample tree classifier on the pooled
    frame: Spearman of the two scores, Cox concordance, classifier ROC-AUC."""
    s, x = _cox_input(spark, sf_dir, NUMERIC_FEATURES + CATEGORICAL_FEATURES)

    def hazard():
        fit = cox.cox_fit(x, "tenure_days", "is_churn", sv.COX_COVARIATES, penalizer=cox.PENALIZER)
        means = x.agg(*[F.avg(c).alias(c) for c in sv.COX_COVARIATES]).first().asDict()
        return sv.partial_hazard(x, dict(zip(fit["covariates"], fit["coef"])), means, "cox_risk")

    def trees():
        lab = mo.scale_pos_weight_col(s.withColumn("label", F.col("is_churn")), "label", "w")
        g = mo.fit_gbt(lab, NUMERIC_FEATURES, CATEGORICAL_FEATURES, "label", weight_col="w")
        return g.score(lab, ["msno", "period", "label"])

    risk, clf = together(hazard, trees)
    j = cut_lineage(clf.join(risk.select("msno", "period", "tenure_days", "is_churn", "cox_risk"), ["msno", "period"]))
    rho, ci, auc = together(
        lambda: sv.spearman(j, "score", "cox_risk").select(F.lit("spearman_corr_clf_vs_cox_risk").alias("metric"), F.col("spearman").alias("value")),
        lambda: concordance_index(j, "tenure_days", "is_churn", "cox_risk").select(F.lit("cox_concordance_index").alias("metric"),
                                                                                 F.col("concordance_index").alias("value")),
        lambda: me.roc_auc(j, "label", "score").select(F.lit("classifier_in_sample_roc_auc").alias("metric"), F.col("roc_auc").alias("value")))
    return rho.unionByName(ci).unionByName(auc)


@query("retrain_gate")
def q_retrain_gate(spark, sf_dir):
    """Train a candidate tree model, evaluate out of time, and gate
    it against the registry's champion (the recency model, version 1)."""
    p1, p2 = _periods(_both(spark, sf_dir))

    def candidate():
        g = _boosted(p1)
        thr = _threshold(g.score(p1.where(F.col("split") == "valid"), KEEP))
        return me.metric_table(cut_lineage(g.score(p2, KEEP)), thr, "label", "score").select(
            F.lit("churn-classifier").alias("model"), F.lit(2).alias("version"), "metric", "value")

    def champion():
        return me.metric_table(p2.withColumn("score", churn_score()), 0.5, "label", "score").select(
            F.lit("churn-classifier").alias("model"), F.lit(1).alias("version"), F.lit("champion").alias("alias"),
            "metric", "value")

    cand, champ = together(candidate, champion)
    return pm.promotion_gate(cand, champ)


FILL_FEATURES = NUMERIC_FEATURES + CATEGORICAL_FEATURES
TRAIN_SIDE_SQL = with_both() + f""",
ex AS (SELECT *, CAST({H('msno')} % 2 AS INTEGER) AS treatment, {H('msno')} AS h FROM snap2),
tr AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY treatment ORDER BY h, msno) AS rn,
                             count(*) OVER (PARTITION BY treatment) AS n FROM ex) WHERE rn > ceil(n * {HOLDOUT}))"""


@query("uplift_median_fill", TRAIN_SIDE_SQL + "\n" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS feature, coalesce(quantile_cont(CAST({c} AS DOUBLE), 0.5), 0.0) AS median FROM tr" for c in FILL_FEATURES))
def q_uplift_median_fill(spark, sf_dir):
    """The fills of all 45 features, learned on the experiment's training side."""
    e = co.ab_assignment(snapshot(spark, sf_dir, "period2"), "msno", SEED)
    e = co.stratified_split(e, "msno", "treatment", HOLDOUT, SEED, names=("train", "test"))
    train = cut_lineage(e.where(F.col("split") == "train").select(*FILL_FEATURES))
    return spark.createDataFrame(list(mo.median_fills(train, FILL_FEATURES).items()), "feature string, median double")


MODE_SQL = with_both() + ",\nlg AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS v FROM snap1" for c in CATEGORICAL_FEATURES) + """),
ct AS (SELECT feature, v, count(*) AS n FROM lg WHERE v IS NOT NULL GROUP BY feature, v),
md AS (SELECT feature, v AS mode FROM (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY n DESC, v) AS k FROM ct) WHERE k = 1)"""


@query("mode_impute", MODE_SQL + "\nSELECT feature, mode FROM md")
def q_mode_impute(spark, sf_dir):
    """N2 fit: mode of every categorical feature, period1."""
    return prep.mode_impute_fit(snapshot(spark, sf_dir, "period1"), CATEGORICAL_FEATURES)


@query("one_hot_counts", MODE_SQL + """
SELECT feature, coalesce(v, mode) AS category, count(*) AS n FROM lg JOIN md USING (feature) GROUP BY ALL""")
def q_one_hot_counts(spark, sf_dir):
    """Column sums of the one-hot matrix after the mode fill, period1."""
    return prep.one_hot_counts(cut_lineage(snapshot(spark, sf_dir, "period1").select(*CATEGORICAL_FEATURES)), CATEGORICAL_FEATURES)


@query("retention_pipeline")
def q_retention_pipeline(spark, sf_dir):
    """The fitted chain end to end: champion trees, Cox model and T-learner are
    fitted, stored and loaded again; their scores make the LTV table and
    segments (stored, S7) and, joined to the uplift, the offer targeting list
    (S8), which is returned."""
    at = _table_path(spark, "retention_pipeline")
    both = _both(spark, sf_dir)
    p1, p2 = _periods(both)
    keys, duration = ["msno", "period"], ["msno", "period", "tenure_days", "is_churn"]

    def champion_trees():
        bo.save_boosted(spark, _boosted(p1), f"{at}/champion")

    def uplift_learner():
        experiment = co.stratified_split(co.ab_assignment(p2, "msno", SEED), "msno", "treatment", HOLDOUT, SEED, names=("train", "test"))
        train = cut_lineage(experiment.where(F.col("split") == "train").withColumn("observed_retained", 1 - F.col("is_churn")))
        mo.save_t_learner(spark, mo.fit_t_learner(train, FILL_FEATURES, "treatment", "observed_retained"), f"{at}/uplift")

    def hazard_model():
        s = sv.survival_frame(both)
        prepared = cut_lineage(sv.cox_prep_fit(s))
        x = cut_lineage(sv.cox_prep_transform(s, sv.collect_stats(prepared), keep=duration))
        fit = cox.cox_fit(x, "tenure_days", "is_churn", sv.COX_COVARIATES, penalizer=cox.PENALIZER)
        theta = cut_lineage(sv.partial_hazard(x, dict(zip(fit["covariates"], fit["coef"])), None, "theta"))
        cox.save_cox(spark, f"{at}/cox", cox.cox_summary(spark, fit), prepared, sv.breslow_baseline(theta, "tenure_days", "is_churn", "theta"))
        return s

    s = together(champion_trees, uplift_learner, hazard_model)[2]
    champion, uplift = bo.load_boosted(spark, f"{at}/champion"), mo.load_t_learner(spark, f"{at}/uplift")
    bundle = cox.load_cox(spark, f"{at}/cox")
    hazard = cut_lineage(sv.partial_hazard(sv.cox_prep_transform(s, bundle["stats"], keep=duration), bundle["coef"], None, "theta"))
    base = bundle["baseline"]
    life = lt.expected_remaining_life(hazard.select(*keys, "tenure_days", "theta"), base, "tenure_days", "theta")
    money = s.select(*keys, "last_actual_amount_paid", "last_payment_plan_days")
    churn = champion.score(s, keys).withColumnRenamed("score", "churn_probability")
    valued = cut_lineage(lt.ltv(lt.daily_revenue(life.join(money, keys))).join(churn, keys))
    store.write_table(lt.retention_segments(valued), f"{at}/ltv_table")

    ltv = spark.read.parquet(f"{at}/ltv_table").select(*keys, "ltv", "churn_probability", "retention_priority_segment")
    targets = up.targeting_list(uplift.effect(p2, keys), ltv)
    store.write_table(targets, f"{at}/targeting_list")
    return spark.read.parquet(f"{at}/targeting_list")
