"""Model operators: seeded fits on a small fixture; check score range and
metric rows only (test data carry no signal worth asserting on)."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from keepcurve.operators import metrics as me
from keepcurve.operators import models as mo


def _train(spark, n=400, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=n)
    y = (x + rng.normal(scale=0.5, size=n) > 0.5).astype(int)
    z = np.where(rng.random(n) < 0.1, np.nan, rng.normal(size=n))
    cat = rng.integers(0, 3, n).astype(float)
    pdf = pd.DataFrame({"msno": np.arange(n), "x": x, "z": z, "c": cat, "label": y,
                        "split": np.where(rng.random(n) < 0.2, "valid", "train")})
    return spark.createDataFrame(pdf).withColumn("z", F.when(F.isnan("z"), None).otherwise(F.col("z")))


def test_logreg_scores_are_probabilities(spark):
    df = _train(spark)
    m = mo.fit_logreg(df, ["x", "z"], ["c"], "label", max_iter=50)
    s = m.score(df, ["msno", "label"])
    r = s.agg(F.min("score").alias("lo"), F.max("score").alias("hi"), F.count("*").alias("n")).first()
    assert 0.0 <= r["lo"] <= r["hi"] <= 1.0 and r["n"] == 400
    assert me.roc_auc(s, "label", "score").first()["roc_auc"] > 0.8


def test_gbt_with_missing_values_and_isotonic(spark):
    df = _train(spark)
    train = mo.scale_pos_weight_col(df.where("split = 'train'"), "label", "w")
    g = mo.fit_gbt(train, ["x", "z"], ["c"], "label", valid=df.where("split = 'valid'"), weight_col="w", params={"maxIter": 5})
    s = g.score(df, ["msno", "label"])
    assert s.where(F.col("score").isNull() | (F.col("score") < 0) | (F.col("score") > 1)).count() == 0
    iso = mo.fit_isotonic(s)
    cal = mo.calibrate(iso, s).toPandas().sort_values("msno")
    raw = s.toPandas().sort_values("msno")
    order = np.argsort(raw["score"].to_numpy(), kind="stable")
    assert (np.diff(cal["score"].to_numpy()[order]) >= -1e-12).all()  # monotone in the raw score


def test_t_learner_effect(spark):
    df = _train(spark).withColumn("treatment", (F.col("msno") % 2).cast("int"))
    tl = mo.fit_t_learner(df, ["x", "z"], "treatment", "label", params={"maxIter": 3})
    e = tl.effect(df, ["msno"])
    assert e.count() == 400 and e.where(F.col("predicted_uplift").isNull()).count() == 0


def test_best_length_has_patience():
    assert mo.best_length([0.9, 0.8, 0.81, 0.82, 0.7, 0.75, 0.76, 0.77, 0.1], patience=3) == 5
    assert mo.best_length([0.9, 0.8, 0.7], patience=3) == 3 and mo.best_length([0.5], patience=1) == 1


def test_early_stopping_keeps_more_than_one_tree_and_the_best_length(spark, monkeypatch):
    monkeypatch.setattr(mo, "FIRST_TREES", 10)  # some rounds of doubling
    df = _train(spark, n=1200, seed=3)
    train, valid = df.where("split = 'train'"), df.where("split = 'valid'")
    params = {"maxIter": 40, "stepSize": 0.3}
    whole = mo.fit_gbt(train, ["x", "z"], ["c"], "label", params=params)
    cols = ["x", "z", "c"]
    target = F.col("label").cast("double").alias("label")
    losses = whole.model.evaluateEachIteration(mo.tree_features(valid, whole.fills, cols[:2], cols[2:], [target]))
    stopped = mo.fit_gbt(train, ["x", "z"], ["c"], "label", valid=valid, params=params, patience=5)
    assert whole.n_trees == 40 and stopped.n_trees == mo.best_length(losses, 5) > 1
    a = {r["msno"]: r["score"] for r in stopped.score(valid, ["msno"]).collect()}
    y = {r["msno"]: r["label"] for r in valid.collect()}
    loss = np.mean([2 * np.log1p(np.exp(-(2 * y[k] - 1) * np.log(p / (1 - p)))) for k, p in a.items()])
    assert loss < losses[0]


def test_t_learner_fills_with_training_medians(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (9.0, None), (None, None)], "a double, b double")
    assert mo.median_fills(df, ["a", "b"]) == {"a": 2.0, "b": 0.0}
    x = mo.filled_features(df, {"a": 2.0, "b": 0.0}, ["a", "b"], []).collect()
    assert sorted(tuple(r["features"]) for r in x) == [(1.0, 0.0), (2.0, 0.0), (2.0, 0.0), (9.0, 0.0)]


def test_models_come_back_from_their_folders(spark, tmp_path):
    df = _train(spark)
    g = mo.fit_gbt(df, ["x", "z"], ["c"], "label", params={"maxIter": 3})
    mo.save_trees(spark, g, f"{tmp_path}/trees")
    again = mo.load_trees(spark, f"{tmp_path}/trees")
    assert (again.numeric, again.categorical, again.n_trees) == (["x", "z"], ["c"], 3)
    assert sorted(again.score(df, ["msno"]).collect()) == sorted(g.score(df, ["msno"]).collect())
    tl = mo.fit_t_learner(df.withColumn("treatment", (F.col("msno") % 2).cast("int")), ["x", "z"], "treatment", "label", params={"maxIter": 2})
    mo.save_t_learner(spark, tl, f"{tmp_path}/uplift")
    assert sorted(mo.load_t_learner(spark, f"{tmp_path}/uplift").effect(df, ["msno"]).collect()) == sorted(tl.effect(df, ["msno"]).collect())


def test_trees_grow_in_few_tasks_and_in_two_fits_when_all_are_wanted(spark, monkeypatch):
    """Rows of 12 partitions make one task; a loss that improves to the end takes the first trees and all of them, no more fits."""
    df = spark.range(0, 600, 1, 12).select(F.col("id").alias("key"), (F.col("id") % 37).cast("double").alias("a"), (F.col("id") % 37 > 18).cast("int").alias("label"))
    fits, fit = [], mo.GBTClassifier.fit
    monkeypatch.setattr(mo.GBTClassifier, "fit", lambda self, x: fits.append((self.getMaxIter(), x.rdd.getNumPartitions())) or fit(self, x))
    monkeypatch.setattr(mo, "FIRST_TREES", 3)
    model = mo.fit_gbt(df, ["a"], [], "label", valid=df, params={"maxIter": 14, "subsamplingRate": 1.0}, patience=2)
    assert fits == [(3, 1), (14, 1)] and model.n_trees == 14


def test_trees_write_columns_and_no_more_than_three_tasks_a_core(spark, monkeypatch):
    """What a fit writes are the columns, not vectors with a flag beside each; more rows than three tasks a core hold make larger tasks."""
    cores = spark.sparkContext.defaultParallelism
    df = spark.range(0, 400 * cores, 1, 8 * cores).select(F.col("id").alias("key"), (F.col("id") % 37).cast("int").alias("a"), (F.col("id") % 37 > 18).cast("int").alias("label"))
    written, cut, tasks, fit = [], mo.cut_lineage, [], mo.GBTClassifier.fit
    monkeypatch.setattr(mo, "cut_lineage", lambda x: written.append(x.columns) or cut(x))
    monkeypatch.setattr(mo.GBTClassifier, "fit", lambda self, x: tasks.append(x.rdd.getNumPartitions()) or fit(self, x))
    monkeypatch.setattr(mo, "ROWS_PER_TASK", 50)
    mo.fit_gbt(df, ["a"], [], "label", params={"maxIter": 1})
    assert written == [["a", "label"]] and tasks == [3 * cores]
