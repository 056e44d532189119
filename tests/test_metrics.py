"""Evaluation operators vs direct numpy definitions."""

import numpy as np
import pandas as pd
import pytest

from keepcurve.operators import metrics as me


def _scored(seed=0, n=500):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, n)
    s = np.round(np.clip(0.3 * y + rng.random(n) * 0.7, 0, 1), 2)  # many ties
    s[:3] = [0.0, 1.0, 1.0]
    return pd.DataFrame({"key": np.arange(n), "label": y, "score": s})


def _auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    cmp = (pos[:, None] > neg[None, :]) + 0.5 * (pos[:, None] == neg[None, :])
    return cmp.mean()


def _ap(y, s):
    order = np.unique(s)[::-1]
    P = y.sum()
    ap, prev_r = 0.0, 0.0
    for t in order:
        pred = s >= t
        tp = (pred & (y == 1)).sum()
        r = tp / P
        ap += (r - prev_r) * tp / pred.sum()
        prev_r = r
    return ap


def test_ranking_metrics(spark):
    pdf = _scored()
    df = spark.createDataFrame(pdf)
    y, s = pdf["label"].to_numpy(), pdf["score"].to_numpy()
    assert me.roc_auc(df).first()["roc_auc"] == pytest.approx(_auc(y, s))
    assert me.average_precision(df).first()["pr_auc"] == pytest.approx(_ap(y, s))
    eps = me.LOG_LOSS_EPS
    p = np.clip(s, eps, 1 - eps)
    assert me.log_loss(df).first()["log_loss"] == pytest.approx(-np.mean(y * np.log(p) + (1 - y) * np.log(1 - p)))
    assert me.brier_score(df).first()["brier_score"] == pytest.approx(np.mean((s - y) ** 2))


def test_f1_and_best_threshold(spark):
    pdf = _scored(1)
    df = spark.createDataFrame(pdf)
    y, s = pdf["label"].to_numpy(), pdf["score"].to_numpy()

    def f1(t):
        pred = s >= t
        tp, fp, fn = (pred & (y == 1)).sum(), (pred & (y == 0)).sum(), (~pred & (y == 1)).sum()
        return 0.0 if tp == 0 else 2 * tp / (2 * tp + fp + fn)

    assert me.f1_at_threshold(df, 0.5).first()["f1_at_threshold"] == pytest.approx(f1(0.5))
    grid = me.F1_THRESHOLDS
    vals = [f1(t) for t in grid]
    best = grid[int(np.argmax(vals))]  # first (lowest) threshold wins ties
    r = me.best_f1_threshold(df).first()
    assert r["threshold"] == pytest.approx(best) and r["f1"] == pytest.approx(max(vals))


def test_one_class_auc_is_null(spark):
    df = spark.createDataFrame(pd.DataFrame({"label": [1, 1, 1], "score": [0.1, 0.5, 0.9]}))
    assert me.roc_auc(df).first()["roc_auc"] is None


def test_calibration_curve_quantile_bins(spark):
    pdf = _scored(2)
    df = spark.createDataFrame(pdf)
    got = me.calibration_curve(df).toPandas().sort_values("bin")
    s, y = pdf["score"].to_numpy(), pdf["label"].to_numpy()
    edges = np.quantile(s, np.linspace(0, 1, 11))
    b = np.searchsorted(edges[1:-1], s, side="left")
    exp = pd.DataFrame({"b": b, "s": s, "y": y}).groupby("b").agg(ms=("s", "mean"), fy=("y", "mean"))
    assert list(got["bin"]) == list(exp.index)
    assert np.allclose(got["mean_predicted"], exp["ms"]) and np.allclose(got["fraction_positives"], exp["fy"])
    # fewer distinct scores than bins: empty bins are dropped
    few = spark.createDataFrame(pd.DataFrame({"label": [0, 1, 0, 1], "score": [0.2, 0.2, 0.8, 0.8]}))
    assert me.calibration_curve(few).count() <= 2


def test_classification_report_support(spark):
    pdf = _scored(3)
    rep = {r["class"]: r for r in me.classification_report(spark.createDataFrame(pdf), 0.5).collect()}
    assert rep[1]["support"] == pdf["label"].sum() and rep[0]["support"] == (pdf["label"] == 0).sum()
