"""Survival operators vs brute force on a fixture with heavy ties."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from keepcurve.operators import cox
from keepcurve.operators import survival as sv
from keepcurve.operators.concordance import concordance_index


def _fixture(seed=0, n=300):
    rng = np.random.default_rng(seed)
    x1 = rng.normal(size=n)
    x2 = rng.integers(0, 2, n).astype(float)
    t = np.ceil(rng.exponential(10 * np.exp(-0.5 * x1 + 0.3 * x2))).astype(int)
    t = np.clip(t, 1, 30)
    e = (rng.random(n) < 0.7).astype(int)
    return pd.DataFrame({"key": np.arange(n), "t": t, "e": e, "x1": x1, "x2": x2, "x3": np.ones(n),
                         "s": rng.integers(0, 2, n), "risk": np.round(rng.normal(size=n), 1)})


def test_kaplan_meier_and_median(spark):
    pdf = _fixture()
    km = sv.kaplan_meier(spark.createDataFrame(pdf), "t", "e", ["s"]).toPandas()
    for s, part in pdf.groupby("s"):
        S, rows = 1.0, []
        for t in sorted(part["t"].unique()):
            n = (part["t"] >= t).sum()
            d = ((part["t"] == t) & (part["e"] == 1)).sum()
            S *= 1 - d / n
            rows.append((t, n, d, S))
        got = km[km["s"] == s].sort_values("t")
        exp = pd.DataFrame(rows, columns=["t", "n", "d", "S"])
        assert list(got["t"]) == list(exp["t"]) and list(got["at_risk"]) == list(exp["n"])
        assert np.allclose(got["survival"], exp["S"])
        assert (np.diff(got["survival"].to_numpy()) <= 1e-12).all()  # non-increasing
        med = sv.median_survival(spark.createDataFrame(got[["t", "survival"]])).first()["median_survival"]
        below = exp[exp["S"] <= 0.5]
        assert med == (int(below["t"].iloc[0]) if len(below) else None)


def test_breslow_baseline(spark):
    pdf = _fixture(1)
    pdf["theta"] = np.exp(0.3 * pdf["x1"])
    got = sv.breslow_baseline(spark.createDataFrame(pdf), "t", "e", "theta").toPandas().sort_values("t")
    H, hs = 0.0, []
    for t in sorted(pdf["t"].unique()):
        H += ((pdf["t"] == t) & (pdf["e"] == 1)).sum() / pdf.loc[pdf["t"] >= t, "theta"].sum()
        hs.append(H)
    assert np.allclose(got["cum_hazard"], hs)
    assert np.allclose(got["baseline_survival"], np.exp(-np.array(hs)))


def _brute_cindex(t, e, r):
    conc = tie = comp = 0
    for i in range(len(t)):
        if not e[i]:
            continue
        for j in range(len(t)):
            if t[j] > t[i] or (t[j] == t[i] and not e[j] and j != i):
                comp += 1
                conc += r[i] > r[j]
                tie += r[i] == r[j]
    return conc, tie, comp


def test_concordance_exact(spark):
    pdf = _fixture(2, n=250)
    got = concordance_index(spark.createDataFrame(pdf), "t", "e", "risk").first()
    conc, tie, comp = _brute_cindex(pdf["t"].to_numpy(), pdf["e"].to_numpy(), pdf["risk"].to_numpy())
    assert (got["concordant"], got["tied"], got["comparable"]) == (conc, tie, comp)
    assert got["concordance_index"] == pytest.approx((conc + 0.5 * tie) / comp)


def test_spearman(spark):
    pdf = _fixture(3)
    got = sv.spearman(spark.createDataFrame(pdf), "risk", "t").first()["spearman"]
    assert got == pytest.approx(pdf["risk"].rank().corr(pdf["t"].rank()))


def _efron_objective(beta, t, e, X, pen):
    theta = np.exp(X @ beta)
    ll = 0.0
    for s in np.unique(t[e == 1]):
        D = (t == s) & (e == 1)
        d = D.sum()
        sr, sd = theta[t >= s].sum(), theta[D].sum()
        ll += (X[D] @ beta).sum() - sum(np.log(sr - l / d * sd) for l in range(d))
    return ll / len(t) - 0.5 * pen * beta @ beta, ll


def test_cox_fit_is_the_penalised_efron_optimum(spark):
    pdf = _fixture(4)
    cols = ["x1", "x2", "x3"]  # x3 constant: only the penalty pins it
    fit = cox.cox_fit(spark.createDataFrame(pdf), "t", "e", cols, penalizer=0.1)
    assert fit["converged"]
    b = np.asarray(fit["coef"])
    t, e, X = pdf["t"].to_numpy(), pdf["e"].to_numpy(), pdf[cols].to_numpy()
    f0, ll = _efron_objective(b, t, e, X, 0.1)
    assert fit["loglik"] == pytest.approx(ll, rel=1e-9)
    h = 1e-5
    for k in range(len(cols)):
        step = np.zeros(len(cols))
        step[k] = h
        grad = (_efron_objective(b + step, t, e, X, 0.1)[0] - _efron_objective(b - step, t, e, X, 0.1)[0]) / (2 * h)
        assert abs(grad) < 1e-6
    assert abs(b[2]) < 1e-8
    assert b[0] > 0  # larger x1 shrinks the time scale in the fixture -> higher hazard
    summ = cox.cox_summary(spark, fit).toPandas()
    assert (summ["se_coef"] > 0).all() and np.allclose(summ["exp_coef"], np.exp(summ["coef"]))


def test_cox_prep_fill_clip_scale(spark):
    pdf = pd.DataFrame({"a": [1.0, None, 3.0, 5.0], "engagement_momentum": [1.0, 9.0, None, 2.0],
                        "is_auto_renew": [1.0, 0.0, None, 1.0]})
    df = spark.createDataFrame(pdf)
    cols = ["a", "engagement_momentum", "is_auto_renew"]
    stats = sv.collect_stats(sv.cox_prep_fit(df, cols))
    out = sv.cox_prep_transform(df, stats).toPandas()
    a = pd.Series([1.0, 3.0, 3.0, 5.0])
    assert np.allclose(out["a"], (a - a.mean()) / a.std(ddof=1))
    m = pd.Series([1.0, 5.0, 2.0, 2.0])  # median fill 2.0, clip at 5
    assert np.allclose(out["engagement_momentum"], (m - m.mean()) / m.std(ddof=1))
    assert list(out["is_auto_renew"]) == [1.0, 0.0, 1.0, 1.0]  # binary: filled, not scaled


def test_efron_sums_in_closed_form_equal_the_loop():
    import numpy as np

    from keepcurve.operators.cox import efron_sums

    rng = np.random.default_rng(0)
    for d in (1, 2, 64, 65, 100, 5_000, 200_000):
        for share in (1.0, 0.999, 0.6, 0.2500001, 0.2499999, 0.1, 1e-3, 1e-7):
            e0 = float(rng.random() * d + 0.1)
            a0 = e0 / share
            c = np.arange(d) / d
            u = a0 - c * e0
            want = [(1 / u).sum(), (c / u).sum(), (1 / u ** 2).sum(), (c / u ** 2).sum(), (c * c / u ** 2).sum(), np.log(u).sum()]
            got = efron_sums([d], [a0], [e0])[:, 0]
            assert np.allclose(got, want, rtol=1e-10, atol=1e-12), (d, share, got / want - 1)
    huge = efron_sums([1e9], [3e9], [1e9])[:, 0]  # as an integral: sums over 10^9 events cost the same
    assert np.allclose(huge[0], np.log(1.5), rtol=1e-8)


def test_a_stored_cox_model_scores_new_rows(spark, tmp_path):
    from keepcurve.operators import cox
    from keepcurve.operators import survival as sv

    rows = [(k, 1 + k * 7 % 40, int(k % 3 == 0), float(k % 5) if k % 4 else None, float(k % 2)) for k in range(200)]
    df = spark.createDataFrame(rows, "key long, t int, e int, a double, b double")
    prep = sv.cox_prep_fit(df, ["a", "b"], binary=["b"], clip={})
    x = sv.cox_prep_transform(df, sv.collect_stats(prep), clip={}, keep=["key", "t", "e"]).cache()
    fit = cox.cox_fit(x, "t", "e", ["a", "b"])
    theta = sv.partial_hazard(x, dict(zip(fit["covariates"], fit["coef"])), None, "theta")
    base = sv.breslow_baseline(theta, "t", "e", "theta")
    cox.save_cox(spark, str(tmp_path / "cox"), cox.cox_summary(spark, fit), prep, base)
    back = cox.load_cox(spark, str(tmp_path / "cox"))
    again = sv.partial_hazard(sv.cox_prep_transform(df, back["stats"], clip={}, keep=["key"]), back["coef"], None, "theta")
    want = {r["key"]: r["theta"] for r in theta.collect()}
    assert {r["key"]: r["theta"] for r in again.collect()} == want
    assert sorted(map(tuple, back["baseline"].collect())) == sorted(map(tuple, base.collect()))


def test_cox_preparation_reads_the_rows_once_after_the_medians(spark):
    rows = [(k, float(k % 5) if k % 3 else None, float(k % 11) if k % 4 else None, None) for k in range(60)]
    df = spark.createDataFrame(rows, "id long, flag double, engagement_momentum double, empty double")
    out = sv.cox_prep_fit(df, ["flag", "engagement_momentum", "empty"], ["flag"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Window" not in plan
    got = {r["covariate"]: r for r in out.collect()}
    v = np.array([r[2] for r in rows if r[2] is not None])
    filled = np.minimum([r[2] if r[2] is not None else np.median(v) for r in rows], 5.0)
    assert set(got) == {"flag", "engagement_momentum"} and got["flag"]["mean"] is None and got["flag"]["median"] == 2.0
    e = got["engagement_momentum"]
    assert e["median"] == np.median(v) and abs(e["mean"] - filled.mean()) < 1e-12 and abs(e["std"] - filled.std(ddof=1)) < 1e-12
    assert sv.cox_prep_fit(df.limit(0), ["flag"], ["flag"]).count() == 0
