"""Distributed isotonic regression against a plain one."""

import numpy as np
import pytest

from keepcurve.operators.isotonic import calibrate_blocks, fit_isotonic_blocks, pool


def plain(score, label, weight):
    """Max-min formula over distinct scores."""
    xs = sorted(set(score))
    w = np.array([weight[score == x].sum() for x in xs])
    t = np.array([(label * weight)[score == x].sum() for x in xs])
    cw, ct = np.r_[0, np.cumsum(w)], np.r_[0, np.cumsum(t)]
    mean = lambda a, b: (ct[b + 1] - ct[a]) / (cw[b + 1] - cw[a])
    return xs, [max(min(mean(a, b) for b in range(i, len(xs))) for a in range(i + 1)) for i in range(len(xs))]


def fitted(blocks, xs):
    rows = sorted(blocks.collect())
    return [next(r["calibrated"] for r in rows if r["lo"] <= x <= r["hi"]) for x in xs]


@pytest.mark.parametrize("group", [1 << 16, 8, 4])
@pytest.mark.parametrize("kind", ["noisy", "falling", "rising", "steps"])
def test_equals_the_max_min_formula(spark, kind, group):
    rng = np.random.default_rng(len(kind))
    s = np.round(rng.random(150), 2)
    y = {"noisy": (rng.random(150) < s).astype(float), "falling": 1 - s, "rising": s * 2, "steps": (s * 10 // 3) % 3 + rng.random(150) / 9}[kind]
    w = rng.integers(1, 4, 150).astype(float)
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(s, y, w)], "score double, label double, w double")
    blocks = fit_isotonic_blocks(df, weight="w", group=group)
    xs, want = plain(s, y, w)
    assert np.allclose(fitted(blocks, xs), want, atol=1e-10)
    got = {r["score"]: r["score2"] for r in calibrate_blocks(blocks, df, out_col="score2").collect()}
    assert np.allclose([got[x] for x in xs], want, atol=1e-10)


def test_between_and_beyond_blocks(spark):
    df = spark.createDataFrame([(0.2, 0.0), (0.4, 0.0), (0.6, 1.0), (0.8, 1.0), (None, 1.0), (0.1, None)], "score double, label double")
    blocks = fit_isotonic_blocks(df)
    ask = spark.createDataFrame([(0.0,), (0.3,), (0.5,), (0.55,), (0.7,), (9.0,), (None,), (0.5,)], "score double")
    got = sorted(((r["score"], r["c"]) for r in calibrate_blocks(blocks, ask, out_col="c").collect()), key=str)
    want = sorted([(0.0, 0.0), (0.3, 0.0), (0.5, 0.5), (0.5, 0.5), (0.55, 0.75), (0.7, 1.0), (9.0, 1.0), (None, None)], key=str)
    assert [a for a, _ in got] == [a for a, _ in want]
    assert all(b is None if d is None else b == pytest.approx(d) for (_, b), (_, d) in zip(got, want))


def test_empty(spark):
    df = spark.createDataFrame([(0.5, None)], "score double, label double")
    blocks = fit_isotonic_blocks(df)
    assert blocks.count() == 0 and calibrate_blocks(blocks, df).first()["score"] is None


def test_pool_merges_equal_means():
    assert pool([1, 2, 3], [1, 2, 3], [1, 1, 2], [1, 1, 1]) == [[1, 3, 4, 3]]
