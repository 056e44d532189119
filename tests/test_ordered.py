"""Distributed ordered prefix vs pandas brute force (several ranges, a hot
value that spans some of them, NaN, keys with a common prefix)."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from keepcurve.operators.ordered import average_ranks, exact_quantiles, row_prefix, value_prefix


def _frame(seed, n=600):
    rng = np.random.default_rng(seed)
    v = rng.integers(0, 40, n).astype(float)
    v[: n // 3] = 7.0  # a hot tie block holding a third of the rows
    rng.shuffle(v)
    return pd.DataFrame({"key": np.arange(n, dtype=np.int64), "v": v, "m": rng.integers(0, 5, n).astype(float),
                         "g": rng.integers(0, 2, n)})


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("tie", ["key", "skey"])
def test_row_prefix_matches_sorted_cumsum(spark, descending, tie):
    pdf = _frame(1)
    pdf["skey"] = [f"member_{k * 7919 % 1000:03d}|p{k % 2}" for k in pdf["key"]]  # string tie-break
    df = spark.createDataFrame(pdf)
    out = row_prefix(df, "v", tie, {"m": F.col("m")}, ["g"], descending=descending, n_ranges=8).toPandas()
    for g, part in pdf.groupby("g"):
        exp = part.sort_values(["v", tie], ascending=[not descending, True]).reset_index(drop=True)
        exp["rn"] = np.arange(1, len(exp) + 1)
        exp["cum_m"] = exp["m"].cumsum()
        got = out[out["g"] == g].sort_values("rn").reset_index(drop=True)
        assert list(got["key"]) == list(exp["key"])
        assert np.allclose(got["cum_m"], exp["cum_m"])
        assert (got["n_total"] == len(exp)).all()
        assert np.allclose(got["tot_m"], exp["m"].sum())


def test_value_prefix_collapses_ties(spark):
    pdf = _frame(2)
    out = value_prefix(spark.createDataFrame(pdf), "v", {"m": F.col("m")}, n_ranges=8).toPandas()
    exp = pdf.groupby("v").agg(n=("m", "size"), m=("m", "sum")).sort_index()
    exp["n_before"] = exp["n"].cumsum() - exp["n"]
    exp["m_before"] = exp["m"].cumsum() - exp["m"]
    got = out.set_index("v").sort_index()
    assert np.array_equal(got["n"], exp["n"]) and np.array_equal(got["n_before"], exp["n_before"])
    assert np.allclose(got["m_before"], exp["m_before"])


def test_average_ranks_match_pandas(spark):
    pdf = _frame(3)
    pdf.loc[5, "v"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("v", F.when(F.isnan("v"), None).otherwise(F.col("v")))
    got = average_ranks(df, "v", "r", "pct", n_ranges=8).toPandas().set_index("key").sort_index()
    exp_r = pdf["v"].rank(method="average")
    assert got.loc[5, "r"] is None or np.isnan(got.loc[5, "r"])
    mask = pdf["v"].notna().to_numpy()
    assert np.allclose(got["r"].to_numpy()[mask], exp_r.to_numpy()[mask])
    assert np.allclose(got["pct"].to_numpy()[mask], pdf["v"].rank(method="average", pct=True).to_numpy()[mask])


def test_exact_quantiles_linear(spark):
    pdf = _frame(4)
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = exact_quantiles(spark.createDataFrame(pdf), "v", probs, ["g"], n_ranges=8).toPandas()
    for g, part in pdf.groupby("g"):
        exp = np.quantile(part["v"].to_numpy(), probs)
        q = got[got["g"] == g].sort_values("q")["value"].to_numpy()
        assert np.allclose(q, exp)


def test_nan_is_above_every_number_and_null_is_dropped(spark):
    df = spark.createDataFrame([(k, float("nan") if k == 3 else None if k == 4 else float(k)) for k in range(50)], "key long, v double")
    up = {r["key"]: r["rn"] for r in row_prefix(df, "v", "key", n_ranges=5).collect()}
    down = {r["key"]: r["rn"] for r in row_prefix(df, "v", "key", descending=True, n_ranges=5).collect()}
    assert up[3] == 49 and down[3] == 1 and 4 not in up and len(up) == 49


def test_a_hot_value_is_divided_by_its_tie_break(spark):
    df = spark.range(4000).selectExpr("1.0D AS v", "concat('member_', lpad(id, 6, '0')) AS k")
    ranged = df.repartitionByRange(8, "v", "k").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in ranged) < 1500
    assert [r["rn"] for r in row_prefix(df, "v", "k", n_ranges=8).orderBy("k").collect()] == list(range(1, 4001))


def test_null_groups_are_groups(spark):
    df = spark.createDataFrame([(None, 1.0, 1), (None, 2.0, 2), ("a", 1.0, 3)], "g string, v double, k int")
    got = {r["k"]: (r["rn"], r["n_total"]) for r in row_prefix(df, "v", "k", partition_cols=["g"]).collect()}
    assert got == {1: (1, 2), 2: (2, 2), 3: (1, 1)}
