"""Sketch PSI: equal to the exact report while exact, inside its interval beyond."""

import pytest
from pyspark.sql import functions as F

from keepcurve.operators import drift as dr
from keepcurve.operators import drift_sketch as ds

FEATURES = ["same", "moved", "ties", "constant", "empty", "outside"]


def sides(spark, n):
    base = spark.range(n).select(
        (F.xxhash64("id") % 1000 / 8.0).alias("same"), (F.xxhash64("id", F.lit(1)) % 1000 / 8.0).alias("moved"),
        (F.xxhash64("id", F.lit(2)) % 4).alias("ties"), F.lit(3).alias("constant"), F.lit(None).cast("double").alias("empty"),
        F.when(F.col("id") % 7 == 0, F.lit(float("nan"))).otherwise(F.xxhash64("id", F.lit(3)) % 500 / 1.0).alias("outside"))
    cur = spark.range(n, 2 * n).select(
        (F.xxhash64("id") % 1000 / 8.0).alias("same"), (F.xxhash64("id", F.lit(1)) % 800 / 8.0 + 15).alias("moved"),
        (F.xxhash64("id", F.lit(2)) % 3).alias("ties"), F.lit(3).alias("constant"), F.lit(1.0).alias("empty"),
        (F.xxhash64("id", F.lit(3)) % 700 / 1.0).alias("outside"))
    return base, cur


def reports(spark, n, k):
    ref, cur = sides(spark, n)
    halves = [ds.feature_sketches(df.withColumn("half", F.spark_partition_id() % 2), FEATURES, ["half"], k) for df in (ref, cur)]
    got = {r["feature"]: r for r in ds.drift_report_from_sketches(*[ds.merge_sketches(h, k=k) for h in halves], k=k).collect()}
    return got, {r["feature"]: r for r in dr.drift_report(ref, cur, FEATURES).collect()}


def test_equals_the_exact_report_below_k(spark):
    got, want = reports(spark, 3000, 4096)
    assert set(got) == set(want)
    for f in FEATURES:
        assert got[f]["status"] == want[f]["status"]
        assert got[f]["psi"] == pytest.approx(want[f]["psi"]) if want[f]["psi"] is not None else got[f]["psi"] is None
        assert got[f]["psi_low"] == got[f]["psi_high"] == got[f]["psi"]


def test_exact_value_lies_in_the_interval_beyond_k(spark):
    got, want = reports(spark, 60_000, 512)
    for f in ("same", "moved", "ties", "outside"):
        assert got[f]["psi_low"] <= want[f]["psi"] <= got[f]["psi_high"], (f, got[f], want[f])
        assert got[f]["psi"] == pytest.approx(want[f]["psi"], abs=0.02)
    assert got["same"]["psi_high"] < 0.3 and got["moved"]["psi_low"] > 0.1  # the interval at k = 512; it narrows as 1 / k


def test_open_ends_count_values_outside(spark):
    ref, cur = sides(spark, 2000)
    a, b = ds.feature_sketches(ref, ["outside"]), ds.feature_sketches(cur, ["outside"])
    closed, opened = [ds.psi_from_sketches(a, b, open_ended=o).first()["psi"] for o in (False, True)]
    assert opened > closed
    assert ds.psi_from_sketches(a, a, open_ended=True).first()["psi"] == pytest.approx(0.0)
