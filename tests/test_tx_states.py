"""States per delivery give the features of the deduplicated raw transactions."""

import pytest
from pyspark.sql import functions as F

from keepcurve.operators import features as fe
from keepcurve.operators import tx_states as ts
from keepcurve.sources.raw import union_deliveries

CUTOFFS = {"a": "2016-10-01", "b": "2016-12-24", "c": "2017-03-01"}


def transactions(spark, n=4000, members=97):
    pick = lambda k, m: (F.xxhash64("id", F.lit(k)) % m + m).cast("int")
    day = F.date_add(F.lit("2016-08-01").cast("date"), F.abs(F.xxhash64("id") % 200).cast("int"))
    return spark.range(n).select(
        F.when(F.col("id") % 50 != 49, (F.col("id") % members).cast("string")).alias("msno"), F.when(F.col("id") % 7 != 3, F.col("id")).alias("tx_id"),
        pick(2, 5).alias("payment_method_id"), pick(3, 30).alias("payment_plan_days"), F.when(F.col("id") % 11 != 5, pick(4, 40)).alias("plan_list_price"),
        pick(5, 30).alias("actual_amount_paid"), pick(6, 2).alias("is_auto_renew"), F.when(F.col("id") % 31 != 7, day).alias("transaction_date"),
        F.date_add(day, 30).alias("membership_expire_date"), (F.col("id") % 2).cast("int").alias("is_cancel"))


def store(spark, parts, path):
    for k, (name, part) in enumerate(parts.items()):
        ts.write_tx_state(part, path, name, earlier=list(parts)[:k])
    return ts.read_tx_state(spark, path, list(parts))


def rows(df, columns):
    return sorted(map(repr, df.select(columns).collect()))


def test_overlapping_deliveries_equal_the_deduplicated_rows(spark, tmp_path):
    raw = transactions(spark)
    # rows repeat within a delivery, between neighbours and over one between
    parts = {"one": raw.where("tx_id < 2500 OR tx_id IS NULL").unionByName(raw.where("tx_id < 300")), "two": raw.where("tx_id BETWEEN 1500 AND 3000"),
             "three": raw.where("tx_id > 2900 OR tx_id < 100")}
    path = str(tmp_path / "state")
    ts.write_tx_state(raw.limit(50), path, "two")  # a wrong run, replaced below
    got = ts.tx_features_from_state(store(spark, parts, path), CUTOFFS)
    whole = union_deliveries(list(parts.values()), dedup=True)
    for period, cutoff in CUTOFFS.items():
        # rows without an id that agree in date have no order but their fields, so those fields are left out
        want = fe.transaction_features(whole, cutoff)
        columns = [c for c in want.columns if not c.startswith(("last_", "is_auto", "membership_expires"))]
        assert rows(got.where(F.col("period") == period), columns) == rows(want, columns)
    with_id = whole.where("tx_id IS NOT NULL")
    state = ts.tx_state(with_id)
    got = ts.tx_features_from_state(state, CUTOFFS)
    for period, cutoff in CUTOFFS.items():
        want = fe.transaction_features(with_id, cutoff)
        assert rows(got.where(F.col("period") == period), want.columns) == rows(want, want.columns)


def test_cohort_and_empty_state(spark, tmp_path):
    raw = transactions(spark, 2000)
    state = store(spark, {"one": raw.limit(0), "two": raw}, str(tmp_path / "s"))
    cohort = spark.createDataFrame([("a", "3"), ("c", "5")], "period string, msno string")
    got = ts.tx_features_from_state(state, CUTOFFS, cohort=cohort)
    assert {(r["period"], r["msno"]) for r in got.collect()} == {("a", "3"), ("c", "5")}
    empty = ts.tx_state(raw.limit(0))
    assert ts.tx_features_from_state(empty, CUTOFFS).count() == 0 and ts.distinct_plans_estimate(empty, CUTOFFS).count() == 0


@pytest.mark.parametrize("n", [20, 30_000])
def test_error_of_the_plan_sketches_per_window(spark, n):
    """A member of ``n`` prices a fortnight, delivered twice: few are counted
    exactly, many within 5 % (three standard errors) in each window."""
    tx = transactions(spark, n * 14, 1).withColumn("msno", F.lit("hot")).withColumn("plan_list_price", (F.col("payment_plan_days") * 0 + F.xxhash64("tx_id", "membership_expire_date") % n).cast("int"))
    tx = tx.withColumn("transaction_date", F.date_sub(F.lit("2017-03-01").cast("date"), (F.abs(F.hash("tx_id", "is_cancel", "actual_amount_paid")) % 200).cast("int")))
    one = ts.tx_state(tx)
    both = ts.TxState(one.days, one.plans, one.sketches.unionByName(one.sketches))
    got = ts.distinct_plans_estimate(both, {"c": "2017-03-01"}).first()
    for d in fe.LOOKBACK_WINDOWS_DAYS:
        exact = tx.where(f"datediff('2017-03-01', transaction_date) BETWEEN 0 AND {d}").select("plan_list_price").where("plan_list_price IS NOT NULL").distinct().count()
        found = got[f"n_distinct_plans_last_{d}d"]
        assert found == exact if n < 100 else abs(found - exact) <= 0.05 * exact, (d, found, exact)
