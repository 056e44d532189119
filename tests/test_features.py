"""Feature snapshot cases on hand-built rows (cutoff 2017-01-31)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from keepcurve.operators import features as fe

CUTOFF = "2017-01-31"
MEMBERS = "msno string, city int, bd int, gender string, registered_via int, registration_init_time int"
TX = ("msno string, payment_method_id int, payment_plan_days int, plan_list_price int, actual_amount_paid int, "
      "is_auto_renew int, transaction_date int, membership_expire_date int, is_cancel int, tx_id long")
LOGS = ("msno string, date int, num_25 int, num_50 int, num_75 int, num_985 int, num_100 int, num_unq int, "
        "total_secs double")


def ymd(days_back: int) -> int:
    d = dt.date(2017, 1, 31) - dt.timedelta(days=days_back)
    return int(d.strftime("%Y%m%d"))


def test_member_age_cleaning(spark):
    rows = [("a", 1, 28, "male", 7, 20150101), ("b", 1, -7000, "female", 7, 20150101),
            ("c", 1, 0, None, 7, 20150101), ("d", 1, 150, "male", 7, 20150101),
            ("e", 1, None, "female", 7, 20150101)]
    out = {r["msno"]: r for r in fe.member_features(spark.createDataFrame(rows, MEMBERS), CUTOFF).collect()}
    assert out["a"]["age"] == 28 and out["a"]["age_is_valid"] is True
    for k in "bcde":
        assert out[k]["age"] is None
        assert out[k]["age_is_valid"] is False
    assert [out[k]["gender_male"] for k in "abc"] == [1, 0, None]


def test_member_tenure_days(spark):
    df = spark.createDataFrame([("a", 1, 30, "male", 7, 20160101)], MEMBERS)
    assert fe.member_features(df, CUTOFF).first()["tenure_days"] == 396


def test_transactions_after_cutoff_are_excluded(spark):
    rows = [("a", 41, 30, 149, 149, 1, 20170115, 20170215, 0, 1),
            ("a", 41, 30, 149, 149, 1, 20170210, 20170310, 0, 2)]
    r = fe.transaction_features(spark.createDataFrame(rows, TX), CUTOFF).first()
    assert r["n_transactions_lifetime"] == 1
    assert r["days_since_last_transaction"] == 16


def test_transactions_most_recent_and_windows(spark):
    rows = [("a", 30, 30, 100, 90, 0, ymd(164), 20160901, 0, 1),
            ("a", 31, 30, 150, 140, 0, ymd(47), 20161231, 1, 2),
            ("a", 32, 90, 150, 140, 1, ymd(6), 20170301, 0, 3)]
    r = fe.transaction_features(spark.createDataFrame(rows, TX), CUTOFF).first()
    assert (r["n_transactions_last_7d"], r["n_transactions_last_90d"], r["n_transactions_last_180d"]) == (1, 2, 3)
    assert r["last_payment_method_id"] == 32 and r["last_payment_plan_days"] == 90 and r["is_auto_renew"] == 1
    assert r["days_since_last_transaction"] == 6
    assert r["membership_expires_in_days"] == 29
    assert r["n_distinct_plans_last_180d"] == 2
    assert r["avg_discount_lifetime"] == pytest.approx(10.0)
    assert r["n_cancellations_lifetime"] == 1


def test_latest_transaction_same_day_tie_break(spark):
    rows = [("a", 1, 30, 100, 100, 0, 20170120, 20170220, 0, 5),
            ("a", 2, 30, 100, 100, 1, 20170120, 20170220, 0, 9)]
    r = fe.latest_transaction(spark.createDataFrame(rows, TX), CUTOFF).first()
    assert r["last_payment_method_id"] == 2  # highest tie-break id wins


def test_user_logs_filters_to_sampled_cohort(spark):
    logs = spark.createDataFrame([("in", ymd(3), 1, 1, 1, 1, 1, 1, 10.0),
                                  ("out", ymd(3), 1, 1, 1, 1, 1, 1, 10.0)], LOGS)
    cohort = spark.createDataFrame([("in",)], "msno string")
    got = [r["msno"] for r in fe.user_log_features(logs, CUTOFF, cohort=cohort).collect()]
    assert got == ["in"]


def test_user_logs_completion_ratio_and_momentum(spark):
    logs = spark.createDataFrame([("a", ymd(47), 2, 2, 2, 2, 2, 5, 100.0),
                                  ("a", ymd(6), 2, 2, 2, 2, 18, 5, 200.0),
                                  ("a", ymd(-3), 9, 9, 9, 9, 9, 9, 999.0)], LOGS)
    r = fe.user_log_features(logs, CUTOFF).first()
    assert r["completion_ratio"] == pytest.approx(20 / 36)
    assert r["engagement_momentum"] == pytest.approx(2.0)
    assert r["active_days_last_7d"] == 1 and r["active_days_last_90d"] == 2
    assert r["days_since_last_log"] == 6
    assert r["total_secs_last_30d"] == pytest.approx(200.0)


def test_window_boundary_keeps_day_d(spark):
    # `<= d` keeps days 0..d: a row exactly 7 days back is inside the 7-day window.
    logs = spark.createDataFrame([("a", ymd(7), 1, 0, 0, 0, 1, 1, 5.0), ("a", ymd(8), 1, 0, 0, 0, 1, 1, 7.0)], LOGS)
    r = fe.user_log_features(logs, CUTOFF).first()
    assert r["total_secs_last_7d"] == pytest.approx(5.0)
    assert r["active_days_last_7d"] == 1


def test_post_cutoff_rows_change_nothing(spark):
    base = [("a", 30, 30, 100, 90, 0, ymd(20), 20170301, 0, 1)]
    late = base + [("a", 99, 7, 999, 1, 1, ymd(-1), 20180101, 1, 2)]
    f1 = fe.transaction_features(spark.createDataFrame(base, TX), CUTOFF).first().asDict()
    f2 = fe.transaction_features(spark.createDataFrame(late, TX), CUTOFF).first().asDict()
    assert f1 == f2


def test_multi_cutoff_snapshot_equals_per_period(spark):
    members = spark.createDataFrame([("a", 1, 30, "male", 7, 20150101), ("b", 2, 40, "female", 3, 20160601)],
                                    MEMBERS)
    tx = spark.createDataFrame([("a", 30, 30, 100, 90, 0, 20161201, 20170101, 0, 1),
                                ("a", 31, 30, 150, 140, 1, 20170120, 20170220, 1, 2),
                                ("b", 32, 90, 150, 140, 1, 20170215, 20170515, 0, 3),
                                ("b", 33, 30, 120, 100, 0, 20161115, 20161215, 0, 4)], TX)
    logs = spark.createDataFrame([("a", ymd(3), 1, 2, 3, 4, 5, 6, 70.0), ("a", ymd(40), 1, 0, 0, 0, 9, 2, 30.0),
                                  ("b", ymd(-20), 2, 2, 2, 2, 2, 2, 10.0), ("b", ymd(100), 0, 0, 0, 0, 1, 1, 5.0)],
                                 LOGS)
    cutoffs = {"p1": "2017-01-31", "p2": "2017-02-28"}
    labels = {"p1": spark.createDataFrame([("a", 0), ("b", 1)], "msno string, is_churn int"),
              "p2": spark.createDataFrame([("b", 0)], "msno string, is_churn int")}
    per = None
    for p, c in cutoffs.items():
        one = fe.feature_snapshot(labels[p], members, tx, logs, c, p)
        per = one if per is None else per.unionByName(one)
    lab = labels["p1"].withColumn("period", F.lit("p1")).unionByName(labels["p2"].withColumn("period", F.lit("p2")))
    multi = fe.feature_snapshots(lab, members, tx, logs, cutoffs)
    assert sorted(multi.columns) == sorted(per.columns)
    cols = sorted(per.columns)
    key = lambda r: (r["period"], r["msno"])
    assert sorted(multi.select(cols).collect(), key=key) == sorted(per.select(cols).collect(), key=key)


def test_latest_transaction_with_null_tie_break(spark):
    rows = [("a", 1, 30, 100, 100, 0, 20170101, 20170201, 0, 1), ("a", 2, 30, 100, 100, 0, 20170120, 20170220, 0, None),
            ("b", 3, 30, 100, 100, 0, 20170105, 20170205, 0, None), ("b", 4, 30, 100, 100, 0, 20170110, 20170210, 0, None),
            ("c", 5, 30, 100, 100, 0, 20170110, 20170210, 0, None), ("c", 6, 30, 100, 100, 0, 20170110, 20170210, 0, -2 ** 63)]
    tx = spark.createDataFrame(rows, TX)
    want = {"a": (2, 11), "b": (4, 21), "c": (6, 21)}  # date first; a null id comes before any other of its day
    for f in (fe.latest_transaction, fe.transaction_features):
        got = {r["msno"]: (r["last_payment_method_id"], r["days_since_last_transaction"]) for r in f(tx, CUTOFF).collect()}
        assert got == want


def test_cohort_rows_go_before_the_aggregate(spark):
    logs = spark.range(40_000).selectExpr("cast(id % 2000 AS string) AS msno", "20170110 AS date", *[f"1 AS {c}" for c in (*fe.PLAY_COLUMNS, "num_unq")],
                                          "1.0D AS total_secs")
    cohort = spark.range(500).selectExpr("cast(id * 4 AS string) AS msno")
    rows = fe._may_be_in(logs, cohort, ["msno"])
    assert 10_000 <= rows.count() <= 10_400  # a quarter, and the few that share a bit
    plan = fe.user_log_features(logs, CUTOFF, cohort=cohort)._jdf.queryExecution().optimizedPlan().toString()
    top = plan.index("Join LeftSemi")
    assert top < plan.index("Aggregate") < plan.index("Join Inner", top)  # exact join, aggregate, bitmap below it
    assert {r["msno"] for r in fe.user_log_features(logs, CUTOFF, cohort=cohort).select("msno").collect()} == {str(4 * k) for k in range(500)}


def test_distinct_plans_count_prices_inside_the_window_only(spark):
    def row(who, price, back, k):
        return (who, 30, 30, price, 90, 0, ymd(back), 20170301, 0, k)

    rows = [row("a", p, back, k) for k, (p, back) in enumerate([(100, 0), (100, 180), (150, 180), (200, 181), (None, 3), (300, -1)])]
    rows += [row("b", 100, 181, 50), row("c", None, 2, 51), row(None, 100, 5, 52), row(None, 120, 6, 53)]
    df = spark.createDataFrame(rows, TX)
    for f in (fe.transaction_features, fe.transaction_window_features):
        got = {r["msno"]: (r["n_distinct_plans_last_180d"], r["n_transactions_lifetime"]) for r in f(df, CUTOFF).collect()}
        assert got == {"a": (2, 5), "b": (0, 1), "c": (0, 1), None: (2, 2)}
    plan = fe.transaction_features(df, CUTOFF)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "Join" not in plan and "SortAggregate" not in plan
