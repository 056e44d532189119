"""Raw CSV sources (S1-S4), delivery union/dedup, the snapshot store (S5,
S6) and an end-to-end snapshot from raw files."""

from pyspark.sql import functions as F

from keepcurve.operators import features as fe
from keepcurve.sources import raw
from keepcurve.sources import snapshots as store


def _csv(path, header, rows):
    path.write_text(header + "\n" + "\n".join(",".join("" if v is None else str(v) for v in r) for r in rows) + "\n")
    return str(path)


TX_HEADER = ("msno,payment_method_id,payment_plan_days,plan_list_price,actual_amount_paid,is_auto_renew,"
             "transaction_date,membership_expire_date,is_cancel")


def test_raw_sources_union_and_dedup(spark, tmp_path):
    v1 = _csv(tmp_path / "tx_v1.csv", TX_HEADER, [("a", 41, 30, 149, 149, 1, 20170101, 20170201, 0),
                                                  ("a", 41, 30, 149, 129, 1, 20170115, 20170215, 0)])
    v2 = _csv(tmp_path / "tx_v2.csv", TX_HEADER, [("a", 41, 30, 149, 129, 1, 20170115, 20170215, 0),
                                                  ("b", 39, 30, 99, 99, 0, 20170120, 20170220, 1)])
    tx = raw.load_transactions(spark, [v1, v2])
    assert tx.count() == 3  # the overlapping row appears once
    assert raw.load_transactions(spark, [v1, v2], dedup=False).count() == 4
    logs1 = _csv(tmp_path / "l1.csv", "msno,date,num_25,num_50,num_75,num_985,num_100,num_unq,total_secs",
                 [("a", 20170110, 1, 0, 0, 0, 3, 2, 100.5)])
    logs2 = _csv(tmp_path / "l2.csv", "msno,date,num_25,num_50,num_75,num_985,num_100,num_unq,total_secs",
                 [("a", 20170210, 1, 0, 0, 0, 1, 1, 50.0)])
    assert raw.load_user_logs(spark, [logs1, logs2]).count() == 2
    members = _csv(tmp_path / "m.csv", "msno,city,bd,gender,registered_via,registration_init_time",
                   [("a", 1, 28, "male", 7, 20160101), ("b", 5, None, None, 9, 20150505)])
    labels = _csv(tmp_path / "lab.csv", "msno,is_churn", [("a", 0), ("b", 1)])
    snap = fe.feature_snapshot(raw.load_labels(spark, labels), raw.load_members(spark, members), tx,
                               raw.load_user_logs(spark, [logs1, logs2]), "2017-01-31", "period1", tie_break=None)
    rows = {r["msno"]: r for r in snap.collect()}
    assert rows["a"]["tenure_days"] == 396 and rows["a"]["last_actual_amount_paid"] == 129
    assert rows["a"]["total_secs_last_30d"] == 100.5  # the February log is after the cutoff
    assert rows["b"]["age_is_valid"] is False and rows["b"]["n_cancellations_lifetime"] == 1


def test_snapshot_store_dynamic_overwrite_and_pruning(spark, tmp_path):
    path = str(tmp_path / "snap")
    df = spark.createDataFrame([("a", 1, "period1"), ("b", 2, "period2")], "msno string, x int, period string")
    store.write_snapshot(df, path)
    # rewriting period2 leaves period1 in place
    store.write_snapshot(spark.createDataFrame([("c", 3, "period2")], "msno string, x int, period string"), path)
    got = sorted((r.msno, r.period) for r in store.read_snapshot(spark, path).collect())
    assert got == [("a", "period1"), ("c", "period2")]
    one = store.read_snapshot(spark, path, "period2")
    assert [r.msno for r in one.collect()] == ["c"]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "period2" in plan


def test_report_csv_sink(spark, tmp_path):
    path = str(tmp_path / "rep")
    store.write_report_csv(spark.createDataFrame([("f", 0.12, "moderate drift")], "feature string, psi double, "
                                                                                  "status string"), path)
    back = spark.read.option("header", True).schema("feature string, psi double, status string").csv(path)
    assert back.collect()[0]["psi"] == 0.12
    assert back.where(F.col("status") == "moderate drift").count() == 1


def test_bad_records_go_to_quarantine(spark, tmp_path):
    header = "msno,date,num_25,num_50,num_75,num_985,num_100,num_unq,total_secs"
    good = [("a", 20170110, 1, 0, 0, 0, 3, 2, 100.5), ("b", 20170111, None, 0, 0, 0, 3, 2, 7)]
    f1 = _csv(tmp_path / "l1.csv", header, [*good, ("c", "not a date", 1, 0, 0, 0, 1, 1, 5)])
    f2 = _csv(tmp_path / "l2.csv", header, [("d", 20170112, 1, 0), ("e", 20170113, 1, 0, 0, 0, 1, 1, 5.0)])
    aside = str(tmp_path / "aside")
    logs = raw.load_user_logs(spark, [f1, f2], quarantine=aside)
    assert sorted(r["msno"] for r in logs.collect()) == ["a", "b", "e"]
    assert logs.columns == header.split(",")
    assert {r["file"].rsplit("/", 1)[-1]: r["n"] for r in raw.quarantined(spark, aside).collect()} == {"l1.csv": 1, "l2.csv": 1}
    assert sorted(r["record"][0] for r in spark.read.parquet(aside).collect()) == ["c", "d"]
    assert raw.load_user_logs(spark, [f1, f2]).count() == 5  # as before: fields that do not parse are null


def test_deliveries_dealt_by_member_shuffle_once(spark):
    """Dedup and member aggregates of rows dealt out by the member add no shuffle; rows are those of the plain union but for null members."""
    from keepcurve.sources.raw import union_deliveries

    a = spark.createDataFrame([(1, 5), (1, 5), (2, 7), (None, 1)], "msno long, v int")
    b = spark.createDataFrame([(1, 5), (3, 9), (None, 1)], "msno long, v int")
    dealt, plain = union_deliveries([a, b], True, by="msno"), union_deliveries([a, b], True)
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, plain.where("msno IS NOT NULL").collect())) == [(1, 5), (2, 7), (3, 9)]
    tags = F.explode(F.array(F.lit("x"), F.lit("y"))).alias("period")
    out = dealt.select("*", tags).groupBy("period", "msno").agg(F.sum("v").alias("s"))
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert sorted(map(tuple, out.where("period = 'x'").select("msno", "s").collect())) == [(1, 5), (2, 7), (3, 9)]
