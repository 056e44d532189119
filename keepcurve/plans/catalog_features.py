"""Queries: feature snapshot stage (sources, filters, joins, aggregates)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keepcurve.operators import features as fe
from keepcurve.operators import log_states as ls
from keepcurve.operators import tx_states as ts
from keepcurve.plans.oracle_sql import (
    log_daily_sql,
    log_features_sql,
    member_features_sql,
    snapshot_ctes,
    tx_asof_sql,
    tx_latest_sql,
    tx_window_sql,
)
from keepcurve.plans.registry import query
from keepcurve.sources import raw
from keepcurve.session import ensure_checkpoint_dir
from keepcurve.sources import testdata as td

C1, C2 = td.CUTOFFS["period1"], td.CUTOFFS["period2"]

SNAPSHOT_DOUBLES = (["avg_discount_lifetime"] + [f"total_secs_last_{d}d" for d in fe.LOOKBACK_WINDOWS_DAYS]
                    + ["completion_ratio", "engagement_momentum"])


def round_replace(cols) -> str:
    return "* REPLACE (" + ", ".join(f"round({c}, 6) AS {c}" for c in cols) + ")"


def with_period(period: str) -> str:
    return "WITH " + td.role_sql(period)


def with_both() -> str:
    return ("WITH " + td.role_sql() + "," + td.period_sql("period1", "p1") + "," + td.period_sql("period2", "p2")
            + snapshot_ctes("period1", C1, "1") + snapshot_ctes("period2", C2, "2"))


# ---------------------------------------------------------------- role data

def transactions(spark: SparkSession, sf_dir: str, period: str, by: str | None = None) -> DataFrame:
    """S3: v1 alone for period1, v1 + v2 for period2, deduplicated in both."""
    parts = td.transaction_deliveries(spark, sf_dir)
    return raw.union_deliveries(parts[:1] if period == "period1" else parts, dedup=True, by=by)


def user_logs(spark: SparkSession, sf_dir: str, period: str, by: str | None = None) -> DataFrame:
    """v1 alone for period1, v1 + v2 (disjoint dates, no dedup) for period2."""
    parts = td.log_deliveries(spark, sf_dir)
    return raw.union_deliveries(parts[:1] if period == "period1" else parts, dedup=False, by=by)


def snapshot(spark: SparkSession, sf_dir: str, period: str) -> DataFrame:
    cutoff = td.CUTOFFS[period]
    return fe.feature_snapshot(td.labels(spark, sf_dir, period), td.members(spark, sf_dir),
                               transactions(spark, sf_dir, period, "msno"), user_logs(spark, sf_dir, period, "msno"),
                               cutoff, period)


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both periods pooled (U3): the input of survival, LTV and drift.

    Built in one pass per source (``feature_snapshots``): the period2
    deliveries hold every row the period1 snapshot reads (the v2 deliveries
    start after the period1 cutoff, and orders carry a unique id, so the
    dedup of v1 + v2 changes nothing for period1)."""
    lab = None
    for p in td.CUTOFFS:
        part = td.labels(spark, sf_dir, p).withColumn("period", F.lit(p))
        lab = part if lab is None else lab.unionByName(part)
    return fe.feature_snapshots(lab, td.members(spark, sf_dir), transactions(spark, sf_dir, "period2", "msno"),
                                user_logs(spark, sf_dir, "period2", "msno"), td.CUTOFFS)


# ------------------------------------------------------------------ queries

@query("member_features", f"{with_period('period1')} {member_features_sql(C1)}")
def q_member_features(spark, sf_dir):
    """P1-P5 over every customer at the period1 cutoff."""
    return fe.member_features(td.members(spark, sf_dir), C1)


@query("asof_cutoff_filter", f"""{with_period('period2')}
SELECT msno, tx_id, transaction_date, days_before_cutoff FROM ({tx_asof_sql(C2)})""")
def q_asof_cutoff_filter(spark, sf_dir):
    """P6 + P7: transactions visible at the period2 cutoff."""
    t = fe.asof_filter(transactions(spark, sf_dir, "period2"), "transaction_date", C2)
    return t.select("msno", "tx_id", "transaction_date", "days_before_cutoff")


@query("tx_latest_state", f"""{with_period('period2')}, tx_asof AS ({tx_asof_sql(C2)})
{tx_latest_sql(C2)}""")
def q_tx_latest_state(spark, sf_dir):
    """W1 + P7 + P8: latest transaction per member (date, then id)."""
    return fe.latest_transaction(transactions(spark, sf_dir, "period2"), C2)


@query("tx_window_features", f"""{with_period('period2')}, tx_asof AS ({tx_asof_sql(C2)})
{tx_window_sql(rounded=True)}""")
def q_tx_window_features(spark, sf_dir):
    """Windowed counts, distinct plans, lifetime aggregates."""
    return fe.transaction_window_features(transactions(spark, sf_dir, "period2"), C2)


@query("tx_features", f"""{with_period('period2')}, tx_asof AS ({tx_asof_sql(C2)}),
tx_latest AS ({tx_latest_sql(C2)}), tx_win AS ({tx_window_sql()})
SELECT {round_replace(['avg_discount_lifetime'])} FROM tx_latest JOIN tx_win USING (msno)""")
def q_tx_features(spark, sf_dir):
    """J3 removed: latest state + windows from one aggregate."""
    return fe.transaction_features(transactions(spark, sf_dir, "period2"), C2)


@query("tx_union_dedup", f"""WITH {td.role_sql()}
SELECT DISTINCT * FROM (SELECT * FROM tx_v1 UNION ALL SELECT * FROM tx_v2)""")
def q_tx_union_dedup(spark, sf_dir):
    """S3 + U1 + U2: overlapping deliveries unioned by name, full-row dedup."""
    return raw.union_deliveries(td.transaction_deliveries(spark, sf_dir), dedup=True)


@query("log_union", f"""WITH {td.role_sql()}
SELECT * FROM logs_v1 UNION ALL SELECT * FROM logs_v2""")
def q_log_union(spark, sf_dir):
    """S4 + U1: disjoint log deliveries, union without dedup."""
    return raw.union_deliveries(td.log_deliveries(spark, sf_dir), dedup=False)


@query("log_cohort_filter", f"""{with_period('period1')}
SELECT {round_replace(['total_secs'])} FROM ({log_daily_sql(C1, 'logs_p', 'labels_p')})""")
def q_log_cohort_filter(spark, sf_dir):
    """period1 logs restricted to the labelled cohort (day-level rows)."""
    daily = fe.daily_activity(user_logs(spark, sf_dir, "period1"), C1)
    out = daily.join(td.labels(spark, sf_dir, "period1").select("msno"), "msno", "left_semi")
    return out.withColumnRenamed("days_before_cutoff", "dbc")


def _log_feature_query(cols: list[str]) -> str:
    sel = ", ".join(["msno"] + cols)
    return f"""{with_period('period2')}, log_daily AS ({log_daily_sql(C2)}),
log_f AS ({log_features_sql(rounded=True)})
SELECT {sel} FROM log_f"""


def _log_features(spark, sf_dir):
    return fe.user_log_features(user_logs(spark, sf_dir, "period2"), C2,
                                cohort=td.labels(spark, sf_dir, "period2").select("msno"))


W = fe.LOOKBACK_WINDOWS_DAYS
WINDOW_SUM_COLS = [f"{m}_last_{d}d" for d in W for m in ("total_secs", "num_100", "num_unq")]
ACTIVE_COLS = [f"active_days_last_{d}d" for d in W]
RATIO_COLS = ["num_25_lifetime", "num_50_lifetime", "num_75_lifetime", "num_985_lifetime",
              "num_100_lifetime", "completion_ratio"]
MOMENTUM_COLS = ["total_secs_last_30d", "engagement_momentum"]


@query("log_window_sums", _log_feature_query(WINDOW_SUM_COLS))
def q_log_window_sums(spark, sf_dir):
    """A1: conditional window sums, all windows in one aggregate."""
    return _log_features(spark, sf_dir).select("msno", *WINDOW_SUM_COLS)


@query("log_active_days", _log_feature_query(ACTIVE_COLS + ["days_since_last_log"]))
def q_log_active_days(spark, sf_dir):
    """A3: distinct active days per window via day-level pre-aggregation."""
    return _log_features(spark, sf_dir).select("msno", *ACTIVE_COLS, "days_since_last_log")


@query("log_completion_ratio", _log_feature_query(RATIO_COLS))
def q_log_completion_ratio(spark, sf_dir):
    """P10: guarded completion ratio."""
    return _log_features(spark, sf_dir).select("msno", *RATIO_COLS)


@query("log_engagement_momentum", _log_feature_query(MOMENTUM_COLS))
def q_log_engagement_momentum(spark, sf_dir):
    """Last-30-day vs prior-30-day seconds, folded into the same aggregate."""
    return _log_features(spark, sf_dir).select("msno", *MOMENTUM_COLS)


@query("log_features", _log_feature_query(["*"]).replace("SELECT msno, * FROM", "SELECT * FROM"))
def q_log_features(spark, sf_dir):
    """A5 + J4 removed: every log feature from one member aggregate."""
    return _log_features(spark, sf_dir)


@query("feature_snapshot", f"""{with_both()}
SELECT {round_replace(SNAPSHOT_DOUBLES)} FROM (SELECT * FROM snap1 UNION ALL SELECT * FROM snap2)""")
def q_feature_snapshot(spark, sf_dir):
    """J5 + P12: the full snapshot, both periods."""
    return snapshots(spark, sf_dir)


@query("churn_rate_by_period", f"""{with_both()}
SELECT period, count(*) AS n_members, CAST(sum(is_churn) AS BIGINT) AS n_churn,
       round(avg(is_churn), 6) AS churn_rate
FROM (SELECT period, is_churn FROM snap1 UNION ALL SELECT period, is_churn FROM snap2) GROUP BY period""")
def q_churn_rate_by_period(spark, sf_dir):
    """Population and churn rate per period, one aggregate."""
    s = snapshots(spark, sf_dir)
    return s.groupBy("period").agg(F.count(F.lit(1)).alias("n_members"),
                                   F.sum("is_churn").cast("long").alias("n_churn"),
                                   F.avg("is_churn").alias("churn_rate"))


STATE_CUTOFFS = {"period1": C1, "between": "1999-12-31", "period2": C2}


@query("log_features_from_state", "WITH " + td.role_sql() + "".join(
    f",\nlog_daily_{k} AS ({log_daily_sql(c, 'logs_all', None)}), log_f_{k} AS ({log_features_sql(f'log_daily_{k}', rounded=True)})"
    for k, c in enumerate(STATE_CUTOFFS.values())) + "\n" + "\nUNION ALL ".join(
    f"SELECT '{p}' AS period, * FROM log_f_{k}" for k, p in enumerate(STATE_CUTOFFS)))
def q_log_features_from_state(spark, sf_dir):
    """Log features at three cutoffs from the stored states of
    two deliveries, written and read again."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/log_state-{uuid.uuid4().hex}"
    for name, part in zip(("v1", "v2"), td.log_deliveries(spark, sf_dir)):
        ls.write_log_state(part, path, name)
    return ls.log_features_from_state(ls.read_log_state(spark, path), STATE_CUTOFFS)


def _tx_state(spark, sf_dir) -> ts.TxState:
    """The stored states of two overlapping deliveries, read again."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/tx_state-{uuid.uuid4().hex}"
    v1, v2 = td.transaction_deliveries(spark, sf_dir)
    ts.write_tx_state(v1, path, "v1")
    ts.write_tx_state(v2, path, "v2", earlier=["v1"])
    return ts.read_tx_state(spark, path, ["v1", "v2"])


def _tx_at(k: int, cutoff: str) -> str:
    return f",\ntx_asof_{k} AS ({tx_asof_sql(cutoff, 'tx_dedup')})"


TX_DEDUP = "WITH " + td.role_sql() + ",\ntx_dedup AS (SELECT DISTINCT * FROM (SELECT * FROM tx_v1 UNION ALL SELECT * FROM tx_v2))" + "".join(
    _tx_at(k, c) for k, c in enumerate(STATE_CUTOFFS.values()))


@query("tx_features_from_state", TX_DEDUP + "".join(
    f",\ntx_latest_{k} AS ({tx_latest_sql(c, f'tx_asof_{k}')}), tx_win_{k} AS ({tx_window_sql(f'tx_asof_{k}', rounded=True)})"
    for k, c in enumerate(STATE_CUTOFFS.values())) + "\n" + "\nUNION ALL ".join(
    f"SELECT '{p}' AS period, * FROM tx_latest_{k} JOIN tx_win_{k} USING (msno)" for k, p in enumerate(STATE_CUTOFFS)))
def q_tx_features_from_state(spark, sf_dir):
    """Transaction features at three cutoffs from
    the stored states of two overlapping deliveries."""
    out = ts.tx_features_from_state(_tx_state(spark, sf_dir), STATE_CUTOFFS)
    return out.withColumn("avg_discount_lifetime", F.round("avg_discount_lifetime", 6))


def _plan_counts(k: int, period: str) -> str:
    counts = ", ".join(f"count(DISTINCT CASE WHEN days_before_cutoff <= {d} THEN plan_list_price END) AS n_distinct_plans_last_{d}d" for d in W)
    return f"SELECT '{period}' AS period, msno, {counts} FROM tx_asof_{k} WHERE plan_list_price IS NOT NULL GROUP BY msno"


@query("distinct_plans_sketch", TX_DEDUP + "\n" + "\nUNION ALL ".join(_plan_counts(k, p) for k, p in enumerate(STATE_CUTOFFS)))
def q_distinct_plans_sketch(spark, sf_dir):
    """A4, approximate: distinct plans of every window from merged sketches;
    a member's few plans at the test scale are counted exactly."""
    return ts.distinct_plans_estimate(_tx_state(spark, sf_dir), STATE_CUTOFFS)
