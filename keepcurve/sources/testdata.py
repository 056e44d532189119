"""Binding of the driver's TPC-H-like test tables to the retention roles.

The library operators work on the role schemas of the original pipeline
(members, transactions, user logs, labels).  This module derives those role
tables from ``customer``, ``orders``, ``lineitem`` and ``nation`` with plain
column expressions, so every query reads the given tables and its work
grows with them.  ``role_sql`` holds the same derivations as SQL text for
the DuckDB oracle; the two must stay in step.

Fixed values of the binding (chosen here, documented in README):
  cutoffs: period1 = 1999-06-30, period2 = 2000-06-30
  churn label: no order in (cutoff, cutoff + 365 days]; population = first
  order on or before the cutoff
  transaction deliveries: v1 = orders up to 2000-03-31, v2 = orders from
  2000-01-01 (one overlapping quarter, removed by dedup)
  log deliveries: v1 = ship dates up to 1999-12-31, v2 = later (disjoint)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keepcurve.session import sf_path

CUTOFFS = {"period1": "1999-06-30", "period2": "2000-06-30"}
LABEL_HORIZON_DAYS = 365
TX_V1_END = "2000-03-31"
TX_V2_START = "2000-01-01"
LOG_V1_END = "1999-12-31"


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(sf_path(sf_dir, name))


# ---------------------------------------------------------------- Spark side

def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Member role: one row per customer; registration = first order date."""
    c = _t(spark, sf_dir, "customer")
    n = _t(spark, sf_dir, "nation")
    first = (_t(spark, sf_dir, "orders")
             .groupBy("o_custkey")
             .agg(F.min(F.col("o_orderdate").cast("date")).alias("registration_date")))
    return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
             .join(first, c.c_custkey == first.o_custkey, "left")
             .select(F.col("c_custkey").alias("msno"),
                     F.col("c_nationkey").cast("int").alias("city"),
                     F.floor(F.col("c_acctbal") / 100).cast("int").alias("bd"),
                     F.when(F.col("c_mktsegment") == "AUTOMOBILE", "male")
                      .when(F.col("c_mktsegment") == "BUILDING", "female")
                      .when(F.col("c_mktsegment") == "FURNITURE", "unknown").alias("gender"),
                     F.col("n_regionkey").cast("int").alias("registered_via"),
                     "registration_date"))


def transactions_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _t(spark, sf_dir, "orders")
    pm = F.substring("o_orderpriority", 1, 1).cast("int")
    d = F.col("o_orderdate").cast("date")
    plan_days = (F.lit(30) * (F.lit(5) - pm)).cast("int")
    return o.select(
        F.col("o_custkey").alias("msno"),
        F.col("o_orderkey").alias("tx_id"),
        pm.alias("payment_method_id"),
        plan_days.alias("payment_plan_days"),
        F.floor(F.col("o_totalprice") / 100).cast("int").alias("plan_list_price"),
        F.floor(F.col("o_totalprice") / 110).cast("int").alias("actual_amount_paid"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("is_auto_renew"),
        d.alias("transaction_date"),
        F.date_add(d, plan_days).alias("membership_expire_date"),
        F.when(F.col("o_orderstatus") == "P", 1).otherwise(0).alias("is_cancel"),
    )


def transaction_deliveries(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    tx = transactions_all(spark, sf_dir)
    return [tx.where(F.col("transaction_date") <= F.lit(TX_V1_END).cast("date")),
            tx.where(F.col("transaction_date") >= F.lit(TX_V2_START).cast("date"))]


def user_logs_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _t(spark, sf_dir, "lineitem")
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    qty = F.col("l_quantity").cast("int")
    # an order's row is narrow and its lines are many, so the orders of a partition are hashed and no side is sorted
    return (li.join(o.hint("shuffle_hash"), li.l_orderkey == o.o_orderkey)
              .select(F.col("o_custkey").alias("msno"),
                      F.col("l_shipdate").cast("date").alias("log_date"),
                      F.when(F.col("l_returnflag") == "R", qty).otherwise(0).alias("num_25"),
                      F.when(F.col("l_returnflag") == "A", qty).otherwise(0).alias("num_50"),
                      F.round(F.col("l_discount") * 100).cast("int").alias("num_75"),
                      F.round(F.col("l_tax") * 100).cast("int").alias("num_985"),
                      F.when(F.col("l_returnflag") == "N", qty).otherwise(0).alias("num_100"),
                      F.col("l_linenumber").cast("int").alias("num_unq"),
                      F.col("l_extendedprice").alias("total_secs")))


def log_deliveries(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    logs = user_logs_all(spark, sf_dir)
    end = F.lit(LOG_V1_END).cast("date")
    return [logs.where(F.col("log_date") <= end), logs.where(F.col("log_date") > end)]


def labels(spark: SparkSession, sf_dir: str, period: str) -> DataFrame:
    """Label role: population = first order <= cutoff; churn = no order in
    the following ``LABEL_HORIZON_DAYS`` days.  One partial+final aggregate."""
    cutoff = F.lit(CUTOFFS[period]).cast("date")
    d = F.col("o_orderdate").cast("date")
    return (_t(spark, sf_dir, "orders")
            .groupBy("o_custkey")
            .agg(F.min(d).alias("_first"),
                 F.count_if((d > cutoff) & (d <= F.date_add(cutoff, LABEL_HORIZON_DAYS))).alias("_future"))
            .where(F.col("_first") <= cutoff)
            .select(F.col("o_custkey").alias("msno"),
                    F.when(F.col("_future") == 0, 1).otherwise(0).alias("is_churn")))


# ----------------------------------------------------------------- SQL side

def role_sql(period: str | None = None) -> str:
    """``WITH`` body (no leading WITH) defining the role tables in SQL.

    Defines members, tx_all, tx_v1, tx_v2, logs_all, logs_v1, logs_v2 and,
    for a period, labels_p, tx_p and logs_p.
    """
    pm = "CAST(substr(o_orderpriority, 1, 1) AS INTEGER)"
    parts = [f"""
members AS (
  SELECT c.c_custkey AS msno, CAST(c.c_nationkey AS INTEGER) AS city,
         CAST(floor(c.c_acctbal / 100) AS INTEGER) AS bd,
         CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'male' WHEN 'BUILDING' THEN 'female'
              WHEN 'FURNITURE' THEN 'unknown' END AS gender,
         CAST(n.n_regionkey AS INTEGER) AS registered_via, f.registration_date
  FROM customer c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS registration_date
             FROM orders GROUP BY o_custkey) f ON c.c_custkey = f.o_custkey
),
tx_all AS (
  SELECT o_custkey AS msno, o_orderkey AS tx_id, {pm} AS payment_method_id,
         CAST(30 * (5 - {pm}) AS INTEGER) AS payment_plan_days,
         CAST(floor(o_totalprice / 100) AS INTEGER) AS plan_list_price,
         CAST(floor(o_totalprice / 110) AS INTEGER) AS actual_amount_paid,
         CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_auto_renew,
         CAST(o_orderdate AS DATE) AS transaction_date,
         CAST(o_orderdate AS DATE) + CAST(30 * (5 - {pm}) AS INTEGER) AS membership_expire_date,
         CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS is_cancel
  FROM orders
),
tx_v1 AS (SELECT * FROM tx_all WHERE transaction_date <= DATE '{TX_V1_END}'),
tx_v2 AS (SELECT * FROM tx_all WHERE transaction_date >= DATE '{TX_V2_START}'),
logs_all AS (
  SELECT o.o_custkey AS msno, CAST(l.l_shipdate AS DATE) AS log_date,
         CASE WHEN l.l_returnflag = 'R' THEN CAST(l.l_quantity AS INTEGER) ELSE 0 END AS num_25,
         CASE WHEN l.l_returnflag = 'A' THEN CAST(l.l_quantity AS INTEGER) ELSE 0 END AS num_50,
         CAST(round(l.l_discount * 100) AS INTEGER) AS num_75,
         CAST(round(l.l_tax * 100) AS INTEGER) AS num_985,
         CASE WHEN l.l_returnflag = 'N' THEN CAST(l.l_quantity AS INTEGER) ELSE 0 END AS num_100,
         CAST(l.l_linenumber AS INTEGER) AS num_unq, l.l_extendedprice AS total_secs
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
logs_v1 AS (SELECT * FROM logs_all WHERE log_date <= DATE '{LOG_V1_END}'),
logs_v2 AS (SELECT * FROM logs_all WHERE log_date > DATE '{LOG_V1_END}')"""]
    if period is not None:
        parts.append(period_sql(period, prefix="p"))
    return ",".join(parts)


def period_sql(period: str, prefix: str = "p") -> str:
    """Per-period role tables: labels_<prefix>, tx_<prefix>, logs_<prefix>."""
    c = CUTOFFS[period]
    tx = ("SELECT * FROM tx_v1" if period == "period1"
          else "SELECT DISTINCT * FROM (SELECT * FROM tx_v1 UNION ALL SELECT * FROM tx_v2)")
    logs = ("SELECT * FROM logs_v1" if period == "period1"
            else "SELECT * FROM logs_v1 UNION ALL SELECT * FROM logs_v2")
    return f"""
labels_{prefix} AS (
  SELECT o_custkey AS msno,
         CASE WHEN count(*) FILTER (WHERE d > DATE '{c}' AND d <= DATE '{c}' + {LABEL_HORIZON_DAYS}) = 0
              THEN 1 ELSE 0 END AS is_churn
  FROM (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d FROM orders)
  GROUP BY o_custkey HAVING min(d) <= DATE '{c}'
),
tx_{prefix} AS ({tx}),
logs_{prefix} AS ({logs})"""
