"""Sink/source round trips (S5-S9): write through the library's sinks
into the shared checkpoint folder, read back, and compare with SQL.

Output folders are fresh per call under ``<spark.checkpoint.dir>/tables``
(shared storage on a cluster), never a machine-local temp folder.
"""

from __future__ import annotations

import uuid

from keepcurve.plans.catalog_features import SNAPSHOT_DOUBLES, round_replace, snapshots, with_both
from keepcurve.operators import uplift as up
from keepcurve.plans.catalog_survival import LIFE_SQL, LTV_COLS, ltv_table
from keepcurve.plans.catalog_uplift import NUMERIC_FEATURES, TARGET_COLS, TARGET_SQL, _drift, _drift_sql, experiment
from keepcurve.plans.registry import query
from keepcurve.session import ensure_checkpoint_dir
from keepcurve.sources import snapshots as store


def _table_path(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"


@query("snapshot_store_period2", f"""{with_both()}
SELECT {round_replace(SNAPSHOT_DOUBLES)} FROM snap2""")
def q_snapshot_store_period2(spark, sf_dir):
    """S5 + S6: both periods written as one Parquet dataset partitioned by
    period (dynamic partition overwrite); period2 read back with partition
    pruning."""
    path = _table_path(spark, "feature_snapshot")
    store.write_snapshot(snapshots(spark, sf_dir), path)
    return store.read_snapshot(spark, path, "period2")


@query("drift_report_csv", _drift_sql(NUMERIC_FEATURES) + "\nSELECT feature, round(psi, 6) AS psi, status FROM rs")
def q_drift_report_csv(spark, sf_dir):
    """The drift report through the CSV report sink (header, one file),
    read back with its declared schema."""
    path = _table_path(spark, "drift_report_csv")
    store.write_report_csv(_drift(spark, sf_dir, NUMERIC_FEATURES), path)
    return (spark.read.option("header", True)
            .schema("feature string, psi double, status string").csv(path))


LTV_OUT = ", ".join(f"round({c}, 6) AS {c}" if c not in ("tenure_days", "retention_priority_segment") else c for c in LTV_COLS)
TARGET_OUT = ", ".join(f"round({c}, 6) AS {c}" if c in ("predicted_uplift", "ltv", "churn_probability", "expected_value_of_offer") else c
                       for c in TARGET_COLS)


@query("ltv_table_store", LIFE_SQL + f"\nSELECT msno, period, {LTV_OUT} FROM seg")
def q_ltv_table_store(spark, sf_dir):
    """The LTV table through its Parquet sink and back."""
    path = _table_path(spark, "ltv_table")
    store.write_table(ltv_table(spark, sf_dir), path)
    return spark.read.parquet(path)


@query("targeting_list_store", TARGET_SQL + f"\nSELECT {TARGET_OUT} FROM tg")
def q_targeting_list_store(spark, sf_dir):
    """The stored LTV table read again, joined to the uplift scores, and
    the targeting list through its sink."""
    ltv_path, out_path = _table_path(spark, "ltv_table"), _table_path(spark, "targeting_list")
    store.write_table(ltv_table(spark, sf_dir), ltv_path)
    ltv = spark.read.parquet(ltv_path).select("msno", "period", "ltv", "churn_probability", "retention_priority_segment")
    scores = experiment(spark, sf_dir).select("msno", "period", "predicted_uplift")
    store.write_table(up.targeting_list(scores, ltv).select(*TARGET_COLS), out_path)
    return spark.read.parquet(out_path)
