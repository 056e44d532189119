"""Queries over stored, merged sketches."""

from __future__ import annotations

from pyspark.sql import functions as F

from keepcurve.operators import drift as dr
from keepcurve.operators import drift_sketch as ds
from keepcurve.plans.catalog_features import snapshots
from keepcurve.plans.catalog_sinks import _table_path
from keepcurve.plans.catalog_uplift import NUMERIC_FEATURES, _drift_sql
from keepcurve.plans.registry import query
from keepcurve.sources import snapshots as store


def _stored_sketches(spark, sf_dir, name):
    """Sketches per period and delivery (members by the parity of their key
    stand for two), stored, read again and merged per period."""
    s = snapshots(spark, sf_dir).withColumn("delivery", F.col("msno") % 2)
    path = f"{_table_path(spark, name)}/sketches"
    store.write_table(ds.feature_sketches(s, NUMERIC_FEATURES, ["period", "delivery"]), path)
    merged = ds.merge_sketches(spark.read.parquet(path), ["period"])
    return merged.where("period = 'period1'"), merged.where("period = 'period2'")


@query("drift_report_sketch", _drift_sql(NUMERIC_FEATURES) + "\nSELECT feature, round(psi, 6) AS psi, status FROM rs")
def q_drift_report_sketch(spark, sf_dir):
    """R1 + R2: the drift report of 42 features from one aggregate; exact up to
    4,096 values a side, which the test scale stays below."""
    return ds.drift_report_from_sketches(*_stored_sketches(spark, sf_dir, "drift_sketches")).select("feature", "psi", "status")


OPEN_SQL = _drift_sql(NUMERIC_FEATURES).replace("CASE WHEN v >= q[1] AND v <= q[len(q)] THEN", "CASE WHEN v < q[1] THEN 0 WHEN v > q[len(q)] THEN len(q) - 2 ELSE")


@query("drift_open_ended", OPEN_SQL + "\nSELECT feature, round(psi, 6) AS psi, status FROM rs")
def q_drift_open_ended(spark, sf_dir):
    """R1 with open end bins: values outside the reference range count."""
    pair = _stored_sketches(spark, sf_dir, "drift_open")
    p = ds.psi_from_sketches(*pair, open_ended=True)
    return p.select("feature", "psi", dr.status(F.col("psi")).alias("status"))
