"""A stored model registry: append-only metric versions and an alias.

Layout of a registry folder on shared storage:

* ``metrics/model=<m>/version=<v>``: the metrics logged for a version,
  written once and never changed;
* ``aliases/manifest-<n>.json``: the champion of every model.  The manifest
  with the largest number holds; each promotion adds the next one whole (written
  aside, then renamed), so a reader sees one champion per model, before or after;
* ``aliases/claim-<n>``: an empty file that only one writer can create.  Who
  writes manifest n must hold claim n; a second writer that decided on the
  same state finds the claim taken and has lost the race.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keepcurve.operators import promotion as pm

COLUMNS = ["model", "version", "alias", "metric", "value"]


class LostRace(RuntimeError):
    """Another writer changed the aliases since they were read."""


class ModelRegistry:
    """``model`` names must be usable as folder names; a version's metrics can
    be logged once (a second time is an error of the writer)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark._jvm
        self._fs_path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._fs_path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._fs_path(f"{self.path}/aliases"))

    # ------------------------------------------------------------- metrics

    def log(self, metrics: DataFrame) -> None:
        """Append ``metrics(model, version, metric, value)``; a version that
        is already there is not touched and raises."""
        for r in metrics.select("model", "version").distinct().collect():
            if self._fs.exists(self._fs_path(f"{self.path}/metrics/model={r['model']}/version={r['version']}")):
                raise ValueError(f"version {r['version']} of {r['model']} is logged already")
        metrics.select("model", F.col("version").cast("int"), "metric", F.col("value").cast("double")).repartition(1).write.mode("append").partitionBy(
            "model", "version").parquet(f"{self.path}/metrics")

    def table(self) -> DataFrame:
        """``(model, version, alias, metric, value)`` as of the last manifest."""
        _, champions = self.aliases()
        if not self._fs.exists(self._fs_path(f"{self.path}/metrics")):
            return self.spark.createDataFrame([], "model string, version int, alias string, metric string, value double")
        m = self.spark.read.schema("metric string, value double, model string, version int").parquet(f"{self.path}/metrics")
        alias = F.lit(None).cast("string")
        for model, version in champions.items():
            alias = F.when((F.col("model") == model) & (F.col("version") == version), "champion").otherwise(alias)
        return m.withColumn("alias", alias).select(*COLUMNS)

    # ------------------------------------------------------------- aliases

    def aliases(self) -> tuple[int, dict[str, int]]:
        """Number of the last manifest (0: none) and each model's champion."""
        names = [s.getPath().getName() for s in self._fs.listStatus(self._fs_path(f"{self.path}/aliases"))]
        numbers = [int(m[1]) for m in (re.fullmatch(r"manifest-(\d+)\.json", n) for n in names) if m]
        if not numbers:
            return 0, {}
        last = max(numbers)
        stream = self._fs.open(self._fs_path(f"{self.path}/aliases/manifest-{last:08d}.json"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return last, json.loads(text)

    def set_champion(self, model: str, version: int, seen: int) -> int:
        """Move the alias, given that ``seen`` is the manifest it was decided
        on; returns the new manifest's number or raises ``LostRace``."""
        last, champions = self.aliases()
        number = seen + 1
        if last != seen or not self._fs.createNewFile(self._fs_path(f"{self.path}/aliases/claim-{number:08d}")):
            raise LostRace(f"manifest {seen} is no longer the last")
        aside = self._fs_path(f"{self.path}/aliases/.manifest-{number:08d}.writing")
        out = self._fs.create(aside, True)
        out.write(bytearray(json.dumps({**champions, model: int(version)}, sort_keys=True).encode()))
        out.close()
        self._fs.rename(aside, self._fs_path(f"{self.path}/aliases/manifest-{number:08d}.json"))
        return number

    def gate(self, candidate: DataFrame, metric: str = pm.PROMOTION_METRIC, tolerance: float = pm.PROMOTION_TOLERANCE, attempts: int = 3) -> DataFrame:
        """G3 against the stored champions: log the candidate, decide, and
        move the alias where it is promoted.  A lost race is decided again on
        the new state.  Returns the decisions (one row per candidate)."""
        self.log(candidate)
        for attempt in range(attempts):
            seen, _ = self.aliases()
            decisions = pm.promotion_gate(candidate, self.table(), metric, tolerance).collect()
            try:
                for r in decisions:
                    if r["promoted"]:
                        seen = self.set_champion(r["model"], r["candidate_version"], seen)
                break
            except LostRace:
                if attempt + 1 == attempts:
                    raise
        schema = pm.promotion_gate(candidate, self.table(), metric, tolerance).schema
        return self.spark.createDataFrame(decisions, schema)
