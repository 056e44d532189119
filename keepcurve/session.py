"""Session helpers: a sensible local session for tests/bench and checkpoint
directory discovery for cluster runs."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

# Settings every job in this library relies on.  AQE re-plans joins at
# runtime (broadcast only what is *measured* small, split skewed partitions,
# coalesce tiny ones); the session time zone pins date arithmetic.
CORE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(app: str = "keepcurve", cores: int | str = "*", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench (UI off, AQE on)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "16g")
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in {**CORE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_core_conf(spark: SparkSession) -> None:
    for k, v in CORE_CONF.items():
        spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder must be on shared storage and is configured by
    the cluster; nothing set there is an error.  Only a local session, as in
    tests, gets a fresh temp folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="keepcurve-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably (survives executor loss) and cut its lineage.

    Uses ``DataFrame.checkpoint`` into the shared checkpoint folder; never
    ``localCheckpoint``.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def few_tasks(df: DataFrame, rows_per_task: int, even: bool = False) -> DataFrame:
    """A materialised ``df`` in no more partitions than full tasks need, for
    fits that run hundreds of jobs over it: each job costs its tasks' start.
    Where that makes more than three tasks a core (``even``: one, of equal
    sizes, by a shuffle) they grow instead, to 32 times ``rows_per_task`` at most."""
    n, cores = df.count(), df.sparkSession.sparkContext.defaultParallelism
    tasks, least = max(1, -(-n // rows_per_task)), -(-n // (32 * rows_per_task))
    if even and tasks > cores:
        return df.repartition(cores * -(-least // cores))
    return df.coalesce(max(min(tasks, 3 * cores), least))


def together(*steps: Callable) -> list:
    """Results of steps that do not need each other, run from a thread each:
    fits of many short jobs wait for the scheduler, not for cores, so their
    jobs fill each other's gaps.  The first error is raised."""
    from pyspark import inheritable_thread_target

    with ThreadPoolExecutor(len(steps)) as pool:
        spark = SparkSession.active()
        runs = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
        return [r.result() for r in runs]


def sf_path(sf_dir: str, table: str) -> str:
    return os.path.join(sf_dir, f"{table}.parquet")
