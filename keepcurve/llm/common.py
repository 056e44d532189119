"""Helpers shared by the operators: table reading, materialising into the
shared folder, word rules, connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keepcurve.session import ensure_checkpoint_dir

# Words are maximal runs of anything but ASCII white space.
WORD_RE = r"[^\x20\x09-\x0D]+"
ROWS_PER_BATCH = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Let Arrow batches between Spark and Python hold at most
    ``ROWS_PER_BATCH`` rows: Spark's default of 10,000 whole texts costs tens
    of MB, several times per task.  A session that asks for fewer keeps that."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name, "10000"))
    if now <= 0 or now > ROWS_PER_BATCH:
        spark.conf.set(name, str(ROWS_PER_BATCH))


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet below the cluster's ``spark.checkpoint.dir``
    and read it back: lineage ends there, executors can be lost, and several
    consumers read it instead of computing it again.  The folder goes when
    the session ends."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    jvm, jsc = spark._jvm, spark.sparkContext._jsc
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(jsc.hadoopConfiguration()).deleteOnExit(p)
    return spark.read.schema(df.schema).parquet(path)


def remainder(n: int, id_col: str = "doc_id") -> F.Column:
    """crc32 of the id as text, modulo ``n``: the folds of the contracts."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % n


def word_count(text) -> F.Column:
    """Number of words of a text column; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RE)), F.lit(0)).cast("long")


def finite_vector(v) -> F.Column:
    """True where an array column is not null and holds only finite, non-null
    components."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & ~bad, F.lit(False))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Components of the undirected graph ``edges(src, dst)`` of long ids.

    Returns ``(node, component)`` for every node that has an edge to another
    node; ``component`` is the smallest id reachable.  Alternates large-star
    and small-star steps, each a minimum per node (combined map-side) and one
    join on the node id; a hub is never gathered into a group, and a hot join
    key is split by the adaptive skew join.  Ends when no edge changes.
    Self-loops, repeated and null edges are ignored.
    """
    e = edges.where("src <> dst").selectExpr("greatest(src, dst) AS u", "least(src, dst) AS v").distinct()
    e = e.checkpoint()
    mark = None
    for _ in range(max_rounds):
        # large-star: every larger neighbour of a node links to the node's minimum
        both = e.unionAll(e.selectExpr("v AS u", "u AS v"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) AS m")
        large = both.join(low, "u").where("v > u").selectExpr("v AS u", "m AS v").where("u <> v").distinct()
        # small-star: every smaller neighbour, and the node, link to the smallest
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").selectExpr("v AS u", "m AS v")
        e = small.unionAll(low.selectExpr("u", "m AS v")).distinct().checkpoint()
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            break
        mark = tuple(now)
    else:
        raise RuntimeError("connected components did not settle")
    stars = e.selectExpr("u AS node", "v AS component")
    return stars.unionAll(e.selectExpr("v AS node", "v AS component")).distinct()
