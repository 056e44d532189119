"""Distributed isotonic regression.

Pooling adjacent violators is confluent: in whatever order neighbouring blocks
whose means do not increase are pooled, the same blocks remain.  So blocks,
one per distinct score to begin with, are numbered in order and dealt into
groups of ``GROUP`` neighbours, each group is pooled on its own, and the
blocks left are numbered and dealt again, every other time with the groups
moved by half.  When two rounds in a row pool nothing, every neighbouring pair
has been together in a group and no violator is left; when all blocks fit one
group, its round is the last.  No group grows with the data and no block
passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keepcurve.operators.ordered import row_prefix, value_prefix
from keepcurve.session import cut_lineage

GROUP = 1 << 16
BUCKETS = 4096
BLOCK = "lo double, hi double, weight double, total double"


def pool(lo, hi, weight, total):
    """Pooled blocks of a run in order: a stack, on which a block that does
    not lie above the one before it is merged into that."""
    out: list[list[float]] = []
    for block in zip(lo, hi, weight, total):
        out.append(list(block))
        while len(out) > 1 and out[-2][3] * out[-1][2] >= out[-1][3] * out[-2][2]:
            _, hi_, w, t = out.pop()
            out[-1][1:] = [hi_, out[-1][2] + w, out[-1][3] + t]
    return out


def _pool_group(table):
    import pyarrow as pa

    table = table.sort_by("lo")
    rows = pool(*[table.column(c).to_pylist() for c in ("lo", "hi", "weight", "total")])
    return pa.table({c: pa.array([r[k] for r in rows], pa.float64()) for k, c in enumerate(("lo", "hi", "weight", "total"))})


def fit_isotonic_blocks(df: DataFrame, label: str = "label", score: str = "score", weight: str | None = None, group: int = GROUP) -> DataFrame:
    """Blocks ``(lo, hi, weight, total, calibrated)`` of the isotonic fit of
    ``label`` on ``score``: scores from ``lo`` to ``hi`` are fitted by
    ``calibrated`` = total / weight.  Rows with a null score or label, or no
    positive weight, are left out; equal scores are one point.  No rows: no
    blocks."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    d = df.where(F.col(score).isNotNull() & F.col(label).isNotNull() & (w > 0)).select(
        F.col(score).cast("double").alias("s"), (F.col(label).cast("double") * w).alias("y"), w.alias("w"))
    blocks = value_prefix(d, "s", {"y": F.col("y"), "w": F.col("w")}).select(
        F.col("s").alias("lo"), F.col("s").alias("hi"), F.col("w").alias("weight"), F.col("y").alias("total"))
    unchanged, shift, before = 0, 0, None
    while unchanged < 2:
        numbered = row_prefix(blocks, "lo")
        part = F.floor((F.col("rn") - 1 + F.lit(shift)) / group).alias("part")
        blocks = cut_lineage(numbered.select("lo", "hi", "weight", "total", part).groupBy("part").applyInArrow(_pool_group, BLOCK))
        left = blocks.count()
        if (before or numbered.count()) <= group and not shift:
            break
        unchanged = unchanged + 1 if left == before else 0
        before, shift = left, group // 2 - shift if left > group else 0
    return blocks.withColumn("calibrated", F.col("total") / F.col("weight"))


def calibrate_blocks(blocks: DataFrame, scored: DataFrame, score: str = "score", out_col: str | None = None) -> DataFrame:
    """``scored`` with ``score`` replaced (or ``out_col`` added) by its
    calibrated value: within a block its value, between two blocks on the line
    between them, beyond the ends the nearest; null stays null.

    The knots before and after every distinct score are found in buckets of
    the score range, with the last and first knots of the other buckets from
    an aggregate per bucket; scores meet their value in a join."""
    knots = blocks.select(F.explode(F.array(F.struct(F.col("lo").alias("s"), F.col("calibrated").alias("v")),
                                            F.struct(F.col("hi").alias("s"), F.col("calibrated").alias("v")))).alias("k")).select("k.*").distinct()
    ends = knots.agg(F.min("s").alias("a"), F.max("s").alias("b")).first()
    out_col = out_col or score
    if ends["a"] is None:
        return scored.withColumn(out_col, F.lit(None).cast("double"))
    width = (ends["b"] - ends["a"]) / BUCKETS or 1.0
    bucket = F.least(F.greatest(F.floor((F.col("s") - F.lit(ends["a"])) / width), F.lit(-1)), F.lit(BUCKETS)).cast("int")
    points = scored.where(F.col(score).isNotNull()).select(F.col(score).cast("double").alias("s")).distinct()
    both = knots.select("s", F.struct("s", "v").alias("knot")).unionByName(points.select("s", F.lit(None).cast("struct<s:double,v:double>").alias("knot")))
    both = cut_lineage(both.withColumn("bucket", bucket))
    # knots of the nearest bucket before and after that has any: a row per bucket
    per = both.groupBy("bucket").agg(F.max("knot").alias("last"), F.min("knot").alias("first"))
    order = Window.orderBy("bucket")
    per = per.select(F.col("bucket").alias("b"), F.last("last", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("earlier"),
                     F.first("first", ignorenulls=True).over(order.rowsBetween(1, Window.unboundedFollowing)).alias("later"))
    up = Window.partitionBy("bucket").orderBy("s").rangeBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy("bucket").orderBy("s").rangeBetween(0, Window.unboundedFollowing)
    near = both.withColumns({"k0": F.max("knot").over(up), "k1": F.min("knot").over(down)}).where("knot IS NULL")
    near = near.join(F.broadcast(per), near.bucket == per.b)  # at most BUCKETS + 2 rows
    k0, k1 = F.coalesce("k0", "earlier"), F.coalesce("k1", "later")
    line = k0["v"] + (F.col("s") - k0["s"]) / (k1["s"] - k0["s"]) * (k1["v"] - k0["v"])
    value = F.when(k0.isNull(), k1["v"]).when(k1.isNull() | (k0["s"] == k1["s"]) | (k0["v"] == k1["v"]), k0["v"]).otherwise(line)
    values = near.select(F.col("s").alias("_s"), value.alias("_calibrated"))
    out = scored.join(values, F.col(score).cast("double") == F.col("_s"), "left").withColumn(out_col, F.col("_calibrated"))
    return out.drop("_s", "_calibrated")
