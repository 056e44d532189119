"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keepcurve.llm.common import materialise, word_count

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MAX_COPIES = 2.0
OFFSET_DENOMINATOR = 16 ** 7


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = MAX_COPIES) -> DataFrame:
    """Targets of ``sizes(source, source_size)``: ``share`` of all words go to
    the sources by weight (weights repeat over the sources in code-point
    order, null last); a target stops at ``cap`` times its source's size and
    the excess goes to the others by weight until none is above.

    In the order of size per weight the sources at their cap come first, so
    the level of the others follows from two running sums over the source
    table (one row per source).
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    s = sizes.withColumn("w", w).withColumn("cap", F.lit(float(cap)) * F.col("source_size"))
    by_need = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_need.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum(F.col("source_size")).over(Window.partitionBy()) * F.lit(float(share))
    s = s.withColumn("level", (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(rest))
    # a source is at its cap if the level of those from it on would lift it above
    s = s.withColumn("full", F.col("level") * F.col("w") >= F.col("cap"))
    free = F.min(F.when(~F.col("full"), F.struct(F.col("cap") / F.col("w"), "level"))).over(Window.partitionBy())
    return s.select("source", "source_size", F.when(F.col("full"), F.col("cap")).otherwise(F.col("w") * free["level"]).alias("target"))


def _join_null_safe(left: DataFrame, right: DataFrame, cols: list[str]) -> DataFrame:
    """Inner join in which null keys meet; keeps the left key columns."""
    r = right.withColumnsRenamed({c: f"right_{c}" for c in cols})
    return left.join(r, [left[c].eqNullSafe(r[f"right_{c}"]) for c in cols]).drop(*[f"right_{c}" for c in cols])


def mix_sources(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = MAX_COPIES, seed: str = "mix",
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", carry: tuple[str, ...] = ()) -> DataFrame:
    """Copies of each document in the mix: ``(<id_col>, source, size,
    source_size, target, copies, *carry)``, one row per input row.

    Every document of a source expects target / source size copies.  In order
    of size the expected copies are summed up within the source, one offset
    per source (from md5 of seed and source) is added, and a document comes
    once per integer boundary that its stretch crosses.  Ordered by size, the
    words taken miss the target by about one document at most.

    The rank within a source is built from counts: sizes within the source,
    the first three hex digits of md5(id) within the size, and rows within
    such a cell, so a source or size with a third of all rows is never one
    group.  Results do not depend on partitioning.  Null texts and texts
    without a word have size 0; null is a source of its own; rows that agree
    in id and text are interchangeable.  Empty input gives an empty result.
    """
    d = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
                    F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("null"))).alias("digest"),
                    F.xxhash64(F.col(text_col)).alias("text_hash"), *carry)
    d = materialise(d.withColumn("cell", F.substring("digest", 1, 3)))
    cells = materialise(d.groupBy("source", "size", "cell").agg(F.count("*").alias("n")))
    sizes = cells.groupBy("source", "size").agg(F.sum("n").alias("n"))
    targets = source_targets(sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, share, cap)
    earlier = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("source", "size", earlier(Window.partitionBy("source").orderBy("size")).alias("size_rank"))
    places = cells.select("source", "size", "cell", earlier(Window.partitionBy("source", "size").orderBy("cell")).alias("cell_rank"))
    places = _join_null_safe(_join_null_safe(places, sizes, ["source", "size"]), targets, ["source"])
    in_cell = F.row_number().over(Window.partitionBy("source", "size", "cell").orderBy("digest", "id", "text_hash", *carry))
    j = _join_null_safe(d.withColumn("in_cell", in_cell), places, ["source", "size", "cell"])
    rank = F.col("size_rank") + F.col("cell_rank") + F.col("in_cell")
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("source"), F.lit(""))))
    offset = F.conv(F.substring(draw, 1, 7), 16, 10).cast("double") / OFFSET_DENOMINATOR
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    copies = F.floor(each * rank + offset) - F.floor(each * (rank - 1) + offset)
    return j.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target",
                    copies.cast("long").alias("copies"), *carry)


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **params) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as ``mix_sources`` says,
    all its columns unchanged.  Rows are written once with a number of their
    own, by which copies and rows meet."""
    d = materialise(docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.monotonically_increasing_id().alias("row_number")))
    keys = d.select(F.col(f"row.`{id_col}`").alias("id"), F.col(f"row.`{text_col}`").alias("text"), F.col(f"row.`{source_col}`").alias("source"), "row_number")
    plan = mix_sources(keys, id_col="id", text_col="text", source_col="source", carry=("row_number",), **params)
    plan = plan.where("copies > 0").select("row_number", F.col("copies").cast("int").alias("copies"))
    j = d.join(plan, "row_number").select("row", F.explode(F.expr("sequence(1, copies)")))
    return j.select("row.*")
