"""Sharding by extendible hashing, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepcurve.llm.common import materialise

HASH_BITS = 60
STEP_BITS = 12


def _hash60(col) -> F.Column:
    """First 60 bits of the md5 of a string column, as a long."""
    return F.conv(F.substring(F.md5(col), 1, 15), 16, 10).cast("long")


def shard_documents(docs: DataFrame, byte_limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Assign every row to a shard of at most ``byte_limit`` UTF-8 bytes.

    A directory is indexed by the leading bits of md5(id).  A bucket whose
    bytes pass the limit splits on one more bit, others stay: the shard of a
    row is the shortest prefix of its hash whose bucket fits.  Buckets are
    found on aggregated cells (prefix, bytes), ``STEP_BITS`` levels per round,
    and only the cells still too large go on to the next round; rows meet the
    directory in an equi-join per round on the prefix of that round's depth.

    Rows with one id share a hash, which no bit separates.  Where such a hash
    alone passes the limit, its rows are told apart by their place in the
    input first.  A single row beyond the limit gets a shard of its own
    (``oversize`` true); everything else fits.  Null ids hash as the word
    ``null``, null texts have 0 bytes.  Empty input gives an empty result.

    Returns ``(<id_col>, bytes, shard, depth, shard_bytes, oversize)``;
    ``shard`` is the bucket's prefix as a string of ``depth`` bits ("" when
    all fits one shard).
    """
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("bytes"),
        F.monotonically_increasing_id().alias("place"),
    ).withColumn("h", _hash60(F.coalesce(F.col("id").cast("string"), F.lit("null"))))
    rows = materialise(rows)
    # hashes that no bit can split: spread their rows by place
    stuck = rows.groupBy("h").agg(F.sum("bytes").alias("b"), F.count("*").alias("n"))
    stuck = stuck.where((F.col("b") > byte_limit) & (F.col("n") > 1)).select("h", F.lit(True).alias("stuck"))
    place_hash = _hash60(F.concat_ws(":", F.col("h").cast("string"), F.col("place").cast("string")))
    rows = materialise(rows.join(stuck, "h", "left").withColumn("h", F.when(F.col("stuck"), place_hash).otherwise(F.col("h")))
                       .drop("stuck", "place"))

    leaves, depth = [], 0
    pending = rows.select("h", "bytes")
    while True:
        base, depth = depth, min(depth + STEP_BITS, HASH_BITS)
        cells = pending.groupBy(F.shiftright("h", HASH_BITS - depth).alias("cell")).agg(
            F.sum("bytes").alias("b"), F.count("*").alias("n"))
        # every level of this round at once: each cell counts towards its prefixes
        levels = cells.select("cell", "b", "n", F.explode(F.sequence(F.lit(base), F.lit(depth))).alias("d"))
        levels = levels.withColumn("prefix", F.expr(f"shiftright(cell, {depth} - d)"))
        totals = levels.groupBy("d", "prefix").agg(F.sum("b").alias("sb"), F.sum("n").alias("sn"))
        fits = totals.where((F.col("sb") <= byte_limit) | (F.col("sn") == 1) | (F.col("d") == HASH_BITS))
        leaf = (levels.join(fits, ["d", "prefix"]).groupBy("cell")
                .agg(F.min(F.struct("d", "prefix", "sb")).alias("leaf")).select("cell", "leaf.*"))
        leaf = materialise(leaf)
        leaves.append((depth, leaf))
        found = leaf.select("cell")
        if depth == HASH_BITS:
            break
        rest = cells.join(found, "cell", "left_anti").select("cell")
        if rest.isEmpty():
            break
        rest = materialise(rest)
        pending = pending.withColumn("cell", F.shiftright("h", HASH_BITS - depth)).join(rest, "cell", "left_semi").select("h", "bytes")

    out = None
    todo = rows
    for k, (depth, leaf) in enumerate(leaves):
        j = todo.withColumn("cell", F.shiftright("h", HASH_BITS - depth)).join(leaf, "cell", "left").drop("cell")
        hit = j.where(F.col("d").isNotNull())
        out = hit if out is None else out.unionByName(hit)
        if k + 1 < len(leaves):
            todo = j.where(F.col("d").isNull()).drop("d", "prefix", "sb")
    bits = F.lpad(F.conv(F.col("prefix").cast("string"), 10, 2), F.col("d"), F.lit("0"))
    return out.select(
        F.col("id").alias(id_col), "bytes",
        F.when(F.col("d") == 0, F.lit("")).otherwise(bits).alias("shard"),
        F.col("d").cast("int").alias("depth"), F.col("sb").alias("shard_bytes"),
        (F.col("sb") > byte_limit).alias("oversize"))
