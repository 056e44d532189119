"""Merkle manifest of a dataset, its proofs and their verification.

Leaves are numbered through the whole dataset, group by group, and every node
of a group's tree is labelled by the interval of leaf ranks that it covers;
the groups' roots are in turn the leaves of a top tree over group numbers.
Intervals nest, so ancestry is containment: a node meets its parent in a join
on the parent's level bucket (the interval's start, divided by the level's
width) that holds where the parent's interval contains the node's.  Siblings
are the parent's children outside the node's own interval.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepcurve.llm.common import materialise
from keepcurve.operators.ordered import row_prefix

FAN_OUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEP = "struct<left:string,right:string>"


def encoded(value: Column) -> Column:
    """``-`` for null, else byte count, colon and the value as text."""
    v = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))


def leaf_digest(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[encoded(f) for f in fields]), 256)


def _bucket(level: int, fan_out: int) -> Column:
    """Number, within its tree, of the node of ``level`` that covers ``lo``."""
    return F.floor((F.col("lo") - F.col("tree")) / F.lit(fan_out ** level)).cast("long")


def tree_levels(nodes: DataFrame, largest: int, fan_out: int = FAN_OUT) -> list[DataFrame]:
    """Inner nodes, a table per level from the lowest up, over the leaves
    ``nodes(tree, n, lo, hash)``: ``tree`` is the rank of the tree's first
    leaf, ``n`` its number of leaves, ``lo`` a leaf's rank.

    A table holds ``(tree, n, lo, hi, hash, children)``; children are at most
    ``fan_out`` structs ``(lo, hi, hash)`` in order.  A tree ends at the level
    of its single node.  ``largest`` is the largest ``n``."""
    levels: list[DataFrame] = []
    below = nodes.withColumn("hi", F.col("lo") + 1)
    while largest > fan_out ** len(levels):
        level = len(levels) + 1
        width = F.lit(fan_out ** level).cast("long")
        runs = below.where(F.col("n") > fan_out ** (level - 1)).groupBy("tree", "n", _bucket(level, fan_out).alias("bucket")).agg(
            F.array_sort(F.collect_list(F.struct("lo", "hi", "hash"))).alias("children"))
        start = F.col("tree") + F.col("bucket") * width
        up = materialise(runs.select(
            "tree", "n", start.alias("lo"), F.least(start + width, F.col("tree") + F.col("n")).alias("hi"),
            F.sha2(F.array_join(F.transform("children", lambda c: c["hash"]), ""), 256).alias("hash"), "children"))
        levels.append(up)
        below = up.select("tree", "n", "lo", "hi", "hash")
    return levels


def _joined(children: Column) -> Column:
    return F.array_join(F.transform(children, lambda c: c["hash"]), "")


def _attach(nodes: DataFrame, parents: DataFrame, level: int, fan_out: int) -> DataFrame:
    """``nodes`` with the ``path`` of their siblings, level by level up, from
    ``parents(tree, lo, hi, children, path, *top)`` of ``level``."""
    p = parents.withColumn("bucket", _bucket(level, fan_out)).withColumnsRenamed(
        {"tree": "p_tree", "lo": "p_lo", "hi": "p_hi", "children": "p_children", "path": "p_path", "bucket": "p_bucket"})
    c = nodes.withColumn("bucket", _bucket(level, fan_out))
    inside = (F.col("p_lo") <= F.col("lo")) & (F.col("hi") <= F.col("p_hi"))
    j = c.join(p, (F.col("tree") == F.col("p_tree")) & (F.col("bucket") == F.col("p_bucket")) & inside)
    left = _joined(F.filter("p_children", lambda x: x["hi"] <= F.col("lo")))
    right = _joined(F.filter("p_children", lambda x: x["lo"] >= F.col("hi")))
    step = F.array(F.struct(left.alias("left"), right.alias("right")))
    # a tree of one leaf has no node above it but those of the top tree
    path = F.when(F.col("p_children").isNull(), F.col("p_path")).otherwise(F.concat(step, F.col("p_path")))
    return j.withColumn("path", path).drop("bucket", "p_tree", "p_lo", "p_hi", "p_children", "p_path", "p_bucket")


def _from(nodes: DataFrame, base: DataFrame | None) -> DataFrame:
    return nodes.withColumn("path", F.array().cast(f"array<{STEP}>")) if base is None else nodes.join(base, "tree")


def attach_paths(nodes: DataFrame, levels: list[DataFrame], base: DataFrame | None, fan_out: int = FAN_OUT) -> DataFrame:
    """``nodes(tree, lo, hi, ...)``, the leaves, with their ``path`` to the
    root of their tree and on along ``base(tree, path, *top)``; paths are
    arrays of ``(left, right)``: the joined hashes of the siblings before and
    after, one entry per level.  Columns ``top`` of ``base`` come along;
    without ``base`` paths end at the root of the tree."""
    top = [] if base is None else [c for c in base.columns if c not in ("tree", "path")]
    above = None
    for level in range(len(levels), 0, -1):
        here = levels[level - 1].select("tree", "n", "lo", "hi", "children")
        own = _from(here.where(F.col("n") <= fan_out ** level), base)
        if above is not None:
            own = own.unionByName(_attach(here.where(F.col("n") > fan_out ** level), above, level + 1, fan_out))
        above = own.select("tree", "lo", "hi", "children", "path", *top)
    lone = _from(nodes.where("n = 1").select("tree"), base).select(
        "tree", F.col("tree").alias("lo"), (F.col("tree") + 1).alias("hi"),
        F.lit(None).cast("array<struct<lo:bigint,hi:bigint,hash:string>>").alias("children"), "path", *top)
    above = lone if above is None else above.unionByName(lone)
    return _attach(nodes, above, 1, fan_out)


@dataclass
class Manifest:
    """``leaves(<id>, <group>, rank, leaf, tree, n, *carry)``, ``groups(<group>,
    tree, n, ordinal, subroot)`` (a row per group, in order), the inner nodes
    per level of the groups' trees and of the top tree, and ``root`` (none
    where there are no leaves)."""

    leaves: DataFrame
    groups: DataFrame
    levels: list[DataFrame]
    top_levels: list[DataFrame]
    root: str | None
    n_groups: int
    fan_out: int

    def nodes(self) -> DataFrame:
        """All inner nodes: ``(part, level, tree, lo, hi, hash)``; part is
        ``group`` (intervals of leaf ranks) or ``top`` (of group numbers)."""
        out = None
        for part, levels in (("group", self.levels), ("top", self.top_levels)):
            for k, nodes in enumerate(levels, 1):
                t = nodes.select(F.lit(part).alias("part"), F.lit(k).alias("level"), "tree", "lo", "hi", "hash")
                out = t if out is None else out.unionByName(t)
        return out

    def proofs(self) -> DataFrame:
        """``leaves`` with ``path`` (see ``attach_paths``), from the leaf to
        the root of the dataset, and ``subroot`` and ``root``."""
        g = self.groups
        top = g.select(F.lit(0).cast("long").alias("tree"), F.lit(self.n_groups).cast("long").alias("n"), F.col("ordinal").alias("lo"),
                       (F.col("ordinal") + 1).alias("hi"), F.col("tree").alias("group_tree"), "subroot")
        base = attach_paths(top, self.top_levels, None, self.fan_out)
        base = materialise(base.select(F.col("group_tree").alias("tree"), "path", "subroot", F.lit(self.root).alias("root")))
        nodes = self.leaves.withColumns({"lo": F.col("rank"), "hi": F.col("rank") + 1})
        return attach_paths(nodes, self.levels, base, self.fan_out).drop("lo", "hi")


def proof_digest(path) -> Column:
    """H of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def folded(path, leaf: Column) -> Column:
    """The root that follows from a leaf and the siblings of its path."""
    return F.aggregate(path, leaf, lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]), 256))


def build_manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, id_col: str = "doc_id", group_col: str = "source",
                   fan_out: int = FAN_OUT, carry: Mapping[str, Column] | None = None) -> Manifest:
    """The Merkle tree over the rows of ``docs``.

    A row's leaf is the SHA-256 (lowercase hex) of its ``fields``, each ``-``
    if null, else UTF-8 byte count, colon and value.  Within a group leaves
    ascend by id (null first; equal ids by leaf, so that rows alike in both
    are interchangeable); every ``fan_out`` consecutive nodes, the last run
    maybe fewer, become the SHA-256 of their joined hex digests, until one
    node remains.  Groups ascend bytewise, null first and a group of its own,
    and their roots become the dataset's root in the same way.  Null, empty
    and very long values are hashed like others; columns not in ``fields``
    are ignored, whatever their names.  No rows: no leaves and root None.

    Texts are read once and never shuffled; digests are ordered in ranges of
    (group, id), so no group is one task.  ``carry`` are further columns of
    the leaves, computed in the same pass.
    """
    carry = dict(carry or {})
    rows = docs.select(
        F.struct(F.col(group_col).alias("g"), F.col(id_col).alias("i"), leaf_digest([docs[c] for c in fields]).alias("h")).alias("key"),
        *[c.alias(f"carried_{n}") for n, c in carry.items()])
    ranked = row_prefix(materialise(rows), "key").select(
        F.col("key.g").alias("g"), F.col("key.i").alias("i"), (F.col("rn") - 1).alias("rank"), F.col("key.h").alias("leaf"),
        *[f"carried_{n}" for n in carry])
    ranked = materialise(ranked)
    spans = ranked.groupBy("g").agg(F.min("rank").alias("tree"), F.count("*").alias("n"))
    spans = row_prefix(spans.withColumn("key", F.struct("g")), "key").select("g", "tree", "n", (F.col("rn") - 1).alias("ordinal"))
    spans = materialise(spans)
    s = spans.select(F.col("g").alias("s_g"), "tree", "n")
    leaves = ranked.join(s, F.col("g").eqNullSafe(F.col("s_g"))).drop("s_g")
    size = spans.agg(F.max("n").alias("largest"), F.count("*").alias("groups")).first()

    levels = tree_levels(leaves.select("tree", "n", F.col("rank").alias("lo"), F.col("leaf").alias("hash")), size["largest"] or 0, fan_out)
    roots = leaves.where("n = 1").select("tree", F.col("leaf").alias("subroot"))
    for k, nodes in enumerate(levels, 1):
        roots = roots.unionByName(nodes.where(F.col("n") <= fan_out ** k).select("tree", F.col("hash").alias("subroot")))
    groups = materialise(spans.join(roots, "tree"))
    subroots = groups.select(F.lit(0).cast("long").alias("tree"), F.lit(size["groups"]).cast("long").alias("n"), F.col("ordinal").alias("lo"),
                             F.col("subroot").alias("hash"))
    top_levels = tree_levels(subroots, size["groups"], fan_out)
    last = top_levels[-1].select("hash").first() if top_levels else groups.select("subroot").first()
    return Manifest(
        leaves.select(F.col("i").alias(id_col), F.col("g").alias(group_col), "rank", "leaf", "tree", "n", *[F.col(f"carried_{n}").alias(n) for n in carry]),
        groups.select(F.col("g").alias(group_col), "tree", "n", "ordinal", "subroot"), levels, top_levels, last[0] if last else None, size["groups"], fan_out)
