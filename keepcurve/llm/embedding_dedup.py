"""Near-duplicate vectors by int8 tile products with rigorous error bounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepcurve.llm.common import connected_components, finite_vector, materialise

THRESHOLD = 0.9
ROWS_PER_STRIP = 4096
ROWS_AT_ONCE = 512
# Slack for the rounding of the float32 tile product itself, far above it.
ROUNDING = 1e-5


def quantise(x):
    """Unit vectors as int8 codes: codes, scale, length of code * scale, and
    length of the error x - code * scale (all per vector, in double)."""
    import numpy as np

    scale = np.abs(x).max(axis=1) / 127.0
    codes = np.rint(x / scale[:, None]).astype(np.int8)
    approx = codes * scale[:, None]
    return codes, scale, np.linalg.norm(approx, axis=1), np.linalg.norm(x - approx, axis=1)


class Links:
    """Groups of linked vectors within one tile, merged block row by block
    row; never a list of all pairs."""

    def __init__(self, ids):
        self.root = ids.copy()  # smallest node of the group so far

    def merge(self, where):
        """The vectors at these positions belong together."""
        import numpy as np

        roots = np.unique(self.root[where])
        for old in roots[1:]:
            self.root[self.root == old] = roots[0]


def tile_links(a, b, same: bool, threshold: float):
    """Links between two strips (or within one).  A strip is a dict of arrays
    id, copies, x (raw vectors).  Returns arrays id, n_links, root for the
    vectors that link: n_links counts rows (copies included) of the other
    strip, root is the smallest id of the vector's group in this tile."""
    import numpy as np

    def prepared(s):
        x = s["x"].astype(np.float64)
        x = x / np.abs(x).max(axis=1, keepdims=True)  # keeps lengths in range for extreme components
        norm = np.sqrt((x * x).sum(axis=1))
        return x, norm, quantise(x / norm[:, None])

    xa, na, (ca, sa, la, ea) = prepared(a)
    xb, nb, (cb, sb, lb, eb) = (xa, na, (ca, sa, la, ea)) if same else prepared(b)
    fb = np.ascontiguousarray(cb.T).astype(np.float32)
    ids = a["id"] if same else np.concatenate([a["id"], b["id"]])
    links, m = Links(ids), 0 if same else len(a["id"])
    n_a, n_b = np.zeros(len(na), np.int64), np.zeros(len(nb), np.int64)
    for lo in range(0, len(na), ROWS_AT_ONCE):
        hi = min(lo + ROWS_AT_ONCE, len(na))
        # |x.y - x'.y'| <= |x'||e_y| + |e_x||y'| + |e_x||e_y|
        cos = (ca[lo:hi].astype(np.float32) @ fb) * sa[lo:hi, None].astype(np.float32) * sb[None, :].astype(np.float32)
        bound = (la[lo:hi, None] * eb[None, :] + ea[lo:hi, None] * (lb + eb)[None, :] + ROUNDING).astype(np.float32)
        possible = cos + bound >= threshold
        if same:
            possible &= np.arange(len(nb))[None, :] > np.arange(lo, hi)[:, None]
        if not possible.any():
            continue
        sure = possible & (cos - bound >= threshold + ROUNDING)
        i, j = np.nonzero(possible & ~sure)
        for s in range(0, len(i), 1 << 16):
            p, q = i[s:s + (1 << 16)], j[s:s + (1 << 16)]
            exact = np.einsum("nd,nd->n", xa[lo + p], xb[q]) / (na[lo + p] * nb[q])
            sure[p, q] = exact >= threshold
        n_a[lo:hi] += sure @ b["copies"]
        n_b += a["copies"][lo:hi] @ sure
        for r in np.flatnonzero(sure.any(axis=1)):
            links.merge(np.append(np.flatnonzero(sure[r]) + m, lo + r))
    n = n_a + n_b if same else np.concatenate([n_a, n_b])
    hit = n > 0
    return ids[hit], n[hit], links.root[hit]


def near_duplicate_vectors(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding",
                           rows_per_strip: int = ROWS_PER_STRIP) -> DataFrame:
    """Link all pairs of vectors with cosine >= ``threshold`` (in double).

    Equal vectors are collapsed to one node first.  Nodes are dealt by a hash
    into strips of about ``rows_per_strip``; every pair of strips is one
    task's tile.  A tile multiplies int8 codes (exact in float32) and bounds
    each cosine's error from the per-vector lengths of code and error: pairs
    that cannot reach the threshold drop, pairs that must pass count, only
    those between are recomputed in double.  A tile returns at most a row per
    vector (links, smallest node of its group), so a large group of copies
    never becomes a list of pairs.  All pairs are compared, so work grows with
    the square of the distinct vectors, in even tiles; memory per task is two
    strips.

    Vectors that are null, empty, zero, or hold null or non-finite components
    link with nothing, and so do rows with a null id (their component is
    null); vectors link only with those of their own length.  Every row is a
    vector of its own, also if ids repeat.  Returns one row per input row:
    ``(<id_col>, n_links, component_id, kept)``; empty input gives an empty
    result.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("x"))
    ok = finite_vector(F.col("x")) & F.exists("x", lambda c: c != 0) & F.col("id").isNotNull()
    rows = materialise(rows.withColumn("ok", F.coalesce(ok, F.lit(False))).withColumn("key", F.xxhash64("x")))
    good = rows.where("ok")
    nodes = good.groupBy("key", "x").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    nodes = materialise(nodes.withColumn("dim", F.size("x")).withColumn("node", F.monotonically_increasing_id()))
    strips = max(1, -(-nodes.count() // rows_per_strip))

    def pack(key, t):
        import numpy as np
        import pyarrow as pa

        x = t.column("x").combine_chunks().flatten().to_numpy().astype("<f8")
        data = [t.column("node").to_numpy().astype("<i8"), t.column("copies").to_numpy().astype("<i8"), x]
        return pa.table([[key[0].as_py()], [key[1].as_py()], *[[np.ascontiguousarray(c).tobytes()] for c in data]],
                        schema=pa.schema([("dim", pa.int32()), ("strip", pa.int32()), ("id", pa.binary()), ("copies", pa.binary()), ("x", pa.binary())]))

    packed = materialise(nodes.withColumn("strip", F.pmod(F.xxhash64("node"), F.lit(strips)).cast("int"))
                         .select("dim", "strip", "node", "copies", "x").groupBy("dim", "strip")
                         .applyInArrow(pack, "dim int, strip int, id binary, copies binary, x binary"))
    other = F.explode(F.sequence(F.lit(0), F.lit(strips - 1))).alias("other")
    tiles = packed.select("*", other).withColumn("a", F.least("strip", "other")).withColumn("b", F.greatest("strip", "other"))

    def links(key, t):
        import numpy as np
        import pyarrow as pa

        dim, first, second = (k.as_py() for k in key)
        strip = {s: {"id": np.frombuffer(i, "<i8"), "copies": np.frombuffer(c, "<i8"), "x": np.frombuffer(x, "<f8").reshape(-1, dim)}
                 for s, i, c, x in zip(*(t.column(n).to_pylist() for n in ("strip", "id", "copies", "x")))}
        if first in strip and second in strip:
            found = tile_links(strip[first], strip[second], first == second, threshold)
        else:
            found = [np.zeros(0, np.int64)] * 3
        return pa.table(list(found), schema=pa.schema([("node", pa.int64()), ("n", pa.int64()), ("root", pa.int64())]))

    found = materialise(tiles.groupBy("dim", "a", "b").applyInArrow(links, "node long, n long, root long"))
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    components = connected_components(found.selectExpr("node AS src", "root AS dst"))
    nodes = (nodes.drop("dim").join(counts, "node", "left").join(components, "node", "left")
             .withColumn("component", F.coalesce("component", "node"))
             .withColumn("n_links", F.col("copies") - 1 + F.coalesce("n", F.lit(0))))
    least = nodes.groupBy("component").agg(F.min("id").alias("component_id"))
    nodes = nodes.join(least, "component").select("key", "x", "n_links", "component_id")
    linked = good.select("id", "key", "x").join(nodes, ["key", "x"]).select("id", "n_links", "component_id")
    alone = rows.where("NOT ok").selectExpr("id", "0L AS n_links", "id AS component_id")
    out = linked.unionByName(alone)
    return out.select(F.col("id").alias(id_col), "n_links", "component_id",
                      F.coalesce(F.col("component_id") == F.col("id"), F.lit(False)).alias("kept"))
