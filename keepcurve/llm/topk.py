"""Exact top-k search by integer inner product over a bit-sliced index."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keepcurve.llm.common import finite_vector, materialise

SCALE = 256
ROWS_PER_BLOCK = 16_384
QUERIES_PER_BLOCK = 256
# Vectors with components beyond this are not bit-sliced but scored with integers of any size.
LARGEST = float(1 << 46)
LONG = 1 << 63


def _slices(codes):
    """Bit slices of an int matrix (rows x attributes): offset to start at 0,
    one packed bitmap of the rows per attribute and bit."""
    import numpy as np

    low = int(codes.min())
    bits = max(1, int(codes.max() - low).bit_length())
    shifted = (codes - low).T  # attribute-major
    maps = [np.packbits((shifted >> b) & 1, axis=1) for b in range(bits)]
    return low, np.stack(maps, axis=1).astype(np.uint8)  # attribute, bit, bytes


def _add_slices(stacks):
    """Sum of bitmaps by weight: carry-save adders take three bitmaps of one
    weight to one of it and one of the next, until each weight has one."""
    import numpy as np

    out, w = [], 0
    while w < len(stacks):
        s = stacks[w]
        while len(s) > 1:
            n = len(s) // 3 * 3
            if n:
                a, b, c = s[0:n:3], s[1:n:3], s[2:n:3]
                half = a ^ b
                total, carry = half ^ c, (a & b) | (half & c)
                s = np.concatenate([total, s[n:]])
            else:
                total, carry = s[0:1] ^ s[1:2], s[0:1] & s[1:2]
                s = total
            if w + 1 == len(stacks):
                stacks.append(carry)
            else:
                stacks[w + 1] = np.concatenate([stacks[w + 1], carry])
        out.append(s[0] if len(s) else None)
        w += 1
    return out


def _top(slices, allowed, k):
    """Row numbers of the k highest sums among ``allowed``, from the most
    significant slice down; rows still tied at the end come in row order."""
    import numpy as np

    count = lambda m: int(np.bitwise_count(m).sum())
    sure, tied = np.zeros_like(allowed), allowed
    n_sure = 0
    for s in reversed(slices):
        ones = tied & s if s is not None else np.zeros_like(tied)
        n = count(ones)
        if n_sure + n > k:
            tied = ones
        else:
            sure, n_sure = sure | ones, n_sure + n
            tied = tied & ~s if s is not None else tied
            if n_sure == k:
                break
    rows = np.flatnonzero(np.unpackbits(sure))
    if n_sure < k:
        rows = np.concatenate([rows, np.flatnonzero(np.unpackbits(tied))[: k - n_sure]])
    return rows


def exact_codes(vectors):
    """floor(256 x) of doubles of any size: a matrix of Python integers."""
    import math

    import numpy as np

    out = np.empty((len(vectors), len(vectors[0])), dtype=object)
    for r, v in enumerate(vectors):  # a double beyond 2^53 is an integer
        out[r] = [int(x) * SCALE if abs(x) >= 1 << 53 else math.floor(x * SCALE) for x in v]
    return out


def inner(codes, q):
    """Exact inner products: longs where they fit, else Python integers."""
    if codes.dtype == object or q.dtype == object or not len(codes):
        return codes.astype(object) @ q.astype(object) if len(codes) else codes[:, 0]
    bound = int(abs(codes).max()) * int(abs(q).max()) * len(q)
    return codes @ q if bound < LONG else codes.astype(object) @ q.astype(object)


def search_any(rows, queries, k):
    """Top k of one block for each query, as ``search_block`` in the order of
    ``queries``, where rows and
    queries are each ``((codes, ids), (wide codes, wide ids))``; whatever is
    wide meets every row of the other side."""
    (codes, ids), (wide, wide_ids) = rows
    for part, (q_codes, q_ids) in enumerate(queries):
        sliced = search_block(codes, ids, q_codes, q_ids, k) if len(ids) and not part else None
        for q, q_id in zip(q_codes, q_ids):
            best = []
            if sliced is not None:
                _, found, score = next(sliced)
                best += zip(score.tolist(), found.tolist())
            elif len(ids):
                best += zip(inner(codes, q).tolist(), ids.tolist())
            if len(wide_ids):
                best += zip(inner(wide, q).tolist(), wide_ids.tolist())
            if sliced is None or len(wide_ids):
                best = sorted(((s, i) for s, i in best if i != q_id), key=lambda x: (-x[0], x[1]))[:k]
            yield q_id, [i for _, i in best], [s for s, _ in best]


def search_block(codes, ids, q_codes, q_ids, k):
    """Top k of one block of rows (in id order) for each query: yields
    (query id, row ids, scores).  A query's own row takes no part."""
    import numpy as np

    low, maps = _slices(codes)
    d, bits, width = maps.shape
    everyone = np.packbits(np.ones(len(ids), dtype=np.uint8))
    everyone = np.pad(everyone, (0, width - len(everyone)))
    inverse = ~maps  # q < 0 adds |q| times the complement, a shift of the sum by a constant
    for q, q_id in zip(q_codes, q_ids):
        by_weight: dict[int, list] = {}
        size, negative = np.abs(q), q < 0
        for b in range(int(size.max()).bit_length() if len(size) else 0):
            has = (size >> b) & 1 == 1
            plus, minus = np.flatnonzero(has & ~negative), np.flatnonzero(has & negative)
            for v in range(bits):
                by_weight.setdefault(b + v, []).extend([maps[plus, v], inverse[minus, v]])
        empty = np.zeros((0, width), dtype=np.uint8)
        stacks = [np.concatenate(by_weight[w]) if w in by_weight else empty for w in range(max(by_weight, default=-1) + 1)]
        allowed = everyone.copy()
        own = np.flatnonzero(ids == q_id)
        np.bitwise_and.at(allowed, own >> 3, ~(1 << (7 - (own & 7))).astype(np.uint8))  # rows of one id may share a byte
        rows = _top(_add_slices(stacks), allowed, k)
        score = inner(codes[rows], q)
        order = np.lexsort((ids[rows], -score)) if score.dtype != object else sorted(range(len(rows)), key=lambda x: (-score[x], ids[rows[x]]))
        yield q_id, ids[rows][order], score[order]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
          rows_per_block: int = ROWS_PER_BLOCK, queries_per_block: int = QUERIES_PER_BLOCK) -> DataFrame:
    """The ``k`` rows with the highest integer inner product for every query.

    Each component x becomes floor(256 x).  Rows are dealt into blocks by
    their number in the input, so an id that repeats does not fill one; a block is indexed as one bitmap per attribute and bit.
    A query's score is the sum of the attributes' slices, shifted and added
    by its own bits with bitmap arithmetic; the best rows of a block are
    selected on the sum's slices from the most significant down, boundary
    ties in id order, and their scores recomputed exactly.  A query's results
    from the blocks meet in one window of k rows per block.  Blocks of queries
    meet blocks of rows, so neither side is broadcast or gathered.  Vectors
    with components beyond +-2^46 are scored one by one with integers of any
    size.  Ranks are exact for all; a score that no long holds is null.

    Null vectors and those with null or non-finite components or a null id
    take no part; vectors meet only those of their
    own length; a row with the query's id is never its result.  Rows alike in
    id and vector are ranked one after the other, and query rows of one id are
    queries of their own, each with its k results.  Empty input gives an empty
    result.  Returns ``(query_id, rank, <id_col>, score)``, ranks from 1,
    ties to the smaller id.
    """
    def coded(df):
        v = F.col(vector_col)
        large = F.exists(v, lambda x: F.abs(x) > LARGEST)
        code = F.when(~large, F.transform(v, lambda x: F.floor(x.cast("double") * SCALE).cast("long")))
        wide = F.when(large, v.cast("array<double>"))
        return df.where(finite_vector(v) & F.col(id_col).isNotNull()).select(
            F.col(id_col).cast("long").alias("id"), code.alias("code"), wide.alias("wide"), F.size(v).alias("dim")).where("dim > 0")

    rows = materialise(coded(vectors).withColumn("place", F.monotonically_increasing_id()))
    asked = materialise(coded(queries).withColumn("asked", F.monotonically_increasing_id()))
    counts = [df.count() for df in (rows, asked)]
    row_blocks, query_blocks = (max(1, -(-n // size)) for n, size in zip(counts, (rows_per_block, queries_per_block)))
    block = lambda number, n: F.pmod(F.xxhash64(number), F.lit(n)).cast("int")

    def grid(df, number, own, n, other, m):
        return df.withColumn(own, block(number, n)).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1)))).groupBy("dim", "rb", "qb")

    left, right = grid(rows, "place", "rb", row_blocks, "qb", query_blocks), grid(asked, "asked", "qb", query_blocks, "rb", row_blocks)

    def search(r, q):
        import numpy as np
        import pyarrow as pa

        schema = pa.schema([("asked", pa.int64()), ("query_id", pa.int64()), ("id", pa.int64()), ("side", pa.int32()), ("score", pa.int64()), ("beyond", pa.binary())])
        if not r.num_rows or not q.num_rows:
            return schema.empty_table()

        def matrices(t):
            import pyarrow.compute as pc

            small = t.filter(pc.is_valid(t.column("code")))
            large = t.filter(pc.is_valid(t.column("wide")))
            codes = small.column("code").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            parts = [(codes.reshape(small.num_rows, -1) if small.num_rows else codes.reshape(0, 1), small.column("id").to_numpy())]
            wide = large.column("wide").to_pylist()
            parts.append((exact_codes(wide) if wide else np.empty((0, 1), dtype=object), large.column("id").to_numpy()))
            orders = [np.argsort(ids, kind="stable") for _, ids in parts]
            numbers = [p.column("asked").to_numpy()[o] for p, o in zip((small, large), orders)] if "asked" in t.column_names else []
            return [(c[o], ids[o]) for (c, ids), o in zip(parts, orders)], np.concatenate([*numbers, np.empty(0, np.int64)]).tolist()

        def beyond(s):  # bytes in the order of the integers of one sign
            size = (abs(s).bit_length() + 7) // 8
            b = size.to_bytes(4, "big") + abs(s).to_bytes(size, "big")
            return b if s > 0 else bytes(255 - x for x in b)

        block, (asked_block, numbers) = matrices(r)[0], matrices(q)
        found = [(int(i), row, s, number) for number, (i, rows, scores) in zip(numbers, search_any(block, asked_block, k)) for row, s in zip(rows, scores)]
        side = [0 if -LONG <= f[2] < LONG else 1 if f[2] > 0 else -1 for f in found]
        return pa.table([pa.array([f[3] for f in found], pa.int64()), pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()), pa.array(side, pa.int32()),
                         pa.array([None if x else f[2] for f, x in zip(found, side)], pa.int64()),
                         pa.array([beyond(f[2]) if x else None for f, x in zip(found, side)], pa.binary())], schema=schema)

    found = left.cogroup(right).applyInArrow(search, "asked long, query_id long, id long, side int, score long, beyond binary")
    best = Window.partitionBy("asked").orderBy(F.desc("side"), F.desc("score"), F.desc("beyond"), "id")
    found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
