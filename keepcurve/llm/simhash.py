"""SimHash near-duplicates found by Golay-code fuzzy hashing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepcurve.llm.common import bounded_batches, connected_components, materialise

SHINGLE_WORDS = 3
MAX_DISTANCE = 2
SEED = 42
BITS = 64
HASHES_AT_ONCE = 1 << 16
# Probes in one bucket beyond which its fingerprints meet at midpoints instead.
BUCKET_PROBES = 16
# Generator polynomial of the binary Golay code (23, 12): x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GOLAY_GENERATOR = 0b110001110101
GOLAY_BITS, GOLAY_CHECKS = 23, 11


def golay_tables():
    """Error pattern (weight 0 to 3) by syndrome, and the syndrome of each
    single bit; the code is perfect, so the 2048 patterns of weight <= 3 have
    all 2048 syndromes."""
    import itertools

    import numpy as np

    def syndrome(word):
        for k in range(GOLAY_BITS - 1, GOLAY_CHECKS - 1, -1):
            if word >> k & 1:
                word ^= GOLAY_GENERATOR << (k - GOLAY_CHECKS)
        return word

    single = np.array([syndrome(1 << k) for k in range(GOLAY_BITS)], dtype=np.int64)
    errors = np.zeros(1 << GOLAY_CHECKS, dtype=np.int64)
    for w in range(4):
        for at in itertools.combinations(range(GOLAY_BITS), w):
            s = 0
            for k in at:
                s ^= int(single[k])
            errors[s] = sum(1 << k for k in at)
    return errors, single


def nearest_codewords(words, tables):
    """Index (12 message bits) of the codeword within 3 bits of each 23-bit word."""
    import numpy as np

    errors, single = tables
    s = np.zeros_like(words)
    for k in range(GOLAY_BITS):
        s ^= np.where(words >> k & 1, single[k], 0)
    return (words ^ errors[s]) >> GOLAY_CHECKS


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of a text's word shingles under XXH64, ASCII case folded;
    0 for a text without words."""
    import numpy as np
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle_words:
        words, k = [b" ".join(words)], 1
    else:
        k = shingle_words
    join = b" ".join
    shingles = map(join, zip(*(words[i:] for i in range(k)))) if k > 1 else iter(words)
    n = len(words) - k + 1
    ones = np.zeros(BITS, dtype=np.int64)
    done = 0
    while done < n:  # a slice at a time, whatever the text's length
        h = np.fromiter((xxh64_intdigest(x, SEED) for x, _ in zip(shingles, range(min(HASHES_AT_ONCE, n - done)))), dtype="<u8", count=min(HASHES_AT_ONCE, n - done))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        done += len(h)
    return int(sum(1 << b for b in np.flatnonzero(2 * ones > n).tolist()))


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``(id, fp)`` for every row; fp is the fingerprint as a signed long."""
    def run(stream):
        import pyarrow as pa

        for batch in stream:
            fps = [fingerprint(t.as_py() or b"", shingle_words) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f - (1 << 64) if f >> 63 else f for f in fps], pa.int64())], ["id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(run, "id long, fp long")


def keyed(distinct: DataFrame, max_distance: int) -> DataFrame:
    """``(fp, segment, part, code, probe)``: for each segment of a fingerprint
    the segment's own bits and codeword indices of the next segment, one row
    with probe true for the index of its nearest codeword, and rows with probe
    false for the indices of it and of all words one bit away (1 or 6)."""
    parts = max(max_distance + 1, 3)

    def run(stream):
        import numpy as np
        import pyarrow as pa

        tables = golay_tables()
        edges = [BITS * i // parts for i in range(parts + 1)]
        for batch in stream:
            fp = batch.column(0).to_numpy()
            u = fp.astype(np.uint64)
            seg = [((u >> np.uint64(lo)) & np.uint64((1 << (hi - lo)) - 1)).astype(np.int64) for lo, hi in zip(edges, edges[1:])]
            for s in range(parts):
                following = seg[(s + 1) % parts]
                near = nearest_codewords(following, tables)
                flips = np.stack([near, *(nearest_codewords(following ^ (1 << b), tables) for b in range(GOLAY_BITS))])
                flips.sort(axis=0)
                new = np.ones(flips.shape, dtype=bool)
                new[1:] = flips[1:] != flips[:-1]
                which = np.nonzero(new.T)
                code = np.concatenate([near, flips.T[which]])
                at = np.concatenate([np.arange(len(fp)), which[0]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fp[at]), pa.array(np.full(len(at), s, np.int32)), pa.array(seg[s][at]), pa.array(code),
                     pa.array(np.arange(len(at)) < len(fp))], ["fp", "segment", "part", "code", "probe"])

    return distinct.select("fp").mapInArrow(run, "fp long, segment int, part long, code long, probe boolean")


def fingerprint_links(distinct: DataFrame, max_distance: int = MAX_DISTANCE, bucket_probes: int = BUCKET_PROBES) -> DataFrame:
    """Links ``(a, b)`` whose components are those of all pairs of distinct
    fingerprints at ``max_distance`` or fewer bits.

    Pigeonhole over max_distance + 1 segments: among d errors some segment is
    free of errors and the next has at most one.  So one side's nearest
    codeword index of that next segment is among the other's indices of words
    one bit away; pairs meet on (segment, its bits, index) and are verified by
    the bit distance of the whole.  A bucket with more than ``bucket_probes``
    fingerprints would make pairs by its square.  Its members meet
    at midpoints instead: fingerprints at 2 or fewer bits share a word that is
    at most one bit from both, so each goes to the words one bit away and
    links with the smallest there.  That is exact for a distance of 2 and
    linear; for other distances the bucket's pairs are compared.
    """
    k = materialise(keyed(distinct, max_distance))
    key = ["segment", "part", "code"]
    probes, index = k.where("probe"), k.where("NOT probe").drop("probe")
    sizes = probes.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > (bucket_probes if max_distance == 2 else (1 << 62)))
    sizes = materialise(sizes)
    small = probes.drop("probe").join(sizes, key, "left_anti").withColumnRenamed("fp", "other")
    far = F.bit_count(F.col("fp").bitwiseXOR(F.col("other")))
    pairs = index.join(small, key).where((F.col("fp") != F.col("other")) & (far <= max_distance)).select(F.col("fp").alias("a"), F.col("other").alias("b"))
    # a crowded bucket holds the probes and whatever has its index among its keys
    crowded = index.join(sizes, key, "left_semi").select("fp").distinct()

    def midpoints(stream):
        import numpy as np
        import pyarrow as pa

        flips = np.concatenate([np.zeros(1, np.uint64), np.uint64(1) << np.arange(BITS, dtype=np.uint64)])
        for batch in stream:
            fp = batch.column(0).to_numpy()
            for lo in range(0, len(fp), 1024):
                part = fp[lo:lo + 1024]
                mid = (part.astype(np.uint64)[:, None] ^ flips[None, :]).astype(np.int64).ravel()
                yield pa.RecordBatch.from_arrays([pa.array(mid), pa.array(np.repeat(part, len(flips)))], ["mid", "fp"])

    at = crowded.mapInArrow(midpoints, "mid long, fp long")
    low = at.groupBy("mid").agg(F.min("fp").alias("a"), F.max("fp").alias("z")).where("a <> z").select("mid", "a")
    stars = at.join(low, "mid").where("fp <> a").select("a", F.col("fp").alias("b"))
    return pairs.unionAll(stars)


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint and near-duplicate class of every row.

    ASCII letters are lowered, words are runs of anything but ASCII white
    space, shingles keep repeats; texts with fewer words than a shingle are
    one shingle, null and empty texts have fingerprint 0, which links like
    any other.  Rows with equal fingerprints are one node, so copies are
    never expanded.  Component ids are the smallest id reachable; rows with a
    null id belong to their fingerprint's component, null if nothing there
    has an id.  Repeated rows stay.  Empty input gives an empty result.

    Returns ``(<id_col>, fingerprint, component_id)`` with the fingerprint as
    16 hex digits.
    """
    bounded_batches(docs.sparkSession)
    rows = materialise(fingerprints(docs, id_col, text_col, shingle_words))
    distinct = materialise(rows.groupBy("fp").agg(F.min("id").alias("id")))
    links = fingerprint_links(distinct, max_distance)
    components = connected_components(links.selectExpr("a AS src", "b AS dst"))
    nodes = distinct.join(components.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = nodes.groupBy("component").agg(F.min("id").alias("component_id"))
    nodes = nodes.join(least, "component").select("fp", "component_id")
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return rows.join(nodes, "fp").select(F.col("id").alias(id_col), hexed.alias("fingerprint"), "component_id")


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """``docs`` without its near-duplicates: of each class the row with the
    smallest id stays (one of them if that id repeats); a class without any
    id keeps one row.  All columns are unchanged."""
    d = materialise(docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.monotonically_increasing_id().alias("place")))
    rows = d.select("place", F.col(f"row.`{text_col}`").alias("text"))
    # places stand in for ids: unique, and ordered by the ids below
    classes = near_duplicates(rows, id_col="place", text_col="text", **params)
    ids = d.select("place", F.col(f"row.`{id_col}`").alias("id")).join(classes, "place")
    first = ids.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "place")).alias("first"))
    keep = first.select(F.col("first.place").alias("place"))
    return d.join(keep, "place", "left_semi").select("row.*")
