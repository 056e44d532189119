"""Exact deduplication by progressive refinement, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepcurve.llm.common import materialise
from keepcurve.operators.bloom import flag_keys, key_bitmap, prefilter

SPACE_RE = r"[\x20\x09-\x0D]+"
PREFIX_CHARS = 256


def normalised(text) -> Column:
    """Null as empty; each run of ASCII white space as one space."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), SPACE_RE, " ")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = PREFIX_CHARS,
                     hash_all: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """Groups of rows whose texts are equal but for white space.

    Rows are grouped by the bytes of their normalised text; lengths that only
    one row has are done.  Of the others the hash of the first
    ``prefix_chars`` characters splits the groups, and again the rows alone in
    theirs are done.  Only what survives is read again and hashed in full
    (SHA-256), which decides.  The first pass writes a number and a hash per
    row; survivors of a level are found through a bitmap of fixed size, so no
    text is ever shuffled (a row let through by chance costs one more hash).
    Groups are counted with map-side partial sums; rows meet their group in a
    join that the adaptive skew join splits where a group is hot.

    Null texts count as empty, and empty texts are equal to each other.  Of
    equal texts the row with the smallest id stays, null ids after all others;
    of rows that agree in id and text exactly one stays.  Empty input gives an
    empty result.  Other columns take no part; ``carry`` names those to return.

    Returns ``(<id_col>, keep_id, group_size, kept, text_sha256, *carry)``, a
    row per input row; the digest is null for rows that were never hashed,
    unless ``hash_all``, which hashes every row but refines alike.
    """
    base = docs.select(F.col(id_col).alias("id"), normalised(text_col).alias("norm"), *[F.col(c).alias(f"carried_{c}") for c in carry])
    sized = base.withColumns({"bytes": F.octet_length("norm").cast("long"), "prefix": F.xxhash64(F.substring("norm", 1, prefix_chars))})
    keys = materialise(sized.select("bytes", "prefix"))
    lengths = keys.groupBy("bytes").agg(F.count("*").alias("n")).where("n > 1").select("bytes")
    prefixes = prefilter(keys, lengths, ["bytes"]).groupBy("bytes", "prefix").agg(F.count("*").alias("n")).where("n > 1")
    alive = flag_keys(sized, key_bitmap(prefixes, ["bytes", "prefix"]), ["bytes", "prefix"], "alive")
    digest = F.sha2(F.col("norm"), 256)
    rows = materialise(alive.select(
        "id", "bytes", "alive", F.monotonically_increasing_id().alias("place"), *[f"carried_{c}" for c in carry],
        (digest if hash_all else F.when(F.col("alive"), digest)).alias("full")))

    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), F.col("id").alias("first_id"), F.col("place").alias("first_place")))
    groups = rows.where("alive").groupBy("bytes", "full").agg(F.count("*").alias("size"), first.alias("f")).where("size > 1")
    groups = groups.select("bytes", "full", "size", "f.first_id", "f.first_place")
    together = rows.where("alive").join(groups, ["bytes", "full"], "left")
    alone = rows.where("NOT alive").withColumns({"size": F.lit(None).cast("long"), "first_id": F.lit(None).cast(docs.schema[id_col].dataType),
                                                 "first_place": F.lit(None).cast("long")})
    grouped = F.col("size").isNotNull()
    return together.unionByName(alone).select(
        F.col("id").alias(id_col),
        F.when(grouped, F.col("first_id")).otherwise(F.col("id")).alias("keep_id"),
        F.coalesce("size", F.lit(1).cast("long")).alias("group_size"),
        (~grouped | (F.col("place") == F.col("first_place"))).alias("kept"),
        F.col("full").alias("text_sha256"), *[F.col(f"carried_{c}").alias(c) for c in carry])


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that are exact copies of one that stays; all
    columns unchanged.  Rows are written once with a number of their own."""
    d = materialise(docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.monotonically_increasing_id().alias("row_number")))
    keyed = d.select(F.col(f"row.`{id_col}`").alias("id"), F.col(f"row.`{text_col}`").alias("text"), "row_number")
    dropped = exact_duplicates(keyed, "id", "text", carry=("row_number",)).where("NOT kept").select("row_number")
    return d.join(dropped, "row_number", "left_anti").select("row.*")
