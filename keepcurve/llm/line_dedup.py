"""Removing cross-site boilerplate lines, judged by their spread over sites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepcurve.llm.common import bounded_batches, connected_components, materialise, word_count

MIN_SITES = 5
# A line counts if it has this many words or, as in scripts that write none apart, characters.
MIN_WORDS = 3
MIN_CHARS = 16
BLANKS = " \t\n\x0b\x0c\r"
# With copies counted once (the pipeline's stage) also this share of a line's documents must have surroundings of their own.
CONTEXT_SHARE = 0.5
SKETCH_LG_K = 12
# An estimate this close to a bound (relative, and at least 1) is counted exactly; three standard errors are 5 %.
NEAR = 0.1
# Copies of a text, edited or not: this share of MinHash values of their words agrees; texts meet in bands.
COPY_SHARE = 0.7
BANDS, BAND = 32, 4


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def _lines(docs: DataFrame, id_col: str, text_col: str, site_col: str, min_words: int, min_chars: int) -> DataFrame:
    """A row per line of ``min_words`` words or ``min_chars`` characters: ``(id, text_hash, doc, site, pos,
    line, context, other)``.  ``line`` is the md5 of the line without blanks
    around it, ``context`` a hash of the lines before and after, ``other`` one
    of the document's smallest line digest (a MinHash of its lines)."""
    d = docs.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text_hash"), F.xxhash64(F.col(site_col)).alias("site"),
        F.split(F.col(text_col), "\n").alias("lines"))
    d = d.withColumn("digests", F.transform("lines", lambda x: F.md5(_bare(x))))
    d = d.select("id", "text_hash", F.xxhash64("id", "text_hash").alias("doc"), "site", "digests",
                 F.xxhash64(F.array_min("digests")).alias("other"), F.posexplode("lines").alias("pos", "body"))
    context = F.xxhash64(F.get("digests", F.col("pos") - 1), F.get("digests", F.col("pos") + 1))
    long_enough = (word_count(F.col("body")) >= min_words) | (F.length(_bare(F.col("body"))) >= min_chars)
    return d.where(long_enough).select("id", "text_hash", "doc", "site", "pos", F.get("digests", "pos").alias("line"), context.alias("context"), "other")


def copy_groups(texts: DataFrame) -> DataFrame:
    """``(text_hash, group)`` for the distinct ``texts(text_hash, text)``:
    texts whose word sets overlap by about ``COPY_SHARE`` are linked, and a
    group is a component of the links.  Within a band's bucket each text is
    compared with the smallest and the largest hash only, so a bucket costs
    no more than its size."""
    def run(stream):
        import numpy as np
        import pyarrow as pa
        from xxhash import xxh64_intdigest

        odd = np.random.default_rng(1).integers(1, 1 << 62, BANDS * BAND, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        for batch in stream:
            out = []
            for t in batch.column(1):
                h = np.array([xxh64_intdigest(w) for w in set(t.as_py().lower().split()) or {b""}], dtype=np.uint64)
                out.append([int((h * k).min() >> np.uint64(1)) for k in odd])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.int64()))], ["text_hash", "sketch"])

    sketches = materialise(texts.select("text_hash", F.col("text").cast("binary").alias("text")).mapInArrow(run, "text_hash long, sketch array<long>"))
    bands = F.expr(f"transform(sequence(0, {BANDS - 1}), b -> xxhash64(b, slice(sketch, b * {BAND} + 1, {BAND})))")
    keys = sketches.select("text_hash", F.explode(bands).alias("key"))
    ends = keys.groupBy("key").agg(F.min("text_hash").alias("a"), F.max("text_hash").alias("z")).where("a <> z")
    pairs = keys.join(ends, "key").select("text_hash", F.explode(F.array("a", "z")).alias("other")).where("text_hash <> other").distinct()
    pairs = pairs.join(sketches, "text_hash").join(sketches.selectExpr("text_hash AS other", "sketch AS other_sketch"), "other")
    agree = F.size(F.filter(F.zip_with("sketch", "other_sketch", lambda x, y: x == y), lambda x: x))
    links = pairs.where(agree >= COPY_SHARE * BANDS * BAND).select(F.col("text_hash").alias("src"), F.col("other").alias("dst"))
    found = connected_components(links)
    return sketches.join(found, sketches["text_hash"] == found["node"], "left").select("text_hash", F.coalesce("component", "text_hash").alias("group"))


def boilerplate_lines(lines: DataFrame, min_sites: int = MIN_SITES, context_share: float = 0.0, texts: DataFrame | None = None) -> DataFrame:
    """Lines spread over ``min_sites`` or more distinct sites in as many
    distinct surroundings (copies of one surrounding count once), or, if
    ``context_share`` is given, that share of their documents if it is more:
    ``(line, first)`` with the line's first place.  Surroundings differ in the
    neighbouring lines or, for the inner lines of a passage, which always has
    the same neighbours, in the documents' MinHash values, which copies of one
    document mostly share.

    Lines that occur less often than that cannot qualify and drop at once.
    For the rest HyperLogLog sketches of sites, surroundings and documents
    merge per line; where an estimate is near its bound, the distinct values
    are counted exactly.

    With ``texts(id, text_hash, text)`` a line also qualifies by the groups of
    copies it stands in (``copy_groups``), a group counted once whatever its
    size: ``min_sites`` sites and as many groups, however long the passage and
    however often a document is copied.
    """
    often = materialise(lines.groupBy("line").agg(F.count("*").alias("n")).where(F.col("n") >= min_sites).select("line"))
    often = materialise(lines.join(often, "line"))
    estimate = lambda c: F.hll_sketch_estimate(F.hll_sketch_agg(c, F.lit(SKETCH_LG_K)))
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash", "pos")).alias("first")
    s = materialise(often.groupBy("line").agg(estimate("site").alias("sites"), estimate("context").alias("contexts"), estimate("other").alias("others"), estimate("doc").alias("docs"), first))
    bound = F.greatest(F.lit(float(min_sites)), F.col("docs") * F.lit(float(context_share)))
    near = lambda value, limit: F.abs(value - limit) <= F.greatest(F.lit(1.0), limit * NEAR)
    close = near(F.col("sites"), F.lit(float(min_sites))) | near(F.col("contexts"), bound) | near(F.col("others"), bound)
    enough = (F.col("sites") >= min_sites) & (F.greatest("contexts", "others") >= bound)
    clear = s.where(~close & enough).select("line", "first")
    unsure = often.join(s.where(close).select("line"), "line")
    counted = [unsure.select("line", c).distinct().groupBy("line").agg(F.count("*").alias(n))
               for c, n in (("site", "sites"), ("context", "contexts"), ("other", "others"), ("doc", "docs"))]
    exact = counted[0].join(counted[1], "line").join(counted[2], "line").join(counted[3], "line").where(enough).select("line")
    found = clear.unionByName(s.join(exact, "line").select("line", "first"))
    if texts is None:
        return found
    found = materialise(found)
    # estimates of so few values are off by less than one
    open_lines = s.where((F.col("sites") >= min_sites - 1) & (F.col("docs") >= min_sites - 1)).join(found, "line", "left_anti").select("line")
    one = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id")).alias("one")
    rest = materialise(often.join(open_lines, "line").groupBy("line", "site", "text_hash").agg(one))
    for c in ("site", "text_hash"):
        wide = rest.select("line", c).distinct().groupBy("line").agg(F.count("*").alias("n")).where(F.col("n") >= min_sites)
        rest = rest.join(wide.select("line"), "line", "left_semi")
    rest = materialise(rest)
    held = rest.groupBy("text_hash").agg(F.min("one").alias("one")).select(F.col("one.id").alias("held_id"), F.col("text_hash").alias("held_hash"))
    held = texts.join(held, F.col("id").eqNullSafe(F.col("held_id")) & (F.col("text_hash") == F.col("held_hash")))
    groups = copy_groups(held.groupBy("text_hash").agg(F.first("text").alias("text")))
    spread = rest.join(groups, "text_hash").select("line", "group").distinct().groupBy("line").agg(F.count("*").alias("n")).where(F.col("n") >= min_sites)
    return found.unionByName(s.join(spread.select("line"), "line").select("line", "first"))


def _cut(docs: DataFrame, min_sites: int, min_words: int, min_chars: int, context_share: float, id_col: str, text_col: str, site_col: str,
         copies_once: bool) -> DataFrame:
    """``(row, text, n_lines, n_removed)``: each row of ``docs`` as a struct,
    whatever its columns are called, with its text after the cuts."""
    bounded_batches(docs.sparkSession)
    lines = materialise(_lines(docs, id_col, text_col, site_col, min_words, min_chars))
    texts = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text_hash"), F.col(text_col).alias("text"))
    spread = materialise(boilerplate_lines(lines, min_sites, context_share, texts if copies_once else None))
    here = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("text_hash") == F.col("first.text_hash")) & (F.col("pos") == F.col("first.pos"))
    cut = lines.join(spread, "line").where(~here).groupBy("id", "text_hash").agg(F.collect_set("pos").alias("cut_lines"))
    cut = cut.withColumnsRenamed({"id": "cut_id", "text_hash": "cut_hash"})
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[id_col].alias("id"), F.xxhash64(docs[text_col]).alias("text_hash"))
    j = whole.join(cut, F.col("id").eqNullSafe(F.col("cut_id")) & (F.col("text_hash") == F.col("cut_hash")), "left")
    text = F.col("row").getField(text_col)
    all_lines = F.split(text, "\n")
    left = F.array_join(F.filter(all_lines, lambda x, k: ~F.array_contains(F.col("cut_lines"), k)), "\n")
    return j.select("row", F.when(F.col("cut_lines").isNull(), text).otherwise(left).alias("text"),
                    F.when(text.isNull(), 0).otherwise(F.size(all_lines)).alias("n_lines"), F.coalesce(F.size("cut_lines"), F.lit(0)).alias("n_removed"))


def remove_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, min_words: int = MIN_WORDS, min_chars: int = MIN_CHARS,
                       context_share: float = 0.0, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", copies_once: bool = False) -> DataFrame:
    """``docs`` with every boilerplate line cut but for its first place.

    A line (ASCII white space at its ends ignored) of ``min_words`` or more
    words or ``min_chars`` or more characters is boilerplate when it stands on
    at least ``min_sites`` sites in that many different surroundings (see
    ``boilerplate_lines``), however many copies of one document hold it too.
    The lines of whole documents copied from site to site keep their
    surroundings; those copies are duplicates, not boilerplate, and stay.  The place with the smallest (id, text hash,
    position) keeps the line, so no text is lost altogether.  With ``copies_once``
    lines also go that stand in ``min_sites`` groups of copies on as many sites.

    Adds ``n_lines`` and ``n_removed`` to the columns of ``docs``, of which
    columns called so give way; other columns pass unchanged whatever their
    names.  No row goes.  A null text stays null with 0 lines; a text that
    loses all its lines is empty; a null site is one site; rows alike in id
    and text are treated alike.  Empty input gives an empty result.
    """
    out = _cut(docs, min_sites, min_words, min_chars, context_share, id_col, text_col, site_col, copies_once)
    columns = [F.col("text").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns if c not in ("n_lines", "n_removed")]
    return out.select(*columns, "n_lines", "n_removed")


def without_boilerplate(docs: DataFrame, length_col: str | None = None, text_col: str = "text", **params) -> DataFrame:
    """``docs`` after the cuts of ``remove_boilerplate``, with its columns as
    they are; ``length_col``, if there is one, holds the length of the text in
    characters and follows it where lines go."""
    out = _cut(docs, **{"min_sites": MIN_SITES, "min_words": MIN_WORDS, "min_chars": MIN_CHARS, "context_share": CONTEXT_SHARE, "id_col": "doc_id", "site_col": "source",
                        "copies_once": False, **params}, text_col=text_col)
    columns = []
    for c in docs.columns:
        value = F.col("row").getField(c)
        if c == text_col:
            value = F.col("text")
        elif c == length_col:
            value = F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema[c].dataType)).otherwise(value)
        columns.append(value.alias(c))
    return out.select(*columns)
