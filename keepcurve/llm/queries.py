"""The operators applied to the test tables, one query each, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keepcurve.llm.brown_lm import score_texts
from keepcurve.llm.common import remainder, table
from keepcurve.llm.embedding_dedup import near_duplicate_vectors
from keepcurve.llm.exact_dedup import exact_duplicates
from keepcurve.llm.language_id import fit_languages, identify
from keepcurve.llm.lexical_search import search
from keepcurve.llm.line_dedup import MIN_CHARS, MIN_SITES, MIN_WORDS, remove_boilerplate
from keepcurve.llm.merkle import build_manifest, folded, leaf_digest, proof_digest
from keepcurve.llm.mixing import mix_sources
from keepcurve.llm.packing import pack_documents
from keepcurve.llm.sharding import shard_documents
from keepcurve.llm.simhash import near_duplicates
from keepcurve.llm.topk import top_k
from keepcurve.llm.toxicity import fit_toxicity, score_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SHARD_BYTES = 1 << 20


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def tokenizer_path() -> str:
    """The vocabulary file that the packing query names."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op1_packing")
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())
    return p.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


VALID_VECTOR = ("embedding IS NOT NULL AND len(embedding) > 0 AND vec_id IS NOT NULL AND "
                "len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0")


@query("op2_embedding_dedup", f"""
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE {VALID_VECTOR} AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (
  SELECT a.vec_id AS s, b.vec_id AS t FROM v a JOIN v b
  ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
r(vec_id, reach) AS (
  SELECT vec_id, vec_id FROM v UNION SELECT r.vec_id, l.t FROM r JOIN l ON r.reach = l.s),
c AS (SELECT vec_id, min(reach) AS component_id FROM r GROUP BY vec_id),
n AS (SELECT s, count(*) AS n_links FROM l GROUP BY s)
SELECT e.vec_id, coalesce(n.n_links, 0) AS n_links, coalesce(c.component_id, e.vec_id) AS component_id,
       coalesce(coalesce(c.component_id, e.vec_id) = e.vec_id, false) AS kept
FROM embeddings e LEFT JOIN n ON n.s = e.vec_id LEFT JOIN c ON c.vec_id = e.vec_id
""")
def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


@query("op3_simhash_dedup")
def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query("op4_topk_search", f"""
WITH v AS (
  SELECT vec_id, row_number() OVER () AS asked, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings WHERE {VALID_VECTOR}),
s AS (
  SELECT a.asked, a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY asked ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
""")
def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = table(spark, sf_dir, "embeddings")
    return top_k(v, v.where("vec_id % 50 = 0"))


@query("op5_toxicity")
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels").where(remainder(5) != 0))
    scored = score_toxicity(docs, model)
    return scored.select("doc_id", (remainder(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op6_sharding", f"""
WITH r AS (
  SELECT doc_id, coalesce(strlen(text), 0) AS bytes,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT) AS h FROM documents),
t AS (
  SELECT d, h >> (60 - d) AS prefix, sum(bytes) AS sb, count(*) AS n
  FROM r, (SELECT unnest(range(0, 61)) AS d) GROUP BY d, h >> (60 - d)),
f AS (SELECT * FROM t WHERE sb <= {SHARD_BYTES} OR n = 1 OR d = 60),
p AS (
  SELECT r.doc_id, r.bytes, min_by(struct_pack(d := f.d, p := f.prefix, sb := f.sb), f.d) AS leaf
  FROM r JOIN f ON r.h >> (60 - f.d) = f.prefix GROUP BY r.doc_id, r.bytes, r.h)
SELECT doc_id, bytes, CASE WHEN leaf.d = 0 THEN '' ELSE right(lpad(bin(leaf.p), 64, '0'), CAST(leaf.d AS INTEGER)) END AS shard,
       CAST(leaf.d AS INTEGER) AS depth, CAST(leaf.sb AS BIGINT) AS shard_bytes, leaf.sb > {SHARD_BYTES} AS oversize FROM p
""")
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), SHARD_BYTES)


@query("op7_mixing", r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), 'null')) AS digest,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents),
s AS (SELECT source, sum(size) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w,
             2.0::DOUBLE * source_size::DOUBLE AS cap FROM s),
l AS (SELECT *, ((SELECT sum(source_size) FROM s)::DOUBLE * 1.5::DOUBLE
                 - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT source, source_size,
             CASE WHEN level * w >= cap THEN cap ELSE w * (SELECT arg_min(level, cap / w) FROM l WHERE level * w < cap) END AS target FROM l),
r AS (SELECT d.*, t.source_size, t.target,
             CASE WHEN t.source_size > 0 THEN t.target / t.source_size::DOUBLE ELSE 0 END AS each,
             row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.digest, d.doc_id) AS k,
             CAST('0x' || substr(md5('mix:' || coalesce(d.source, '')), 1, 7) AS BIGINT)::DOUBLE / 268435456 AS o
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST((floor(each * k + o) - floor(each * (k - 1) + o)) * size AS BIGINT) AS taken FROM r
""")
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mix_sources(table(spark, sf_dir, "documents"))
    return m.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@query("op8_language_id")
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, fit_languages(docs.where(remainder(5) != 0)))
    return found.select("doc_id", (remainder(5) == 0).alias("held_out"), "lang_pred", "score", "ambiguous")


BLANKS_SQL = "(' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"


@query("op9_line_dedup", rf"""
WITH t AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS a FROM documents WHERE text IS NOT NULL),
x AS (SELECT doc_id, source, a, unnest(range(1, len(a) + 1)) AS k, list_min(list_transform(a, lambda v: md5(trim(v, {BLANKS_SQL})))) AS other FROM t),
l AS (
  SELECT doc_id, source, k, trim(a[k], {BLANKS_SQL}) AS line, row(k > 1, trim(a[k - 1], {BLANKS_SQL}), k < len(a), trim(a[k + 1], {BLANKS_SQL})) AS context, other
  FROM x WHERE len(regexp_extract_all(a[k], '[^ 	-
]+')) >= {MIN_WORDS} OR length(trim(a[k], {BLANKS_SQL})) >= {MIN_CHARS}),
b AS (
  SELECT line, min(row(doc_id, k)) AS first FROM l GROUP BY line
  HAVING count(DISTINCT source) + max(CASE WHEN source IS NULL THEN 1 ELSE 0 END) >= {MIN_SITES}
     AND greatest(count(DISTINCT context), count(DISTINCT other)) >= {MIN_SITES}),
cut AS (SELECT l.doc_id, l.k FROM l JOIN b USING (line) WHERE row(l.doc_id, l.k) <> b.first),
kept AS (
  SELECT x.doc_id, string_agg(x.a[x.k], chr(10) ORDER BY x.k) AS text FROM x
  WHERE NOT EXISTS (SELECT 1 FROM cut WHERE cut.doc_id = x.doc_id AND cut.k = x.k) GROUP BY x.doc_id),
n AS (SELECT doc_id, count(*) AS n_removed FROM cut GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text,
       CAST(coalesce(len(string_split(d.text, chr(10))), 0) AS INTEGER) AS n_lines, CAST(coalesce(n.n_removed, 0) AS INTEGER) AS n_removed
FROM documents d LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)
""")
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_boilerplate(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


@query("op10_class_lm")
def op10_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_texts(docs, remainder(7) != 2)
    return scored.select("doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")


TERM_SQL = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


@query("op11_lexical_search", f"""
WITH q AS (SELECT DISTINCT item_id, unnest({TERM_SQL}) AS term FROM benchmark),
t AS (SELECT doc_id, unnest({TERM_SQL}) AS term FROM documents),
c AS (SELECT doc_id, term, CAST(count(*) AS BIGINT) AS tf FROM t GROUP BY doc_id, term),
d AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM c GROUP BY doc_id),
s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM d),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM c, s GROUP BY term, docs),
m AS (SELECT doc_id, 50 + (50 * n * docs) // terms AS m FROM d, s),
r AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM q JOIN c USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM r WHERE score > 0) WHERE rank <= 50
""")
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op12_exact_dedup", r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm)
""")
def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"), hash_all=True)


def _part(x: str) -> str:
    return f"coalesce(strlen(CAST({x} AS VARCHAR)) || ':' || CAST({x} AS VARCHAR), '-')"


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CRC32_SQL = """xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
  lambda a, b: list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))))"""


@query("op13_merkle_manifest", f"""
WITH RECURSIVE d AS (
  SELECT *, CASE WHEN {CRC32_SQL} % 5 = 0 THEN translate(text, '{UPPER}', '{LOWER}') ELSE text END AS changed FROM documents),
l AS (
  SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS idx,
         count(*) OVER (PARTITION BY source) AS n,
         sha256({" || ".join(_part(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))}) AS leaf,
         sha256({" || ".join(_part(c) for c in ("doc_id", "source", "lang", "n_chars", "changed"))}) AS other FROM d),
up(tree, level, idx, hash, n) AS (
  SELECT tree, 0, idx, leaf, n FROM l
  UNION ALL
  SELECT tree, level + 1, idx // 16, sha256(string_agg(hash, '' ORDER BY idx)), (n + 15) // 16 FROM up WHERE n > 1 GROUP BY tree, level, idx // 16, n),
subs AS (SELECT tree, hash AS subroot FROM up WHERE n = 1),
top(level, idx, hash, n) AS (
  SELECT 0, tree, subroot, (SELECT count(*) FROM subs) FROM subs
  UNION ALL
  SELECT level + 1, idx // 16, sha256(string_agg(hash, '' ORDER BY idx)), (n + 15) // 16 FROM top WHERE n > 1 GROUP BY level, idx // 16, n),
runs AS (
  SELECT tree, level, idx // 16 AS run, list(hash ORDER BY idx) AS members FROM up WHERE n > 1 GROUP BY tree, level, idx // 16
  UNION ALL
  SELECT -1, level, idx // 16, list(hash ORDER BY idx) FROM top WHERE n > 1 GROUP BY level, idx // 16),
walk(doc_id, tree, level, idx, acc, proof) AS (
  SELECT doc_id, tree, 0, idx, other, '' FROM l
  UNION ALL
  SELECT w.doc_id, w.tree, w.level + 1, w.idx // 16,
         sha256(array_to_string(r.members[1:w.idx % 16], '') || w.acc || array_to_string(r.members[w.idx % 16 + 2:], '')),
         w.proof || array_to_string(r.members[1:w.idx % 16], '') || array_to_string(r.members[w.idx % 16 + 2:], '')
  FROM walk w JOIN runs r ON r.tree = w.tree AND r.level = w.level AND r.run = w.idx // 16),
low AS (SELECT doc_id, tree, acc, proof FROM walk QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY level DESC) = 1),
walk2(doc_id, level, idx, acc, proof) AS (
  SELECT doc_id, 0, tree, acc, proof FROM low
  UNION ALL
  SELECT w.doc_id, w.level + 1, w.idx // 16,
         sha256(array_to_string(r.members[1:w.idx % 16], '') || w.acc || array_to_string(r.members[w.idx % 16 + 2:], '')),
         w.proof || array_to_string(r.members[1:w.idx % 16], '') || array_to_string(r.members[w.idx % 16 + 2:], '')
  FROM walk2 w JOIN runs r ON r.tree = -1 AND r.level = w.level AND r.run = w.idx // 16),
high AS (SELECT doc_id, acc, proof FROM walk2 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY level DESC) = 1)
SELECT l.doc_id, l.leaf, s.subroot, (SELECT hash FROM top WHERE n = 1) AS root, sha256(h.proof) AS proof_sha256, h.acc AS folded_root,
       h.acc = (SELECT hash FROM top WHERE n = 1) AS verified
FROM l JOIN subs s USING (tree) JOIN high h USING (doc_id)
""")
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lowered = F.translate("text", UPPER, LOWER)
    tampered = F.when(remainder(5) == 0, leaf_digest([*(F.col(c) for c in ("doc_id", "source", "lang", "n_chars")), lowered]))
    p = build_manifest(docs, carry={"tampered": tampered}).proofs()
    p = p.withColumn("folded_root", folded("path", F.coalesce("tampered", "leaf")))
    return p.select("doc_id", "leaf", "subroot", "root", proof_digest("path").alias("proof_sha256"), "folded_root",
                    (F.col("folded_root") == F.col("root")).alias("verified"))
