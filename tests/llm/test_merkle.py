"""Merkle manifest against a plain tree, and properties of its intervals."""

import hashlib
import random
import zlib

from pyspark.sql import functions as F

from keepcurve.llm.merkle import build_manifest, folded, proof_digest
from keepcurve.llm.queries import QUERIES
from tests.llm import edge_tables


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(hashes, fan_out):
    """Root, and per leaf the list of (left, right) siblings."""
    steps, place = [[] for _ in hashes], list(range(len(hashes)))
    while len(hashes) > 1:
        for k, at in enumerate(place):
            run = at // fan_out * fan_out
            steps[k].append(("".join(hashes[run:at]), "".join(hashes[at + 1:run + fan_out])))
        place = [at // fan_out for at in place]
        hashes = [h(*hashes[k:k + fan_out]) for k in range(0, len(hashes), fan_out)]
    return hashes[0], steps


def lower(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(rows, fan_out=16):
    """rows: (doc_id, source, lang, n_chars, text)."""
    first = lambda x: (x is not None, x if x is not None else 0)
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in order:
        g = sorted(groups[s], key=lambda r: (first(r[0]), leaf(r)))
        trees.append((g, *climb([leaf(r) for r in g], fan_out)))
    root, tops = climb([t[1] for t in trees], fan_out)
    out = []
    for (g, subroot, steps), top in zip(trees, tops):
        for r, own in zip(g, steps):
            path = own + top
            tamper = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            acc = leaf((*r[:4], lower(r[4]))) if tamper else leaf(r)
            for a, b in path:
                acc = h(a, acc, b)
            out.append((str(r[0]), leaf(r), subroot, root, h(*[a + b for a, b in path]), acc, acc == root))
    return sorted(out)


def answers(df):
    return sorted((str(r["doc_id"]), *(r[c] for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"))) for r in df.collect())


def test_query_on_awkward_rows(spark, tmp_path):
    t = edge_tables.documents()
    rows = list(zip(*[t[c].to_pylist() for c in ("doc_id", "source", "lang", "n_chars", "text")]))
    got = QUERIES["op13_merkle_manifest"](spark, edge_tables.write(tmp_path))
    assert answers(got) == brute(rows)


def test_sizes_around_powers_of_the_fan_out(spark):
    rng = random.Random(4)
    sizes = [1, 2, 3, 4, 5, 9, 10, 27, 28, 82, 1, 243]
    rows = [(1000 * g + k, f"s{g:02d}" if g else None, "en", k, f"Text {g} {k}") for g, n in enumerate(sizes) for k in range(n)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(7)
    m = build_manifest(df, fan_out=3)
    got = m.proofs().select("doc_id", "leaf", "subroot", "root", proof_digest("path").alias("proof"), folded("path", F.col("leaf")).alias("root2"))
    want = [(a, b, c, d, e) for a, b, c, d, e, *_ in brute(rows, 3)]
    assert sorted((str(r[0]), *r[1:5]) for r in got.collect()) == want
    assert all(r["root2"] == m.root for r in got.collect())

    nodes = [r.asDict() for r in m.nodes().collect()]
    for part in ("group", "top"):
        mine = [(r["lo"], r["hi"], r["level"]) for r in nodes if r["part"] == part]
        for lo, hi, level in mine:  # intervals nest: disjoint, or one in the other
            for lo2, hi2, level2 in mine:
                assert hi <= lo2 or hi2 <= lo or (level >= level2 and lo <= lo2 and hi2 <= hi) or (level <= level2 and lo2 <= lo and hi <= hi2)
    assert sum(r["hi"] - r["lo"] for r in nodes if r["part"] == "group" and r["level"] == 1) == sum(n for n in sizes if n > 1)


def test_one_row_one_group_and_none(spark):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    one = spark.createDataFrame([(7, "s", None, 1, "x")], schema)
    m = build_manifest(one)
    assert m.root == leaf((7, "s", None, 1, "x")) == m.proofs().first()["subroot"]
    assert m.proofs().select(proof_digest("path")).first()[0] == h("")
    many = spark.createDataFrame([(k, "s", "en", 1, "x") for k in range(40)], schema)
    m = build_manifest(many)
    assert m.root == brute([(k, "s", "en", 1, "x") for k in range(40)])[0][3] and m.nodes().count() == 4
    none = build_manifest(one.limit(0))
    assert none.root is None and none.proofs().count() == 0 and none.nodes() is None


def test_clashing_columns_are_ignored(spark):
    df = spark.createDataFrame([(k, f"s{k % 3}", "en", 1, "x") for k in range(20)], "doc_id long, source string, lang string, n_chars long, text string")
    wide = df.selectExpr("*", "1 AS key", "2 AS rank", "3 AS tree", "4 AS lo", "5 AS hi", "6 AS path", "7 AS g", "8 AS children", "9 AS n")
    assert build_manifest(wide).root == build_manifest(df).root
