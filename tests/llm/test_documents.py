"""Sharding, mixing and line deduplication against brute force."""

import hashlib
import math
from collections import Counter, defaultdict

import pytest

from corpus_pipeline import line_dedup
from keepcurve.llm.line_dedup import remove_boilerplate
from keepcurve.llm.mixing import mix_sources, mixed_documents
from keepcurve.llm.sharding import shard_documents
from tests.llm import edge_tables


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    return spark.read.parquet(edge_tables.write(tmp_path_factory.mktemp("docs")) + "/documents.parquet")


def test_shards_fit_and_split_no_more_than_needed(spark, docs):
    limit = 2000
    got = shard_documents(docs, limit).collect()
    assert len(got) == docs.count()
    by_shard, prefixes = defaultdict(list), Counter()
    for r in got:
        by_shard[r["shard"]].append(r)
        for k in range(len(r["shard"]) + 1):
            prefixes[r["shard"][:k]] += r["bytes"]
    for shard, rows in by_shard.items():
        total = sum(r["bytes"] for r in rows)
        assert all(r["shard_bytes"] == total and r["depth"] == len(shard) for r in rows)
        assert total <= limit or (len(rows) == 1 and rows[0]["oversize"])
        if shard:  # the bucket above was too large
            assert prefixes[shard[:-1]] > limit
    keys = sorted(by_shard)
    assert not any(b.startswith(a) and a != b for a, b in zip(keys, keys[1:]))


def test_rows_with_one_id_are_spread_when_no_bit_separates_them(spark):
    df = spark.range(500).selectExpr("1L AS doc_id", "repeat('x', 100) AS text")
    got = shard_documents(df, 1000).groupBy("shard").sum("bytes").collect()
    assert len(got) >= 50 and all(r[1] <= 1000 for r in got)


def test_sharding_uses_no_python(docs):
    plan = shard_documents(docs, 2000)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def words(t):
    return len((t or "").encode().split())


def brute_targets(sizes, weights=(5.0, 2.0, 1.0), share=1.5, cap=2.0):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    left, free, target = share * sum(sizes.values()), set(order), {}
    while True:
        total = sum(w[s] for s in free)
        over = [s for s in free if left * w[s] / total > cap * sizes[s]]
        if not over:
            return target | {s: left * w[s] / total for s in free}
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
            free.discard(s)


def test_mix_equals_the_rule(docs):
    rows = docs.select("doc_id", "text", "source").collect()
    sizes = Counter()
    for r in rows:
        sizes[r["source"]] += words(r["text"])
    want = brute_targets(dict(sizes))
    got = mix_sources(docs).collect()
    assert len(got) == len(rows)
    taken, groups = Counter(), defaultdict(list)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and math.isclose(r["target"], want[r["source"]], rel_tol=1e-12, abs_tol=1e-9)
        assert 0 <= r["copies"] <= 2
        taken[r["source"]] += r["copies"] * r["size"]
        groups[r["source"]].append(r)
    assert sorted((str(r["doc_id"]), r["size"]) for r in got) == sorted((str(r["doc_id"]), words(r["text"])) for r in rows)
    for s, g in groups.items():
        assert abs(taken[s] - want[s]) <= max(r["size"] for r in g) + 1
        each = want[s] / sizes[s] if sizes[s] else 0.0
        offset = int(hashlib.md5(f"mix:{s or ''}".encode()).hexdigest()[:7], 16) / 16 ** 7
        g.sort(key=lambda r: (r["size"], hashlib.md5(str("null" if r["doc_id"] is None else r["doc_id"]).encode()).hexdigest()))
        assert sum(r["copies"] for r in g) == math.floor(each * len(g) + offset)
        for k, r in enumerate(g):
            if r["doc_id"] not in (5, 7, None):  # rows alike in id and text change places
                assert r["copies"] == math.floor(each * (k + 1) + offset) - math.floor(each * k + offset)


def test_mixed_documents_repeat_whole_rows(docs):
    got = mixed_documents(docs)
    assert got.columns == docs.columns
    plan = Counter()
    for r in mix_sources(docs).collect():
        plan[str(r["doc_id"]), str(r["source"])] += r["copies"]
    seen = Counter((str(r["doc_id"]), str(r["source"])) for r in got.collect())
    assert seen == +plan


def brute_lines(rows, min_sites=5, min_words=3, min_chars=16):
    at = defaultdict(list)
    for i, site, text in rows:
        if text is not None:
            lines = [x.strip(" \t\n\x0b\x0c\r") for x in text.split("\n")]
            other = min(hashlib.md5(x.encode()).hexdigest() for x in lines)
            for k, x in enumerate(lines):
                if words(x) >= min_words or len(x) >= min_chars:
                    around = (lines[k - 1] if k else None, lines[k + 1] if k + 1 < len(lines) else None)
                    at[x].append((i is None, i if i is not None else 0, k, site, around, (i, text), other))
    cut = set()
    for x, places in at.items():
        contexts = max(len({p[4] for p in places}), len({p[6] for p in places}))
        if len({p[3] for p in places}) >= min_sites and contexts >= min_sites:
            first = min(places, key=lambda p: p[:3])
            cut |= {(p[5], p[2]) for p in places if (p[5], p[2]) != (first[5], first[2])}
    return [(str(i), None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if ((i, t), k) not in cut)) for i, _, t in rows]


def test_boilerplate_goes_but_copied_documents_stay(docs):
    rows = [(r["doc_id"], r["source"], r["text"]) for r in docs.select("doc_id", "source", "text").collect()]
    got = remove_boilerplate(docs)
    assert got.columns == [*docs.columns, "n_lines", "n_removed"]
    have = sorted((str(r["doc_id"]), r["text"]) for r in got.collect() if r["text"] is not None)
    assert have == sorted(x for x in brute_lines(rows) if x[1] is not None)
    holding = [i for i, t in have if edge_tables.FOOT in t]
    assert set(holding) == {"0"}  # the first document keeps the line
    body = docs.where("doc_id = 3").first()["text"].split("\n")[0]
    assert sum(body in t for _, t in have) == sum(body in (r[2] or "") for r in rows) > 12  # a document copied to all sites keeps its lines


def test_lines_without_words_ends_of_lines_and_copies_of_a_page(spark):
    foot, dense, short = "a footer that all these pages carry", "0123456789" * 3, "Amen."
    rows = [(k, f"{own_line(k, 0)}\n{foot}{'\r' if k % 2 else ' '}\n{own_line(k, 1)}\n{dense}\n{own_line(k, 2)}\n\t{short}", f"s{k % 20}") for k in range(40)]
    page = "\n".join([*(own_line(999, j) for j in range(12)), foot, own_line(999, 12)])
    rows += [(1000 + k, page, f"s{k % 20}") for k in range(300)]  # far more copies than pages
    got = {r["doc_id"]: r["text"] for r in remove_boilerplate(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert sorted(got.items()) == [(int(i), t) for i, t in sorted(brute_lines([(i, s, t) for i, t, s in rows]), key=lambda x: int(x[0]))]
    assert [k for k, t in sorted(got.items()) if foot in t] == [k for k, t in sorted(got.items()) if dense in t] == [0]
    assert all(short in got[k] for k in range(40))  # below both bounds
    assert all(got[1000 + k] == page.replace(foot + "\n", "") for k in range(300))


def test_threshold_is_exact(spark):
    rows = [(k, f"line {x} of spread\nown text {k} {x}", f"s{k % sites}") for x, sites in enumerate(range(1, 12)) for k in range(x * 100, x * 100 + 30)]
    got = remove_boilerplate(spark.createDataFrame(rows, "doc_id long, text string, source string"), min_sites=6).collect()
    left = Counter(t.split("\n")[0] for t in (r["text"] for r in got) if t.startswith("line"))
    assert left == {f"line {x} of spread": 30 if x + 1 < 6 else 1 for x in range(11)}


def test_inner_lines_of_a_passage_go_too(spark):
    passage = [f"line {k} of a passage that many pages show" for k in range(5)]
    rows = []
    for k in range(40):
        own = [f"page {k} has {j} lines of its own words {k * j}" for j in range(12)]
        rows.append((k, "\n".join([*own[:6], *passage, *own[6:]]), f"s{k % 8}"))
    rows += [(100 + k, "\n".join(f"copied text line {j} here" for j in range(10)), f"s{k % 8}") for k in range(30)]
    got = {r["doc_id"]: r["text"] for r in remove_boilerplate(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert [k for k, t in sorted(got.items()) if any(p in t for p in passage)] == [0] and all(p in got[0] for p in passage)
    assert all(got[k] == t for k, t, _ in rows if k >= 100)


def own_line(k, j):
    return " ".join(f"own{k}x{j}y{i}" for i in range(8))


@pytest.mark.parametrize("n, size", [(6, 8), (2, 5)])
def test_stage_cuts_passages_longer_than_the_documents_own_text(spark, n, size):
    passage = [f"shared{j} words of passage line number{j} here now" for j in range(size)]
    rows = [(k, "\n".join([*(own_line(k, j) for j in range(n)), *passage, own_line(k, n)]), f"s{k % 20}") for k in range(200)]
    for k in range(60):  # near copies: two of twenty lines differ
        copy = [f"copied{j} text{j} of one{j} document{j} that{j} travels{j}" for j in range(20)]
        copy[k % 20], copy[(k + 9) % 20] = own_line(1000 + k, 0), own_line(1000 + k, 1)
        rows.append((1000 + k, "\n".join(copy), f"s{k % 20}"))
    got = {r["doc_id"]: r["text"] for r in line_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string, source string"), "").collect()}
    assert [k for k, t in sorted(got.items()) if any(p in t for p in passage)] == [0] and all(p in got[0] for p in passage)
    assert all(got[k] == t for k, t, _ in rows if k >= 1000)


def test_stage_cuts_a_footer_that_a_much_copied_document_carries(spark):
    foot, body = "a footer that all these pages carry", [own_line(999, j) for j in range(12)]
    rows = [(k, "\n".join([own_line(k, 0), own_line(k, 1), foot]), f"s{k % 20}") for k in range(40)]
    for k in range(120):  # copies, some with a line edited
        rows.append((1000 + k, "\n".join([own_line(1000 + k, 0) if k % 3 == 0 and j == k % 12 else x for j, x in enumerate(body)] + [foot]), f"s{k % 20}"))
    got = {r["doc_id"]: r["text"] for r in line_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string, source string"), "").collect()}
    assert [k for k, t in sorted(got.items()) if foot in t] == [0]
    assert all(got[k] == t.removesuffix("\n" + foot) for k, t, _ in rows if k)  # nothing else goes


def test_columns_of_any_name_pass_the_line_stage(spark):
    foot = "Visit our other pages for more offers today"
    rows = [(k, f"own words of page {k} here\n{foot}\nthe end of page {k}", f"src{k}") for k in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr(
        "*", "cast(length(text) AS int) AS n_chars", "777 AS n_removed", "'a' AS cut_id", "'b' AS cut_hash", "'c' AS cut_lines", "'d' AS row", "778 AS n_lines", "'e' AS id")
    out = line_dedup(spark, df, "")
    assert out.columns == df.columns
    got = {r["doc_id"]: r for r in out.collect()}
    for k, text, _ in rows:
        want = text if k == 0 else text.replace(foot + "\n", "")
        r = got[k]
        assert (r["text"], r["n_chars"], r["n_removed"], r["n_lines"]) == (want, len(want), 777, 778)
        assert [r[c] for c in ("cut_id", "cut_hash", "cut_lines", "row", "id")] == list("abcde")
    wide = remove_boilerplate(df)
    assert {r["n_removed"] for r in wide.collect()} == {0, 1} and wide.columns.count("n_removed") == 1
