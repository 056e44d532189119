"""Dual-tree search against brute force; bounds hold and prune."""

import math
import re
from collections import Counter

import numpy as np

from keepcurve.llm import lexical_search
from keepcurve.llm.lexical_search import DocBlock, ItemTree, impacts, item_tree, live_pairs, search
from tests.llm import edge_tables

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def brute(docs, items, k=50):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c in counts:
            m = 50 + 50 * sum(c.values()) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m))
                    for t in set(terms(text)) if c[t])
            if s > 0:
                found.append((-s, i is None, i or 0))
        out += [(str(item), r, str(None if x[1] else x[2]), -x[0]) for r, x in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


def answers(df):
    return sorted((str(r["item_id"]), r["rank"], str(r["doc_id"]), r["score"]) for r in df.collect())


ITEMS = [(1, "alpha1 Beta8 gamma, end of page"), (2, "Visit our other pages; idiot!"), (3, "nothing-like-it"), (4, None), (5, ""), (6, "..., !"),
         (1, "ünïcödé 漢字"), (None, "word one"), (7, "page page PAGE"), (1, "alpha1 Beta8 gamma, end of page")]


def test_awkward_rows(spark):
    t = edge_tables.documents()
    docs = list(zip(t["doc_id"].to_pylist(), t["text"].to_pylist()))
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS id", "2 AS n", "3 AS terms", "4 AS score", "5 AS item").repartition(5)
    items = spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("*", "1 AS id", "2 AS place", "3 AS block", "'x' AS terms")
    assert answers(search(df, items)) == brute(docs, ITEMS)
    assert answers(search(df, items, k=3)) == brute(docs, ITEMS, 3)
    assert search(df, items).columns == ["item_id", "rank", "doc_id", "score"]


def test_blocks_of_items_and_text_ids(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "ITEMS_PER_BLOCK", 2)
    monkeypatch.setattr(lexical_search, "TERMS_PER_BLOCK", 8)
    docs = [(f"d{k:03d}", " ".join(f"w{(k * j) % 23}" for j in range(1, 9))) for k in range(120)] + [("d000", "w1 w2"), ("zz", "w1 w2")]
    items = [(f"i{k}", f"w{k} w{k + 3} w{(k * 5) % 23} none{k}") for k in range(9)]
    df = spark.createDataFrame(docs, "doc_id string, text string").repartition(3)
    q = spark.createDataFrame(items, "item_id string, text string")
    counted = brute([(k, t) for k, (_, t) in enumerate(sorted(docs))], items, 7)
    names = [i for i, _ in sorted(docs)]
    assert answers(search(df, q, k=7)) == sorted((a, b, names[int(c)], d) for a, b, c, d in counted)
    assert lexical_search.item_blocks(q, "item_id", "text")[1] > 3


def test_ties_beyond_k_go_by_id(spark):
    docs = [(k * 7919 % 10_007, "same text here") for k in range(3000)] + [(20_000 + k, f"other {k} same") for k in range(500)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(9)
    q = spark.createDataFrame([(1, "same text"), (2, "other")], "item_id long, text string")
    assert answers(search(df, q)) == brute(docs, [(1, "same text"), (2, "other")])


def test_empty_tables(spark):
    df, q = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert search(df.limit(0), q).count() == 0 and search(df, q.limit(0)).count() == 0
    assert search(spark.createDataFrame([(1, None), (2, " ")], "doc_id long, text string"), q).count() == 0


def block_of(rng, n_docs=3000, n_cols=900):
    """Documents about one of 30 topics each, with some common terms."""
    topic = rng.integers(0, 30, n_docs)
    doc = np.repeat(np.arange(n_docs), 14)
    col = np.where(rng.random(len(doc)) < 0.7, topic[doc] * 29 + rng.integers(0, 29, len(doc)), 870 + rng.integers(0, 30, len(doc)))
    pairs, tf = np.unique(np.stack([doc, col], 1), axis=0, return_counts=True)
    return pairs[:, 0], pairs[:, 1], tf.astype(np.int64)


def test_pruned_pairs_hold_nothing_and_most_pairs_are_pruned():
    rng = np.random.default_rng(2)
    doc, col, tf = block_of(rng)
    df = np.bincount(col, minlength=900)
    weight = np.floor(1000 * np.log((2 * 3000 + 2) / (2 * df + 1))).astype(np.int64)
    terms_of = [list(rng.choice(np.r_[t * 29:t * 29 + 29], 6, replace=False)) + [870 + t] for t in range(30) for _ in range(2)]
    tree = item_tree(list(range(60)), terms_of, weight, df)
    assert isinstance(tree, ItemTree) and sorted(tree.numbers) == list(range(60))
    x = impacts(tf, np.full(len(tf), 14), 3000, 42_000)
    block = DocBlock(3000, doc, col, x, tree.weight)
    exact = np.stack([block.scores(c, np.arange(3000)) for c in tree.columns], 1)
    dense = np.zeros((3000, 900))
    dense[doc, col] = x
    want = np.stack([(dense[:, c] * weight[c]).sum(1) for c in tree.columns], 1)
    assert (exact == want[block.order]).all()
    least = np.maximum(np.sort(exact, axis=0)[-50], 1)
    count = [0, 0]
    alive = live_pairs(block, tree, least, count)
    for i in range(60):
        hit = np.flatnonzero(exact[:, i] >= least[i])
        assert alive[hit // lexical_search.DOC_LEAF, i].all()
    assert count[0] < 0.5 * count[1]


def test_integers_of_any_size():
    n, tf = np.array([10_000_000, 3]), np.array([9, 1])
    got = impacts(tf, n, 50_000_000_000, 25_000_000_000_000)
    want = [10 ** 9 * int(t) // (1000 * int(t) + 20 * (50 + 50 * int(c) * 50_000_000_000 // 25_000_000_000_000)) for t, c in zip(tf, n)]
    assert list(got) == want
