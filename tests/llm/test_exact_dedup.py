"""Exact deduplication against brute force."""

import hashlib
import inspect
import re
from collections import defaultdict

from keepcurve.llm import exact_dedup
from keepcurve.llm.exact_dedup import exact_duplicates, without_copies
from tests.llm import edge_tables


def norm(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[norm(t)].append(i)
    keep = {t: min((x for x in ids if x is not None), default=None) for t, ids in groups.items()}
    return sorted(((str(i), str(keep[norm(t)]), len(groups[norm(t)]), hashlib.sha256(norm(t).encode()).hexdigest()) for i, t in rows))


def answers(df):
    return sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["text_sha256"]) for r in df.collect())


def test_awkward_rows(spark):
    t = edge_tables.documents()
    rows = list(zip(t["doc_id"].to_pylist(), t["text"].to_pylist()))
    rows += [(300, "a b"), (301, "a\t\n b"), (302, " a b"), (303, "a b"), (304, "A b"), (305, ""), (306, "  "), (307, " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS id", "2 AS size", "3 AS full", "4 AS place", "5 AS bytes")
    got = exact_duplicates(df, hash_all=True)
    assert answers(got) == brute(rows)
    kept = [norm(t) for t in [r["text"] for r in without_copies(df).collect()]]
    assert sorted(kept) == sorted({norm(t) for _, t in rows})
    assert without_copies(df).columns == df.columns


def test_kept_is_one_row_of_each_group(spark):
    rows = [(5, "x"), (5, "x"), (9, "x"), (None, "y"), (None, "y"), (None, "z"), (3, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = exact_duplicates(df, hash_all=True).collect()
    kept = sorted((str(r["doc_id"]), r["text_sha256"]) for r in got if r["kept"])
    h = {t: hashlib.sha256(t.encode()).hexdigest() for t in "xyz"}
    assert kept == sorted([("5", h["x"]), ("None", h["y"]), ("3", h["z"])])


def test_only_survivors_are_hashed_in_full(spark):
    same = "p" * 300  # equal lengths and prefixes, other ends
    rows = [(1, same + "a"), (2, same + "b"), (3, same + "a"), (4, "q" * 301), (5, "short"), (6, "q" * 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in exact_duplicates(df).collect()}
    assert {k for k, r in got.items() if r["text_sha256"]} >= {1, 2, 3}
    assert [got[k]["group_size"] for k in range(1, 7)] == [2, 1, 2, 1, 1, 1]
    assert [got[k]["keep_id"] for k in range(1, 7)] == [1, 2, 1, 4, 5, 6]
    assert got[5]["text_sha256"] is None and got[4]["text_sha256"] is None  # lengths and prefixes of their own


def test_hot_group_over_many_partitions(spark):
    rows = [(k, "copy of a page" if k % 3 == 0 else f"page {k % 50}") for k in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(40)
    assert answers(exact_duplicates(df, hash_all=True)) == brute(rows)


def test_text_ids_and_empty_input(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "x")], "doc_id string, text string")
    assert {r["keep_id"] for r in exact_duplicates(df).collect()} == {"a"}
    assert exact_duplicates(df.limit(0)).count() == 0 and without_copies(df.limit(0)).count() == 0


def test_main_path_has_no_python(spark):
    source = inspect.getsource(exact_dedup)
    assert not re.search(r"udf|pandas|arrow|\.rdd|mapIn|applyIn|collect\(", source, re.I)
