"""Embedding near-duplicates and top-k search against brute force."""

import numpy as np
import pytest

from keepcurve.llm.embedding_dedup import near_duplicate_vectors, quantise
from keepcurve.llm.topk import top_k
from tests.llm import edge_tables


def valid(v, zero_ok):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and (zero_ok or any(v))


def brute_components(rows, threshold=0.9):
    good = [(k, i, np.array(v, dtype=float)) for k, (i, v) in enumerate(rows) if i is not None and valid(v, False)]
    root, links = {k: k for k, *_ in good}, {k: 0 for k, *_ in good}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, (k, _, x) in enumerate(good):
        for m, _, y in good[a + 1:]:
            if len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                links[k] += 1
                links[m] += 1
                root[find(k)] = find(m)
    least = {}
    for k, i, _ in good:
        least[find(k)] = min(i, least.get(find(k), i))
    return sorted((str(i), links.get(k, 0), str(least[find(k)] if k in root else i)) for k, (i, _) in enumerate(rows))


def answers(df):
    return sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"])) for r in df.collect())


def test_awkward_vectors(spark):
    t = edge_tables.embeddings()
    rows = list(zip(t["vec_id"].to_pylist(), t["embedding"].to_pylist()))
    df = spark.createDataFrame([(i, v) for i, v in rows], "vec_id long, embedding array<float>")
    got = near_duplicate_vectors(df, rows_per_strip=2)
    assert answers(got) == brute_components(rows)
    assert all(r["kept"] == (r["vec_id"] is not None and r["vec_id"] == r["component_id"]) for r in got.collect())


def test_clusters_chains_and_copies_over_many_tiles(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16))
    x = [c + rng.normal(size=16) * s for c in centres for s in (0.05, 0.2, 0.3, 0.35, 0.4) for _ in range(6)]
    angle = np.cumsum(np.full(30, np.arccos(0.9) * 0.999))  # a chain of links just above the threshold
    x += [np.r_[np.cos(a), np.sin(a), np.zeros(14)] for a in angle[:12]]
    x += [x[0]] * 40 + [x[1] * 7.5] * 3
    rows = [(int(k * 13 % 1009), [float(np.float32(c)) for c in v]) for k, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert answers(near_duplicate_vectors(df, rows_per_strip=37)) == brute_components(rows)


def test_quantisation_error_is_bounded():
    x = np.random.default_rng(5).normal(size=(300, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    codes, scale, length, error = quantise(x)
    approx = codes * scale[:, None]
    bound = length[:, None] * error[None] + error[:, None] * (length + error)[None]
    assert (np.abs(x @ x.T - approx @ approx.T) <= bound + 1e-12).all()


def brute_top(rows, k):
    good = [(i, [int(np.floor(256 * float(c))) for c in v]) for i, v in rows if i is not None and valid(v, True)]
    out = []
    for q, x in good:
        if q % 50 == 0:
            found = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in good if i != q and len(x) == len(y))  # a row of good: a query of its own
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(16_384, 256), (7, 2)])
def test_top_k_equals_brute_force(spark, blocks):
    rng = np.random.default_rng(1)
    t = edge_tables.embeddings()
    rows = [(i, v) for i, v in zip(t["vec_id"].to_pylist(), t["embedding"].to_pylist())]
    rows += [(50, [0.3, 0.2, 0.9])] * 9 + [(0, [float(k), -1.0, 0.5]) for k in range(4)] + [(12, [0.0, 0.5, 0.5])] * 3  # ids that repeat
    rows += [(1000 + k, [float(np.float32(c)) for c in rng.normal(size=3) * 10.0 ** rng.integers(-3, 3)]) for k in range(120)]
    rows += [(2000 + k, [0.5, -0.25, 0.125]) for k in range(9)] + [(3000, [0.0, 0.0, 0.0]), (3050, [-0.001, 0.0, 0.001])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = top_k(df, df.where("vec_id % 50 = 0"), 5, rows_per_block=blocks[0], queries_per_block=blocks[1])
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got.collect())
    assert got == brute_top(rows, 5)
    assert sum(q == 50 for q, *_ in got) == 10 * 5 and not any(q == i for q, _, i, _ in got)


def test_rows_of_the_query_id_in_one_byte_are_no_results(spark):
    rows = [(50, [1.0, 1.0])] * 3 + [(k, [0.1 * k, 0.2]) for k in range(1, 9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = top_k(df, df.where("vec_id % 50 = 0")).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == brute_top(rows, 5)
    assert len(got) == 15


def test_query_sql_with_repeated_ids(spark, tmp_path):
    import duckdb
    import pyarrow as pa
    import pyarrow.parquet as pq

    from keepcurve.llm.queries import ORACLES, QUERIES
    from tools.check_oracles import rows_of

    rows = [(50, [1.0, 1.0])] * 3 + [(0, [0.5, 2.0]), (0, [2.0, -1.0])] + [(k, [0.1 * k, 0.2]) for k in range(1, 9)]
    t = pa.table({"vec_id": pa.array([r[0] for r in rows], pa.int64()), "embedding": pa.array([r[1] for r in rows], pa.list_(pa.float32()))})
    pq.write_table(t, f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet')")
    assert rows_of(QUERIES["op4_topk_search"](spark, str(tmp_path)).toPandas()) == rows_of(con.execute(ORACLES["op4_topk_search"]).df())


def test_search_keeps_large_components(spark):
    import math

    rng = np.random.default_rng(5)
    rows = [(k, [float(x) * size for x in rng.normal(size=3)]) for k, size in enumerate([1, 1e4, 1e7, 1e10, 1e15, 1e25, 1e38, 1e150, 1e300] * 3)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    code = {k: [math.floor(x * 256) if abs(x) < 2 ** 53 else int(x) * 256 for x in e] for k, e in rows}
    want = []
    for q in code:
        ranked = sorted((-sum(a * b for a, b in zip(code[q], code[k])), k) for k in code if k != q)[:5]
        want += [(q, n + 1, k, -s if -2 ** 63 <= -s < 2 ** 63 else None) for n, (s, k) in enumerate(ranked)]
    assert sorted(tuple(r) for r in top_k(v, v, rows_per_block=8, queries_per_block=8).collect()) == sorted(want)
