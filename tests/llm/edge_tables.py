"""Small tables with the awkward rows: nulls in every column, empty and very
long texts, ties, repeated rows, and extra columns under names that the
operators use inside."""

import pyarrow as pa
import pyarrow.parquet as pq

EXTRA = ["id", "text_hash", "line", "word", "row", "n", "x", "h", "place", "copies", "first", "unit", "key", "digest", "component", "n_lines_"]
FOOT = "Visit our other pages for more offers today"


def documents(empty=False):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    rows = []
    for k in range(60):
        body = " ".join(words[(k * j) % 10] + str((k * 7 + j) % 50) for j in range(1, 40))
        rows.append((k, f"{body}\n{FOOT}\nend {k} of page", ["en", "de", None][k % 3], f"src{k % 7}"))
    rows += [(100, None, "en", "src0"), (101, "", "en", None), (None, "no id here at all", "de", "src1"), (102, " \t\n ", None, "src2"),
             (103, "one", "en", "src3"), (104, "ONE", "en", "src3"), (105, "1234 !!", "de", "src4"),
             (106, "idiot moron scum you are trash", "en", "src5"), (107, "word " * 30_000, "en", "src0"),
             (108, "漢字 ünïcödé 🙂   　x", "de", "src6"), (7, rows[7][1], "de", "src0")]
    rows += [(200 + k, rows[3][1], "en", f"src{k % 7}") for k in range(12)]
    rows += [rows[5]] * 3 + [(None, None, None, None)] * 2
    if empty:
        rows = []
    cols = {"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows], pa.string()),
            "lang": pa.array([r[2] for r in rows], pa.string()), "source": pa.array([r[3] for r in rows], pa.string()),
            "n_chars": pa.array([None if r[1] is None else len(r[1]) for r in rows], pa.int64())}
    cols |= {c: pa.array(["extra"] * len(rows), pa.string()) for c in EXTRA}
    return pa.table(cols)


def embeddings(empty=False):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0, 0.0]), (50, [0.99, 0.1, 0.0]), (1, [0.98, 0.15, 0.02]), (2, [0.0, 1.0, 0.0]), (3, [0.0, 2.0, 0.1]),
            (4, [0.0, 0.0, 0.0]), (5, None), (6, [nan, 1.0, 0.0]), (7, [inf, 0.0, 1.0]), (8, [1.0, None, 0.0]), (100, [0.99, 0.1, 0.0]),
            (9, [-1.0, 0.0, 0.0]), (10, [1.0, 0.0]), (11, []), (12, [1.0, 0.0, 0.0]), (13, [1.0, 0.0, 0.0]), (None, [1.0, 0.0, 0.0]), (12, [1.0, 0.0, 0.0])]
    if empty:
        rows = []
    cols = {"vec_id": pa.array([r[0] for r in rows], pa.int64()), "embedding": pa.array([r[1] for r in rows], pa.list_(pa.float32())),
            "label": pa.array([1] * len(rows), pa.int32())}
    cols |= {c: pa.array(["extra"] * len(rows), pa.string()) for c in ["id", "x", "node", "code", "rank", "score", "dim"]}
    return pa.table(cols)


def labels(empty=False):
    rows = [(k, 1, int(k % 10 == 0)) for k in range(60)] + [(106, 0, 1), (106, 0, 0), (None, 1, 1), (9, None, None)]
    if empty:
        rows = []
    return pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "quality": pa.array([r[1] for r in rows], pa.int32()),
                     "toxic": pa.array([r[2] for r in rows], pa.int32()), "part": pa.array(["extra"] * len(rows), pa.string())})


def benchmark(empty=False):
    rows = [(1, "alpha1 Beta8 end of page"), (2, None), (3, ""), (None, "word"), (1, "no id here"), (4, "..."), (4, "other pages " * 400)]
    if empty:
        rows = []
    return pa.table({"item_id": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows], pa.string()),
                     "terms": pa.array(["extra"] * len(rows), pa.string()), "block": pa.array(["extra"] * len(rows), pa.string())})


def write(folder, empty=False):
    for name, make in (("documents", documents), ("embeddings", embeddings), ("labels", labels), ("benchmark", benchmark)):
        pq.write_table(make(empty), f"{folder}/{name}.parquet")
    return str(folder)
