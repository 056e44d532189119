"""Histogram boosting against a plain booster, and its stopping rule."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from keepcurve.operators import boosting as bo
from keepcurve.operators.boosting import BoostParams, fit_boosted


def table(n=500, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 12, (n, 3)).astype(float)
    x[rng.random((n, 3)) < 0.15] = np.nan
    x[:, 2] = rng.integers(0, 3, n)  # never missing
    signal = np.nan_to_num(x[:, 0], nan=9) - 0.5 * np.nan_to_num(x[:, 1], nan=2)
    y = (signal + rng.normal(size=n) * 2 > 3).astype(float)
    w = np.where(y > 0, 1.7, 1.0)
    return x, y, w


def frame(spark, x, y, w):
    rows = [(k, *[None if np.isnan(v) else float(v) for v in r], float(a), float(b)) for k, (r, a, b) in enumerate(zip(x, y, w))]
    return spark.createDataFrame(rows, "key long, a double, b double, c double, y double, w double").repartition(5)


def brute(x, y, w, cuts, params):
    """Rows sorted out one split at a time."""
    m = np.full(len(y), 0.0 if params.loss == "logistic" else (y * w).sum() / w.sum())
    for _ in range(params.trees):
        p = 1 / (1 + np.exp(-m))
        g, h = (w * (p - y), w * p * (1 - p)) if params.loss == "logistic" else (w * (m - y), w)
        step = np.zeros(len(y))

        def grow(rows, depth):
            best = None
            G, H = g[rows].sum(), h[rows].sum()
            sc = lambda a, b: a * a / (b + params.l2)
            for f, edges in enumerate(cuts):
                for edge in [*edges, np.inf]:
                    for missing_left in (False, True):
                        v = x[rows, f]
                        left = np.where(np.isnan(v), missing_left, v <= edge)
                        a, b = g[rows][left].sum(), h[rows][left].sum()
                        if min(b, H - b) < params.min_child_weight:
                            continue
                        gain = round(sc(a, b) + sc(G - a, H - b) - sc(G, H), 8)
                        if gain > 1e-6 and (best is None or gain > best[0]):
                            best = gain, left
            if depth == params.depth or best is None:
                step[rows] = -params.rate * G / (H + params.l2)
            else:
                grow(rows[best[1]], depth + 1)
                grow(rows[~best[1]], depth + 1)

        grow(np.arange(len(y)), 0)
        m = m + step
    return 1 / (1 + np.exp(-m)) if params.loss == "logistic" else m


@pytest.mark.parametrize("loss", ["logistic", "squared"])
def test_equals_a_plain_booster(spark, monkeypatch, loss):
    monkeypatch.setattr(bo, "REFRESH", 2)
    x, y, w = table()
    params = BoostParams(trees=5, depth=3, rate=0.3, rows=1.0, columns=1.0, loss=loss)
    cuts = {"a": [2, 5, 8], "b": [1, 3, 6, 10], "c": [0, 1]}
    model = fit_boosted(frame(spark, x, y, w), ["a", "b", "c"], "y", "key", weight_col="w", params=params, cuts=cuts)
    got = {r["key"]: r["score"] for r in model.score(frame(spark, x, y, w), ["key"]).collect()}
    want = brute(x, y, w, list(cuts.values()), params)
    assert np.allclose([got[k] for k in range(len(y))], want, atol=1e-9)
    again = bo.BoostedModel.from_nodes(model.nodes(spark), ["a", "b", "c"], params)
    assert {r["key"]: r["score"] for r in again.score(frame(spark, x, y, w), ["key"]).collect()} == got


def test_stops_on_pr_auc_and_keeps_the_best_length(spark):
    x, y, w = table(1500, 3)
    df = frame(spark, x, y, w).withColumn("valid", F.col("key") % 4 == 0)
    params = BoostParams(trees=40, depth=3, rate=0.6, patience=4)
    model = fit_boosted(df.where("NOT valid"), ["a", "b", "c"], "y", "key", valid=df.where("valid"), weight_col="w", params=params)
    best = int(np.argmax(model.curve))
    assert model.n_trees == best + 1 and (len(model.curve) == 40 or len(model.curve) - 1 - best == 4)
    # the curve is the exact PR-AUC of the scores on the grid
    s = model.score(df.where("valid"), ["y"]).collect()
    grid = np.minimum((np.array([r["score"] for r in s]) * bo.SCORE_GRID).astype(int), bo.SCORE_GRID - 1)
    label = np.array([r["y"] for r in s])
    ap, tp = 0.0, 0
    for v in sorted(set(grid), reverse=True):
        tp = label[grid >= v].sum()
        ap += label[grid == v].sum() * tp / (grid >= v).sum()
    assert model.curve[best] == pytest.approx(ap / label.sum(), abs=1e-9)


def test_drawn_rows_and_columns_do_not_depend_on_partitioning(spark):
    x, y, w = table(400, 5)
    params = BoostParams(trees=3, depth=2)
    fits = [fit_boosted(frame(spark, x, y, w).repartition(n), ["a", "b", "c"], "y", "key", params=params) for n in (1, 7)]
    tables = [sorted(map(str, m.nodes(spark).selectExpr("tree", "node", "feature", "threshold", "missing_left", "round(value, 9)").collect())) for m in fits]
    assert tables[0] == tables[1]
    h = np.arange(200_000).astype(np.int64) * 7919
    assert abs(bo._drawn(h, 0.8, 42, 3).mean() - 0.8) < 0.01 and bo._drawn(h, 1.0, 42, 3).all()


def test_missing_values_find_their_side_and_empty_input(spark, tmp_path):
    rows = [(k, None if k % 3 == 0 else float(k % 2), float(k % 3 == 0)) for k in range(300)]
    df = spark.createDataFrame(rows, "key long, a double, y double")
    params = BoostParams(trees=20, depth=1, rate=0.5, rows=1.0, columns=1.0)
    model = fit_boosted(df, ["a"], "y", "key", params=params)
    got = {r["a"]: r["score"] for r in model.score(df, ["a"]).distinct().collect()}
    assert got[None] > 0.95 and got[0.0] < 0.05 and got[1.0] < 0.05
    none = fit_boosted(df.limit(0), ["a"], "y", "key", params=params)
    assert none.score(df, ["key"]).first()["score"] == 0.5
    bo.save_boosted(spark, model, str(tmp_path / "m"))
    assert {r["a"]: r["score"] for r in bo.load_boosted(spark, str(tmp_path / "m")).score(df, ["a"]).distinct().collect()} == got


def test_two_arms(spark):
    x, y, w = table(400, 6)
    df = frame(spark, x, y, w).withColumn("t", (F.col("key") % 2).cast("int"))
    params = BoostParams(trees=3, depth=2, loss="squared", rows=1.0, columns=1.0)
    cuts = {"a": [2, 5, 8], "b": [1, 3, 6, 10], "c": [0, 1]}
    effect = {r["key"]: r["predicted_uplift"] for r in bo.fit_boosted_learner(df, list("abc"), "t", "y", "key", params, cuts).effect(df, ["key"]).collect()}
    both = [bo.fit_boosted(df.where(F.col("t") == arm), list("abc"), "y", "key", params=params, cuts=cuts).score(df, ["key"]).collect() for arm in (1, 0)]
    want = [{r["key"]: r["score"] for r in s} for s in both]
    assert all(effect[k] == pytest.approx(want[0][k] - want[1][k]) for k in range(400))


def test_a_fit_reads_blocks_and_lets_them_go(spark, monkeypatch):
    """A level job meets a block per task, features x rows, not rows; blocks of any size give the same trees, and none stays cached."""
    df = spark.range(0, 900, 1, 3).select(F.col("id").alias("key"), (F.col("id") * 7 % 31).cast("double").alias("a"), F.when(F.col("id") % 5 > 0, F.col("id") % 11).cast("double").alias("b"),
                                          (F.col("id") * 7 % 31 > 15).cast("double").alias("y"))
    seen, level = [], bo._level_job
    monkeypatch.setattr(bo, "_level_job", lambda blocks, *a: seen.append(blocks.rdd.map(lambda x: x[0].shape).collect()) or level(blocks, *a))
    fit = lambda: fit_boosted(df, ["a", "b"], "y", "key", valid=df, params=BoostParams(trees=20, depth=2, rate=0.3)).nodes(spark).collect()
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    whole = fit()
    assert seen[0] == [(2, 1800)] and spark.sparkContext._jsc.getPersistentRDDs().size() == held
    monkeypatch.setattr(bo, "ROWS_PER_TASK", 300)
    small = fit()
    assert len(seen[-1]) > 1 and sum(n for _, n in seen[-1]) == 1800
    assert [r[:5] for r in small] == [r[:5] for r in whole] and all(x[5] is None or abs(x[5] - y[5]) < 1e-9 for x, y in zip(small, whole))


def test_sql_of_any_number_of_trees_is_the_booster():
    """The recursive SQL grows the trees that a plain booster grows."""
    import duckdb

    from keepcurve.plans.fit_sql import boost_levels_ctes

    x, y, w = table(300, 8)
    cuts = {"a": [2, 5, 8], "b": [1, 3, 6, 10], "c": [0, 1]}
    con = duckdb.connect()
    con.execute("CREATE TABLE t (key INT, a DOUBLE, b DOUBLE, c DOUBLE, y DOUBLE, w DOUBLE, fit BOOLEAN)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?, ?, ?, ?, true)",
                    [(k, *[None if np.isnan(v) else float(v) for v in r], float(a), float(b)) for k, (r, a, b) in enumerate(zip(x, y, w))])
    got = con.execute(f"WITH RECURSIVE {boost_levels_ctes('m', 't', cuts, 6, 3, 0.3)} SELECT 1 / (1 + exp(-m_)) FROM m ORDER BY key").fetchall()
    assert np.allclose([r[0] for r in got], brute(x, y, w, list(cuts.values()), BoostParams(trees=6, depth=3, rate=0.3)), atol=1e-9)


def test_boosted_vs_cox_grows_the_whole_classifier(spark, monkeypatch):
    """The query asks for all trees of the original classifier, as deep (grown few here, to save time)."""
    from keepcurve.plans import catalog_fits as cf

    rows = [(k % 60, f"period{1 + k // 60}", 100 + k * 37 % 900, k * 7 % 10 // 6, k * 7 % 10 // 6, k * 13 % 400, k % 5, k % 15, k % 80, k % 2, k % 90) for k in range(120)]
    pooled = spark.createDataFrame(rows, "msno long, period string, tenure_days int, is_churn int, label int, days_since_last_transaction int, "
                                         "n_cancellations_lifetime int, n_transactions_lifetime int, age int, gender_male int, last_payment_plan_days int")
    asked, fit = [], bo.fit_boosted
    monkeypatch.setattr(cf, "_pooled", lambda *a: pooled)
    monkeypatch.setattr(bo, "fit_boosted", lambda *a, params, **k: asked.append(params) or fit(*a, params=replace(params, trees=2), **k))
    assert cf.q_boosted_vs_cox(spark, "").count() == 3
    whole = BoostParams()
    assert [(p.trees, p.depth, p.rate, p.rows, p.columns) for p in asked] == [(whole.trees, whole.depth, whole.rate, 1.0, 1.0)]


def test_a_job_applies_no_tree_twice_where_tasks_are_large(spark, monkeypatch):
    """Margins follow the trees, so a level job finds none to apply; tasks are equal and one a core; the trees are those of small tasks."""
    cores = spark.sparkContext.defaultParallelism
    df = spark.range(0, 200 * cores, 1, 3).select(F.col("id").alias("key"), (F.col("id") * 7 % 31).cast("double").alias("a"), (F.col("id") * 7 % 31 > 15).cast("double").alias("y"))
    fit = lambda: fit_boosted(df, ["a"], "y", "key", params=BoostParams(trees=5, depth=2, rate=0.3)).nodes(spark).collect()
    whole = fit()
    late, tasks, level = [], [], bo._level_job
    monkeypatch.setattr(bo, "_level_job", lambda blocks, *a: late.append(len(blocks.late)) or tasks.append(blocks.rdd.getNumPartitions()) or level(blocks, *a))
    monkeypatch.setattr(bo, "ROWS_PER_TASK", 20)
    monkeypatch.setattr(bo, "ROWS_LATE", 1)
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    for direct in (1, 1 << 10):
        monkeypatch.setattr(bo, "DIRECT", direct)
        small = fit()
        assert [r[:5] for r in small] == [r[:5] for r in whole] and all(x[5] is None or abs(x[5] - y[5]) < 1e-9 for x, y in zip(small, whole))
    assert set(late) == {0} and set(tasks) == {cores} and spark.sparkContext._jsc.getPersistentRDDs().size() == held


def test_cut_points_of_each_column(spark):
    """A column's cut points are its values where they are few; without values, and without rows, there are none."""
    df = spark.createDataFrame([(float(k % 4), None, float("nan") if k % 2 else 7.0) for k in range(40)], "a double, b double, c double")
    assert bo.quantile_cuts(df, ["a", "b", "c"]) == {"a": [0.0, 1.0, 2.0, 3.0], "b": [], "c": [7.0]}
    assert bo.quantile_cuts(df.limit(0), ["a", "b"]) == {"a": [], "b": []}


def test_periods_come_from_one_pass(spark, monkeypatch, tmp_path):
    """The fitted queries' periods are the snapshots of each period, from one frame of both; retention_pipeline reads its sources once."""
    from keepcurve.plans import catalog_models as cm

    d = str(tmp_path)
    tables = {
        "customer": spark.range(1, 21).selectExpr("id AS c_custkey", "id % 3 AS c_nationkey", "CAST(id * 911 AS DOUBLE) AS c_acctbal", "'BUILDING' AS c_mktsegment"),
        "nation": spark.range(0, 3).selectExpr("id AS n_nationkey", "id % 2 AS n_regionkey"),
        "orders": spark.range(0, 120).selectExpr("id AS o_orderkey", "1 + id % 20 AS o_custkey", "CAST(date_add(DATE'1998-06-01', CAST(id * 8 AS INT)) AS DATE) AS o_orderdate",
                                                 "concat(CAST(1 + id % 5 AS STRING), '-X') AS o_orderpriority", "CAST(1000 + id * 37 AS DOUBLE) AS o_totalprice",
                                                 "CASE id % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'O' ELSE 'P' END AS o_orderstatus"),
        "lineitem": spark.range(0, 240).selectExpr("id % 120 AS l_orderkey", "CAST(date_add(DATE'1998-06-05', CAST(id % 120 * 8 AS INT)) AS DATE) AS l_shipdate",
                                                   "CAST(id % 50 AS DOUBLE) AS l_quantity", "CASE id % 3 WHEN 0 THEN 'R' WHEN 1 THEN 'A' ELSE 'N' END AS l_returnflag", "0.05D AS l_discount",
                                                   "0.02D AS l_tax", "CAST(1 + id % 7 AS INT) AS l_linenumber", "CAST(id * 13 AS DOUBLE) AS l_extendedprice"),
    }
    for name, df in tables.items():
        df.write.parquet(f"{d}/{name}.parquet")
    passes, both = [], cm.snapshots
    monkeypatch.setattr(cm, "snapshots", lambda *a: passes.append(a) or both(*a))
    parts = cm._periods(cm._both(spark, d))
    assert len(passes) == 1
    for period, got in zip(("period1", "period2"), parts):
        want = cm.snapshot(spark, d, period)
        rounded = lambda df: sorted(map(str, (
            tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.select(*want.columns).collect())))
        assert rounded(got) == rounded(want) and want.count() > 0
    assert {r["split"] for r in parts[0].select("split").collect()} == {"train", "valid"}
    alone = []
    monkeypatch.setattr(cm, "snapshot", lambda *a: alone.append(a))
    monkeypatch.setattr(cm, "surv", lambda *a: alone.append(a))
    monkeypatch.setattr(bo, "DEFAULTS", BoostParams(trees=1))
    monkeypatch.setitem(cm.mo.UPLIFT_GBT_PARAMS, "maxIter", 1)
    assert cm.q_retention_pipeline(spark, d).count() == parts[1].count()
    assert len(passes) == 2 and not alone
