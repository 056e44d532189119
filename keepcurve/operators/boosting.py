"""Histogram gradient boosting with missing-value directions.

Rows are binned once by cut points per feature and written as one byte per
feature, packed into blocks of up to ``ROWS_PER_TASK`` rows, feature by
feature: a job reads a few byte strings, not rows.  A level of a tree is one
job: every task adds up gradients and hessians per (node, feature, bin) over
its blocks, and the driver, which sees nodes x features x bins sums and never a
row, picks the best split of each node (the sums of more than ``DIRECT`` tasks
are added up by feature in tasks before).  Rows without a value have a bin of
their own, and each split sends them to the side where they gain more; a
split may also tell them from all others.

Columns are drawn per tree, rows per tree by a hash of their key.  With
validation rows the length is where their PR-AUC was best before it failed
to improve for ``patience`` trees; it is read from the counts of a score grid
that the next tree's first job returns, so no tree is grown twice.  A model is
a table of nodes (``BoostedModel.nodes``) and is scored from it.

Margins are kept: the trees since are applied by every job until their work is
worth a copy of the blocks (``ROWS_LATE``), which the next job makes as it runs.
Each ``REFRESH`` trees the margins are written, so a job's work does not grow
with the number of trees.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keepcurve.session import cut_lineage, few_tasks, together

MISSING = 255
MAX_CUTS = 254
MIN_GAIN = 1e-6
REFRESH = 16
# Rows of a task times trees that its jobs may apply again.
ROWS_LATE = 1 << 19
DIRECT = 16
SCORE_GRID = 1 << 16
ROWS_PER_TASK = 1 << 15
TRAIN, VALID = 0, 1


@dataclass(frozen=True)
class BoostParams:
    """Fixed values of the original classifier, and its library's defaults."""

    trees: int = 300
    depth: int = 5
    rate: float = 0.05
    rows: float = 0.8
    columns: float = 0.8
    l2: float = 1.0
    min_child_weight: float = 1.0
    patience: int = 20
    loss: str = "logistic"
    seed: int = 42


DEFAULTS = BoostParams()


@dataclass
class Tree:
    """Node k's children are 2k + 1 and 2k + 2."""

    split: dict = field(default_factory=dict)  # node -> (feature, bin, threshold, missing_left)
    value: dict = field(default_factory=dict)  # leaf -> value

    def arrays(self):
        import numpy as np

        n = max([*self.split, *self.value], default=0) + 1
        feature, cut, left = np.full(n, -1), np.zeros(n, np.int64), np.zeros(n, bool)
        threshold, value = np.zeros(n), np.zeros(n)
        for k, (f, b, t, m) in self.split.items():
            feature[k], cut[k], threshold[k], left[k] = f, b, t, m
        for k, v in self.value.items():
            value[k] = v
        return feature, cut, threshold, left, value


def _descend(arrays, depth, column, is_missing, below):
    """Leaf (or node at ``depth``) of each row; ``column(f, rows)`` are values."""
    import numpy as np

    feature, cut, threshold, missing_left, _ = arrays
    node = np.zeros(len(is_missing), np.int64)
    for _ in range(depth):
        f = feature[node]
        rows = np.flatnonzero(f >= 0)
        if not len(rows):
            break
        at = node[rows]
        left = np.where(is_missing[rows, f[rows]], missing_left[at], below(column[rows, f[rows]], cut[at], threshold[at]))
        node[rows] = 2 * at + 2 - left
    return node


def _bin_nodes(arrays, depth, bins):
    """Leaf (or node at ``depth``) of each row of a block: ``bins`` is features x rows."""
    import numpy as np

    feature, cut, _, missing_left, _ = arrays
    n = bins.shape[1]
    node, row, flat = np.zeros(n, np.int64), np.arange(n), bins.reshape(-1)
    for _ in range(depth):
        f = feature[node]
        inner = f >= 0
        if not inner.any():
            break
        x = flat[np.where(inner, f, 0) * n + row]
        left = np.where(x == MISSING, missing_left[node], x <= cut[node])
        node = np.where(inner, 2 * node + 2 - left, node)
    return node


def _value_nodes(arrays, depth, x):
    import numpy as np

    return _descend(arrays, depth, x, np.isnan(x), lambda v, _, threshold: v <= threshold)


def _matrix(column, p):
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), p)


def _features(cols: Sequence[str]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in cols])


def quantile_cuts(df: DataFrame, cols: Sequence[str], n: int = MAX_CUTS) -> dict[str, list[float]]:
    """Up to ``n`` cut points per column from its approximate quantiles (all
    values, where there are no more): one aggregate, p x n numbers.  A column
    is a group, so the tasks' sketches are merged column by column, not all in
    one task."""
    probs = [k / (n + 1) for k in range(1, n + 1)]
    values = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.nanvl(F.col(c).cast("double"), F.lit(None)).alias("v")) for k, c in enumerate(cols)]))
    found = df.select(values.alias("_x")).groupBy("_x.k").agg(F.percentile_approx("_x.v", probs, 100 * n).alias("q")).collect()
    cuts = {r["k"]: r["q"] for r in found}
    return {c: sorted({float(x) for x in (cuts.get(k) or [])}) for k, c in enumerate(cols)}


def _binned(df: DataFrame, cols, cuts, y: Column, w: Column, key: str, role: int) -> DataFrame:
    edges = [list(cuts[c]) for c in cols]

    def run(batches):
        import numpy as np
        import pyarrow as pa

        marks = [np.array(e) for e in edges]
        for b in batches:
            x = _matrix(b.column("x"), len(marks))
            bins = np.empty(x.shape, np.uint8)
            for f, e in enumerate(marks):
                bins[:, f] = np.where(np.isnan(x[:, f]), MISSING, np.searchsorted(e, x[:, f], side="left"))
            packed = pa.array([r.tobytes() for r in bins], pa.binary())
            yield pa.RecordBatch.from_arrays([packed, *[b.column(c) for c in ("y", "w", "h", "role", "m")]], ["bins", "y", "w", "h", "role", "m"])

    rows = df.select(_features(cols).alias("x"), y.cast("double").alias("y"), w.cast("double").alias("w"), F.xxhash64(key).alias("h"),
                     F.lit(role).alias("role"), F.lit(0.0).alias("m"))
    return rows.where("y IS NOT NULL").mapInArrow(run, "bins binary, y double, w double, h long, role int, m double")


BLOCK = {"bins": "u1", "y": "f8", "w": "f8", "h": "i8", "role": "i4", "m": "f8"}


def _blocks(rows: DataFrame, p: int) -> DataFrame:
    """Binned rows as blocks: a row holds the bins of up to about
    ``ROWS_PER_TASK`` rows, feature by feature, and their other columns, each as
    one byte string."""
    most = ROWS_PER_TASK

    def packed(batches):
        import numpy as np
        import pyarrow as pa

        b = pa.Table.from_batches(batches).combine_chunks()
        bins = np.frombuffer(b"".join(b.column("bins").to_pylist()), np.uint8).reshape(len(b), p)
        columns = [b.column(c).to_numpy().astype(t).tobytes() for c, t in BLOCK.items() if c != "bins"]
        return pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in (bins.T.tobytes(), *columns)], list(BLOCK))

    def run(batches):
        held = []
        for b in batches:
            held += [b] if len(b) else []
            if sum(map(len, held)) >= most:
                yield packed(held)
                held = []
        if held:
            yield packed(held)

    return rows.mapInArrow(run, ", ".join(f"{c} binary" for c in BLOCK))


def _block(row, p: int):
    """The columns of a block as arrays; bins are features x rows."""
    import numpy as np

    bins, *rest = [np.frombuffer(row[c], t) for c, t in BLOCK.items()]
    return (bins.reshape(p, -1), *rest)


class _Blocks:
    """Blocks as arrays, kept by the executors for the jobs of a fit; what is
    lost comes again from the checkpointed rows below.  ``late`` are the trees
    that their margins miss."""

    def __init__(self, rows: DataFrame, p: int, depth: int, rows_per_task: int):
        self.p, self.depth, self.rows_per_task, self.spent = p, depth, rows_per_task, []
        self._hold(rows)

    def _hold(self, rows: DataFrame) -> None:
        p = self.p
        self.late, self.unwritten = [], []
        self.rows, self.rdd = rows, rows.rdd.map(lambda row: _block(row, p)).persist(StorageLevel.MEMORY_AND_DISK)

    def add(self, tree) -> None:
        """Adds a tree to the margins, at the latest when they are written."""
        self.late, self.unwritten, depth = [*self.late, tree], [*self.unwritten, tree], self.depth
        if len(self.unwritten) >= REFRESH:
            rows = cut_lineage(_refreshed(self.rows, self.p, self.unwritten, depth))
            self.drop()
            self._hold(rows)
        elif len(self.late) * self.rows_per_task >= ROWS_LATE:
            late, self.late = self.late, []
            self.spent.append(self.rdd)
            self.rdd = self.rdd.map(lambda block: (*block[:-1], _margins(block[-1], block[0], late, depth))).persist(StorageLevel.MEMORY_AND_DISK)

    def settle(self) -> None:
        """Lets go of the blocks that the last job made newer ones of."""
        for rdd in self.spent:
            rdd.unpersist()
        self.spent = []

    def drop(self) -> None:
        self.settle()
        self.rdd.unpersist()


def _drawn(h, share: float, seed: int, tree: int):
    """Rows of one tree: a mix of the key's hash, the seed and the tree."""
    import numpy as np

    z = h.astype(np.uint64) + np.uint64((seed * 1_000_003 + tree + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(by)
    return (z ^ (z >> np.uint64(31))) < np.uint64(int(share * (1 << 63)) * 2 - (1 if share >= 1 else 0))


def _margins(m, bins, trees, depth):
    m = m.copy()
    for t in trees:
        m += t[4][_bin_nodes(t, depth, bins)]
    return m


def _sigmoid(m):
    import numpy as np

    return 1.0 / (1.0 + np.exp(-m))


def _level_job(blocks: _Blocks, params: BoostParams, current, level, open_nodes, columns, number, with_valid):
    """Sums of the blocks per feature: an array (gradient or hessian)
    x open nodes x bins; feature -1 has the validation rows by score, positives
    and negatives."""
    late, depth, loss, share, seed = blocks.late, params.depth, params.loss, params.rows, params.seed
    slot = {n: k for k, n in enumerate(open_nodes)}

    def run(part):
        import numpy as np

        sums, grid = np.zeros((len(columns), 2, len(slot) * 256)), np.zeros((2, SCORE_GRID))
        where = np.full(2 ** (level + 1), -1)
        for n, k in slot.items():
            where[n] = k
        empty = True
        for block in part:
            empty = False
            bins, y, w, h, role, m = block
            m = _margins(m, bins, late, depth)
            if with_valid:
                v = role == VALID
                at = np.minimum((_sigmoid(m[v]) * SCORE_GRID).astype(int), SCORE_GRID - 1)
                grid[0] += np.bincount(at, y[v], SCORE_GRID)
                grid[1] += np.bincount(at, 1 - y[v], SCORE_GRID)
            k = where[_bin_nodes(current, level, bins)] if level else np.zeros(len(y), np.int64)
            t = np.flatnonzero((k >= 0) & (role == TRAIN) & (_drawn(h, share, seed, number) if share < 1 else True))
            k, m, y, w = k[t] * 256, m[t], y[t], w[t]
            if loss == "logistic":
                s = _sigmoid(m)
                g, hess = w * (s - y), w * np.maximum(s * (1 - s), 1e-16)
            else:
                g, hess = w * (m - y), w
            for j, f in enumerate(columns):
                at = k + bins[f][t]
                for i, x in enumerate((g, hess)):
                    sums[j, i] += np.bincount(at, x, len(slot) * 256)
        if not empty:
            yield from zip(columns, sums.reshape(len(columns), 2, len(slot), 256))
            if with_valid:
                yield -1, grid

    found, n = blocks.rdd.mapPartitions(run), blocks.rdd.getNumPartitions()
    if n > DIRECT:
        found = found.reduceByKey(lambda a, b: a + b, -(-n // 8))
    total = {}
    for f, x in found.collect():
        total[f] = total[f] + x if f in total else x
    return total


def best_split(g, h, n_cuts, l2: float, min_child_weight: float):
    """Best (gain, feature, bin, missing_left, left G, left H) of a node from
    its sums (features x 256), or None; of equal gains the first feature, then
    bin, then missing values to the right."""
    import numpy as np

    total_g, total_h = g[0].sum(), h[0].sum()
    score = lambda a, b: a * a / (b + l2)
    n = np.asarray(n_cuts)
    most = int(n.max(initial=0)) + 1
    side = lambda x: np.cumsum(x[:, :most], axis=1)[:, :, None] + x[:, MISSING, None, None] * np.array([0.0, 1.0])
    a, b = side(g), side(h)
    gain = score(a, b) + score(total_g - a, total_h - b) - score(total_g, total_h)
    inside = (np.arange(most) <= n[:, None])[:, :, None]
    gain = np.where(inside & (b >= min_child_weight) & (total_h - b >= min_child_weight), np.round(gain, 8), -np.inf)
    f, k, missing_left = np.unravel_index(int(np.argmax(gain)), gain.shape)
    if not gain[f, k, missing_left] > MIN_GAIN:
        return None
    return float(gain[f, k, missing_left]), int(f), int(k), bool(missing_left), float(a[f, k, missing_left]), float(b[f, k, missing_left])


def grid_pr_auc(pos, neg) -> float:
    """Average precision from counts by ascending score; equal scores are one step."""
    import numpy as np

    tp, fp = np.cumsum(pos[::-1]), np.cumsum(neg[::-1])
    if not len(tp) or tp[-1] == 0:
        return 0.0
    return float((pos[::-1] * np.divide(tp, tp + fp, out=np.zeros_like(tp), where=tp + fp > 0)).sum() / tp[-1])


@dataclass
class BoostedModel:
    """``curve``: validation PR-AUC after each tree grown."""

    features: list[str]
    trees: list[Tree]
    base: float
    params: BoostParams
    curve: list[float] = field(default_factory=list)

    @property
    def n_trees(self) -> int:
        return len(self.trees)

    def nodes(self, spark: SparkSession) -> DataFrame:
        """``(tree, node, feature, threshold, missing_left, value)``: inner
        nodes have a feature, leaves a value; tree -1 is the base margin."""
        rows = [(-1, 0, None, None, None, self.base)]
        for t, tree in enumerate(self.trees):
            rows += [(t, k, self.features[f], float(x), bool(m), None) for k, (f, _, x, m) in tree.split.items()]
            rows += [(t, k, None, None, None, float(v)) for k, v in tree.value.items()]
        return spark.createDataFrame(rows, "tree int, node int, feature string, threshold double, missing_left boolean, value double")

    @staticmethod
    def from_nodes(nodes: DataFrame, features: Sequence[str], params: BoostParams) -> BoostedModel:
        place, trees, base = {f: k for k, f in enumerate(features)}, {}, 0.0
        for r in nodes.collect():
            if r["tree"] < 0:
                base = r["value"]
            elif r["feature"] is None:
                trees.setdefault(r["tree"], Tree()).value[r["node"]] = r["value"]
            else:
                trees.setdefault(r["tree"], Tree()).split[r["node"]] = (place[r["feature"]], 0, r["threshold"], r["missing_left"])
        return BoostedModel(list(features), [trees[k] for k in sorted(trees)], base, params)

    def score(self, df: DataFrame, keep: Sequence[str] = (), out_col: str = "score") -> DataFrame:
        """C4: P(class 1), or the predicted value of a squared loss."""
        arrays, p, base, depth = [t.arrays() for t in self.trees], len(self.features), self.base, self.params.depth
        logistic = self.params.loss == "logistic"

        def run(batches):
            import numpy as np
            import pyarrow as pa

            for b in batches:
                x = _matrix(b.column("_x"), p)
                m = np.full(len(x), base)
                for t in arrays:
                    m += t[4][_value_nodes(t, depth, x)]
                yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(_sigmoid(m) if logistic else m)], [*keep, out_col])

        kept = df.select(*keep)
        schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields), f"`{out_col}` double"])
        return df.select(*keep, _features(self.features).alias("_x")).mapInArrow(run, schema)


def fit_boosted(train: DataFrame, features: Sequence[str], label: str, key: str, valid: DataFrame | None = None,
                weight_col: str | None = None, params: BoostParams | None = None, cuts: Mapping[str, Sequence[float]] | None = None) -> BoostedModel:
    """Boosted trees on ``train``; ``valid`` rows only choose their number.

    Null and NaN features are missing values, rows with a null label are left
    out.  ``cuts`` are cut points per feature (at most 254; quantiles of the
    training rows by default).  ``key`` identifies a row: it decides in which
    trees the row is drawn, so refits agree whatever the partitioning.  No
    training rows: no trees.
    """
    import numpy as np

    params = params or DEFAULTS
    features = list(features)
    p = len(features)
    cuts = {c: list(v) for c, v in (cuts or quantile_cuts(train, features)).items()}
    weight = F.col(weight_col) if weight_col else F.lit(1.0)
    rows = _binned(train, features, cuts, F.col(label), weight, key, TRAIN)
    if valid is not None:
        rows = rows.unionByName(_binned(valid, features, cuts, F.col(label), F.lit(1.0), key, VALID))
    rows = few_tasks(cut_lineage(rows), ROWS_PER_TASK, even=True)
    base = 0.0
    if params.loss == "squared":
        base = rows.where(F.col("role") == TRAIN).agg(F.sum(F.col("y") * F.col("w")) / F.sum("w")).first()[0] or 0.0
        rows = rows.withColumn("m", F.lit(base))
    per_task = rows.count() // rows.rdd.getNumPartitions()
    rows = cut_lineage(_blocks(rows, p))
    draw = np.random.default_rng(params.seed)
    n_drawn = max(1, math.floor(params.columns * p + 1e-9)) if params.columns < 1 else p
    model = BoostedModel(features, [], base, params)

    blocks = _Blocks(rows, p, params.depth, per_task)
    try:
        return _grow(blocks, model, cuts, params, draw, n_drawn, valid is not None)
    finally:
        blocks.drop()


def _grow(blocks: _Blocks, model: BoostedModel, cuts, params: BoostParams, draw, n_drawn: int, with_valid: bool) -> BoostedModel:
    import numpy as np

    features, p, best = model.features, len(model.features), -1
    for number in range(params.trees + 1):
        last = number == params.trees
        if last and not with_valid:
            break
        columns = sorted(draw.choice(p, n_drawn, replace=False).tolist()) if n_drawn < p else list(range(p))
        tree, open_nodes = Tree(), {0: None}
        for level in range(params.depth):
            found = _level_job(blocks, params, tree.arrays(), level, sorted(open_nodes), columns, number, with_valid and not level)
            blocks.settle()
            none = np.zeros((2, len(open_nodes), 256))
            per_node = np.stack([found.get(f, none) for f in columns], axis=1)
            if with_valid and not level:
                if number:
                    model.curve.append(grid_pr_auc(*found.get(-1, np.zeros((2, SCORE_GRID)))))
                    if best < 0 or model.curve[-1] > model.curve[best]:
                        best = number - 1
                if last or (number and number - 1 - best >= params.patience):
                    model.trees = model.trees[: best + 1]
                    return model
            grown = {}
            for k, n in enumerate(sorted(open_nodes)):
                sums = per_node[:, :, k]
                if open_nodes[n] is None:
                    open_nodes[n] = (sums[0][0].sum(), sums[1][0].sum())
                split = best_split(*sums, [len(cuts[features[f]]) for f in columns], params.l2, params.min_child_weight)
                total_g, total_h = open_nodes[n]
                if split is None:
                    tree.value[n] = -params.rate * total_g / (total_h + params.l2)
                    continue
                _, j, b, missing_left, gl, hl = split
                f = columns[j]
                edge = cuts[features[f]]
                tree.split[n] = (f, b if b < len(edge) else MISSING - 1, edge[b] if b < len(edge) else float("inf"), missing_left)
                grown[2 * n + 1], grown[2 * n + 2] = (gl, hl), (total_g - gl, total_h - hl)
            open_nodes = grown
            if not open_nodes:
                break
        for n, (a, b) in open_nodes.items():
            tree.value[n] = -params.rate * a / (b + params.l2)
        model.trees.append(tree)
        blocks.add(tree.arrays())
    return model


def _refreshed(rows: DataFrame, p: int, trees, depth: int) -> DataFrame:
    def run(batches):
        import pyarrow as pa

        for b in batches:
            for k, row in enumerate(b.to_pylist()):
                bins, *_, m = _block(row, p)
                m = pa.array([_margins(m, bins, trees, depth).tobytes()], pa.binary())
                yield b.slice(k, 1).set_column(b.schema.get_field_index("m"), "m", m)

    return rows.mapInArrow(run, rows.schema)


def save_boosted(spark: SparkSession, model: BoostedModel, path: str) -> None:
    """A folder: the node table, the features in order and the parameters."""
    import json
    from dataclasses import asdict

    model.nodes(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
    rows = [(k, f, json.dumps(asdict(model.params))) for k, f in enumerate(model.features)]
    spark.createDataFrame(rows, "place int, feature string, params string").coalesce(1).write.mode("overwrite").parquet(f"{path}/features")


def load_boosted(spark: SparkSession, path: str) -> BoostedModel:
    import json

    rows = spark.read.parquet(f"{path}/features").orderBy("place").collect()
    return BoostedModel.from_nodes(spark.read.parquet(f"{path}/nodes"), [r["feature"] for r in rows], BoostParams(**json.loads(rows[0]["params"])))


@dataclass
class BoostedLearner:
    """One boosted regressor per arm, on rows with missing values as they are."""

    treated: BoostedModel
    control: BoostedModel

    def effect(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Predicted outcome if treated less that if not."""
        features = [c for c in self.treated.features if c not in keep]
        a = self.treated.score(df, [*keep, *features], "_treated")
        b = self.control.score(a, [*keep, "_treated"], "_control")
        return b.select(*keep, (F.col("_treated") - F.col("_control")).alias("predicted_uplift"))


def fit_boosted_learner(train: DataFrame, features: Sequence[str], treatment: str, outcome: str, key: str, params: BoostParams,
                        cuts: Mapping[str, Sequence[float]] | None = None) -> BoostedLearner:
    arm = lambda k: lambda: fit_boosted(train.where(F.col(treatment) == k), features, outcome, key, params=params, cuts=cuts)
    return BoostedLearner(*together(arm(1), arm(0)))
