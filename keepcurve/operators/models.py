"""Classifiers, calibration and the uplift T-learner on Spark ML.

* Logistic regression: exact median impute + standardise (N1, our own fit),
  mode impute + one-hot for categoricals (N2), balanced class weights (N3)
  and an L2 penalty equal to the original's ``C = 1`` on the weighted sum of
  losses (``regParam = 1 / sum(weights)`` on Spark's averaged loss).
* Boosted trees: Spark's GBT rejects missing values, so every numeric
  feature gets a missing indicator and a sentinel below its minimum; trees
  can then isolate missing rows.  Weights, sentinels and trees see training
  rows only.  The number of trees is where the validation log loss was best
  before it failed to improve for ``PATIENCE`` trees (log loss, which Spark
  reports per tree, stands in for the original's AUC-PR).
* T-learner: the training rows' exact medians fill missing values.
* Isotonic calibration fitted on validation scores.
* Scores are the positive-class probability (C4), never the class label.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepcurve.operators import prep
from keepcurve.operators.survival import collect_stats
from keepcurve.session import cut_lineage, few_tasks, together

RANDOM_SEED = 42
# Fixed hyper-parameters of the original models.
GBT_PARAMS = dict(maxIter=300, maxDepth=5, stepSize=0.05, subsamplingRate=0.8, featureSubsetStrategy="0.8")
UPLIFT_GBT_PARAMS = dict(maxIter=200, maxDepth=4, stepSize=0.05)
LOGREG_MAX_ITER = 1000
PATIENCE = 20
FIRST_TREES = 64
# Growing trees takes hundreds of jobs, so their rows sit in few tasks.
ROWS_PER_TASK = 1 << 15


def positive_probability(pred: DataFrame, out_col: str = "score", prob_col: str = "probability") -> DataFrame:
    """C4: P(class 1) from the probability vector."""
    return pred.withColumn(out_col, vector_to_array(F.col(prob_col))[1])


# ------------------------------------------------------------ logistic reg

class LogRegModel:
    def __init__(self, stats, modes, pipeline_model, numeric, categorical):
        self.stats, self.modes, self.model = stats, modes, pipeline_model
        self.numeric, self.categorical = list(numeric), list(categorical)

    def _prep(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        x = prep.impute_scale_transform(df, self.stats, keep=list(keep) + self.categorical)
        for c in self.categorical:
            x = x.withColumn(c, F.coalesce(F.col(c).cast("double"), F.lit(self.modes[c])).cast("string"))
        return x

    def score(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        pred = self.model.transform(self._prep(df, keep))
        return positive_probability(pred).select(*keep, "score")


def collect_modes(modes: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """Mode per column as numbers (0 where a column is all null)."""
    found = {r["feature"]: r["mode"] for r in modes.collect()}
    return {c: float(found.get(c) or 0.0) for c in cols}


def fit_logreg(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str,
               max_iter: int = LOGREG_MAX_ITER, tol: float = 1e-6) -> LogRegModel:
    """C1 + N1 + N2 + N3; without categoricals there is nothing to encode."""
    stats = collect_stats(prep.standardize_fit(train, numeric).withColumnRenamed("feature", "covariate"))
    modes = collect_modes(prep.mode_impute_fit(train, categorical), categorical) if categorical else {}
    w = prep.class_weights(train, label).select(F.col("class").alias("_cls"), F.col("balanced_weight").alias("w"))
    tr = train.join(F.broadcast(w), F.col(label) == F.col("_cls"))  # two-row table
    model_stub = LogRegModel(stats, modes, None, numeric, categorical)
    x = model_stub._prep(tr, [label, "w"])
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep") for c in categorical]
    ohe = OneHotEncoder(inputCols=[f"{c}_idx" for c in categorical], outputCols=[f"{c}_ohe" for c in categorical],
                        handleInvalid="keep", dropLast=True)
    asm = VectorAssembler(inputCols=list(numeric) + [f"{c}_ohe" for c in categorical], outputCol="features")
    n_w = tr.agg(F.sum("w")).first()[0]
    lr = LogisticRegression(featuresCol="features", labelCol=label, weightCol="w", maxIter=max_iter, tol=tol,
                            regParam=1.0 / float(n_w), elasticNetParam=0.0, standardization=False)
    pm = Pipeline(stages=[*idx, *([ohe] if categorical else []), asm, lr]).fit(x)
    return LogRegModel(stats, modes, pm, numeric, categorical)


# ---------------------------------------------------------- boosted trees

class TreeModel:
    def __init__(self, fills, model, numeric, categorical):
        self.fills, self.model = fills, model
        self.numeric, self.categorical = list(numeric), list(categorical)

    @property
    def n_trees(self) -> int:
        return self.model.getNumTrees

    def features(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        return tree_features(df, self.fills, self.numeric, self.categorical, keep)

    def score(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        pred = self.model.transform(self.features(df, keep))
        return positive_probability(pred).select(*keep, "score")


def missing_fills(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """Sentinel per column: (min - 1) -- one aggregate, p numbers."""
    r = df.agg(*[F.min(F.col(c).cast("double")).alias(c) for c in cols]).first()
    return {c: (float(r[c]) - 1.0 if r[c] is not None else -1.0) for c in cols}


def tree_features(df: DataFrame, fills: dict, numeric: Sequence[str], categorical: Sequence[str],
                  keep: Sequence[str]) -> DataFrame:
    cols = list(numeric) + list(categorical)
    vals = [F.coalesce(F.col(c).cast("double"), F.lit(fills[c])) for c in cols]
    miss = [F.col(c).isNull().cast("double") for c in cols]
    return df.select(*keep, F.array(*vals, *miss).alias("_f")).transform(_array_to_vector)


def _array_to_vector(df: DataFrame) -> DataFrame:
    from pyspark.ml.functions import array_to_vector

    return df.withColumn("features", array_to_vector("_f")).drop("_f")


def best_length(losses: Sequence[float], patience: int = PATIENCE) -> int:
    """Number of trees at the lowest loss seen before ``patience`` trees in a
    row did not improve on it."""
    best = 0
    for k, loss in enumerate(losses):
        if loss < losses[best]:
            best = k
        elif k - best >= patience:
            break
    return best + 1


def fit_gbt(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str,
            valid: DataFrame | None = None, weight_col: str | None = None, params: dict | None = None,
            seed: int = RANDOM_SEED, patience: int = PATIENCE) -> TreeModel:
    """Boosted trees with missing indicators.

    With ``valid`` rows the model stops early: ``FIRST_TREES`` are grown on
    ``train``, all if the loss on ``valid`` still improves in the last
    ``patience`` of these, and then the best length.  The seed gives the same
    trees each time."""
    cols = list(numeric) + list(categorical)
    weights = [weight_col] if weight_col else []
    target = F.col(label).cast("double").alias(label)
    # the columns are written, not the vectors, which are twice as wide
    held = lambda df, weight: few_tasks(cut_lineage(df.select(*cols, target, *weight)), ROWS_PER_TASK)
    vectors = lambda df: tree_features(df, fills, numeric, categorical, [label, *weights])
    train = held(train, weights)
    fills = missing_fills(train, cols)
    x = vectors(train)
    gbt = GBTClassifier(featuresCol="features", labelCol=label, seed=seed, **dict(GBT_PARAMS, **(params or {})))
    if weight_col:
        gbt = gbt.setWeightCol(weight_col)
    if valid is None:
        return TreeModel(fills, gbt.fit(x), numeric, categorical)
    v = vectors(held(valid, [F.lit(1.0).alias(c) for c in weights]))
    most = gbt.getMaxIter()
    n = min(FIRST_TREES, most)
    while True:
        model = gbt.setMaxIter(n).fit(x)
        best = best_length(model.evaluateEachIteration(v), patience)
        if n == most or n - best >= patience:
            break
        n = most
    if best < n:
        model = gbt.setMaxIter(best).fit(x)
    return TreeModel(fills, model, numeric, categorical)


def scale_pos_weight_col(df: DataFrame, label: str, out_col: str = "w") -> DataFrame:
    """Weight 1 for negatives and neg/max(pos,1) for positives."""
    cw = prep.class_weights(df, label).select(F.col("class").alias("_cls"),
                                              F.when(F.col("class") == 1, F.col("scale_pos_weight"))
                                               .otherwise(F.lit(1.0)).alias(out_col))
    return df.join(F.broadcast(cw), F.col(label) == F.col("_cls")).drop("_cls")


# ------------------------------------------------------------- calibration

def fit_isotonic(valid_scored: DataFrame, label: str = "label", score: str = "score"):
    """Isotonic regression of the label on validation scores."""
    return IsotonicRegression(featuresCol=score, labelCol=label, predictionCol="_cal").fit(
        valid_scored.select(F.col(score).cast("double").alias(score), F.col(label).cast("double").alias(label)))


def calibrate(model, scored: DataFrame, score: str = "score") -> DataFrame:
    return model.transform(scored).withColumn(score, F.col("_cal")).drop("_cal")


# ------------------------------------------------------------------ uplift

def median_fills(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """Exact median per column (0 where a column is all null) -- p numbers."""
    found = {r["feature"]: r["median"] for r in prep.median_impute_fit(df, cols).collect()}
    return {c: float(found[c]) if found.get(c) is not None else 0.0 for c in cols}


def filled_features(df: DataFrame, fills: dict, features: Sequence[str], keep: Sequence) -> DataFrame:
    values = [F.coalesce(F.col(c).cast("double"), F.lit(fills[c])) for c in features]
    return df.select(*keep, F.array(*values).alias("_f")).transform(_array_to_vector)


class TLearner:
    def __init__(self, fills, m1, m0, features):
        self.fills, self.m1, self.m0, self.features = fills, m1, m0, list(features)

    def effect(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """mu1(x) - mu0(x)."""
        x = filled_features(df, self.fills, self.features, keep)
        p1 = self.m1.transform(x).withColumnRenamed("prediction", "_p1")
        p0 = self.m0.transform(p1).withColumnRenamed("prediction", "_p0")
        return p0.select(*keep, (F.col("_p1") - F.col("_p0")).alias("predicted_uplift"))


def fit_t_learner(train: DataFrame, features: Sequence[str], treatment: str, outcome: str,
                  params: dict | None = None, seed: int = RANDOM_SEED) -> TLearner:
    """X1 + X2: one GBT regressor per arm on median-filled features; the fills
    come from the whole training side."""
    fills = median_fills(train, features)
    kw = dict(UPLIFT_GBT_PARAMS, **(params or {}))

    def arm(k):
        x = filled_features(train.where(F.col(treatment) == k), fills, features, [F.col(outcome).cast("double").alias("y")])
        return GBTRegressor(featuresCol="features", labelCol="y", seed=seed, **kw).fit(few_tasks(cut_lineage(x), ROWS_PER_TASK))

    return TLearner(fills, *together(lambda: arm(1), lambda: arm(0)), features)


# ---------------------------------------------------------------- hand-off

def _save_fills(spark, fills: dict, path: str) -> None:
    rows = [(k, c, float(v)) for k, (c, v) in enumerate(fills.items())]
    spark.createDataFrame(rows, "place int, feature string, value double").coalesce(1).write.mode("overwrite").parquet(f"{path}/fills")


def _load_fills(spark, path: str) -> dict[str, float]:
    return {r["feature"]: r["value"] for r in spark.read.parquet(f"{path}/fills").orderBy("place").collect()}


def save_trees(spark, model: TreeModel, path: str) -> None:
    """A fitted tree classifier as a folder: Spark ML files and its fills, in
    feature order, with the number of numeric features."""
    model.model.write().overwrite().save(f"{path}/trees")
    _save_fills(spark, {**{c: model.fills[c] for c in model.numeric + model.categorical}, "": len(model.numeric)}, path)


def load_trees(spark, path: str) -> TreeModel:
    fills = _load_fills(spark, path)
    n = int(fills.pop(""))
    cols = list(fills)
    return TreeModel(fills, GBTClassificationModel.load(f"{path}/trees"), cols[:n], cols[n:])


def save_t_learner(spark, model: TLearner, path: str) -> None:
    for name, m in (("treated", model.m1), ("control", model.m0)):
        m.write().overwrite().save(f"{path}/{name}")
    _save_fills(spark, {c: model.fills[c] for c in model.features}, path)


def load_t_learner(spark, path: str) -> TLearner:
    fills = _load_fills(spark, path)
    arms = [GBTRegressionModel.load(f"{path}/{name}") for name in ("treated", "control")]
    return TLearner(fills, *arms, list(fills))
