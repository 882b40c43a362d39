"""Customer-value regression and churn classification with Spark ML.

The model frame (features + label, split, standardized, assembled) is
checkpointed once into the shared checkpoint folder before the bake-off:
every iterative fit reads the checkpoint, not the raw scans, and a lost
executor recomputes from it.  Metrics come from the SQL aggregates in
``operators.metrics`` on the held-out part.

Linear and ridge regression solve the normal equations of one shared Gram
aggregate (``operators.gram``), whatever the number of penalties; gradient boosting and the
optional boosted models are histogram boosting of the first and second order
(``operators.boosting``); random forests hand small nodes to single tasks (``operators.forest``).
Independent fits run as concurrent Spark jobs.

Parameter mapping from the reference's estimators:
* logistic ``C = 1`` -> ``regParam = 1 / sum(weights)`` (Spark averages the
  weighted log-loss),
* random forest regressor uses all features per split, the classifier sqrt.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayrate.operators import metrics as me
from stayrate.operators import prep
from stayrate.operators.boosting import BoostedModel, GradientBoostedModel, fit_boosted
from stayrate.operators.forest import ForestModel, fit_forest
from stayrate.operators.gram import Gram, gram
from stayrate.operators.store import register_model
from stayrate.session import cut_lineage

FEATURES = "features"
TARGET = "target"
WEIGHT = "weight"


@dataclass
class ModelFrame:
    train: DataFrame
    test: DataFrame
    feature_cols: list[str]
    n_train: int
    target_sd: float


def build_model_frame(df: DataFrame, feature_cols: Sequence[str], target: str,
                      key: str = "customer_id", test_size: float = 0.2, seed: int = 42,
                      stratify: bool = False, log_target: bool = False,
                      class_weighted: bool = False) -> ModelFrame:
    """Split exactly, fit the scaler on train only, assemble, weight, checkpoint."""
    cols = list(feature_cols)
    # The split, the scaler and the weights below each read the features again.
    df = cut_lineage(df.select(key, target, *[c for c in cols if c not in (key, target)]))
    if stratify:
        parts = prep.stratified_split(df, target, test_size, seed, key)
    else:
        parts = prep.train_test_split(df, test_size, seed, key)
    parts = prep.standardize(parts, cols, F.col("split") == "train")
    y = F.log1p(F.col(target)) if log_target else F.col(target).cast("double")
    parts = parts.withColumn(TARGET, y)
    parts = VectorAssembler(inputCols=cols, outputCol=FEATURES, handleInvalid="keep").transform(parts)
    parts = parts.select(key, "split", TARGET, F.col(target).alias("label_raw"), FEATURES)
    if class_weighted:
        train_w = prep.class_weights(parts.where(F.col("split") == "train"), TARGET) \
                      .select(TARGET, F.col("weight").alias(WEIGHT))
        parts = parts.join(train_w, TARGET, "left").fillna(1.0, [WEIGHT])
    else:
        parts = parts.withColumn(WEIGHT, F.lit(1.0))
    # Cut lineage once: the fits below iterate over this frame many times.
    parts = cut_lineage(parts.repartition(key))
    train = parts.where(F.col("split") == "train")
    test = parts.where(F.col("split") == "test")
    size = train.agg(F.count(F.lit(1)).alias("n"), F.stddev_samp(TARGET).alias("sd")).first()
    return ModelFrame(train, test, cols, size["n"], size["sd"] or 1.0)


def oversampled(mf: ModelFrame, k: int = 5, seed: int = 42, key: str = "customer_id") -> ModelFrame:
    """The frame with its (scaled) training part balanced by SMOTE rows of weight 1; the test part stays as it is."""
    cols = [f"x{i}" for i in range(len(mf.feature_cols))]
    x = vector_to_array(FEATURES)
    flat = mf.train.select(key, TARGET, x.alias("x")).select(key, TARGET, *[F.col("x")[i].alias(c) for i, c in enumerate(cols)])
    made = prep.smote(flat, TARGET, cols, k, seed, key).select(TARGET, array_to_vector(F.array(*cols)).alias(FEATURES))
    one = F.lit(1.0).alias(WEIGHT)
    train = cut_lineage(mf.train.select(TARGET, FEATURES, one).unionByName(made.select(TARGET, FEATURES, one)))
    return ModelFrame(train, mf.test, mf.feature_cols, train.count(), mf.target_sd)


# ------------------------------------------------------------- estimators
@register_model
@dataclass
class LinearModel:
    """Fitted coefficients; scoring is column arithmetic."""

    coefficients: DenseVector
    intercept: float

    def transform(self, df: DataFrame) -> DataFrame:
        weights = F.array(*[F.lit(float(w)) for w in self.coefficients])
        dot = F.aggregate(F.zip_with(vector_to_array(FEATURES), weights, lambda a, b: a * b), F.lit(0.0), lambda t, e: t + e)
        return df.withColumn("prediction", dot + F.lit(self.intercept))

    def to_json(self) -> str:
        return json.dumps({"coefficients": self.coefficients.toArray().tolist(), "intercept": self.intercept})

    @classmethod
    def from_json(cls, text: str) -> "LinearModel":
        d = json.loads(text)
        return cls(DenseVector(d["coefficients"]), d["intercept"])


class LinearFamily:
    """Least squares with any penalties: the Gram matrix of a training frame is made once."""

    def __init__(self):
        self._of: DataFrame | None = None
        self._gram: Gram | None = None

    def gram(self, train: DataFrame) -> Gram:
        if self._of is not train:
            size = len(train.select(FEATURES).first()[0])
            self._gram = gram(train, [TARGET], FEATURES, [f"x{k}" for k in range(size)])
            self._of = train
        return self._gram

    def estimator(self, alpha: float) -> "PenalisedSquares":
        return PenalisedSquares(self, alpha)


@dataclass
class PenalisedSquares:
    """min |y - Xb - c|^2 + alpha |b|^2."""

    family: LinearFamily
    alpha: float

    def fit(self, train: DataFrame) -> LinearModel:
        coef, intercept = self.family.gram(train).solve(TARGET, self.alpha)
        return LinearModel(DenseVector(coef), intercept)


def fit_ridge_path(train: DataFrame, alphas: Sequence[float]) -> dict[float, LinearModel]:
    """One model per penalty (0: least squares), all from one aggregate of the training rows."""
    family = LinearFamily()
    return {a: family.estimator(a).fit(train) for a in alphas}


@dataclass
class BoostedTrees:
    """The optional boosted model: second-order histogram boosting."""

    objective: str
    depth: int
    n_trees: int = 200
    rate: float = 0.1
    ratio_weights: bool = False

    def fit(self, train: DataFrame) -> BoostedModel:
        weight = None
        if self.ratio_weights:
            ratio = prep.scale_pos_weight(train, TARGET).first()["scale_pos_weight"] or 1.0
            train = train.withColumn("ratio_weight", F.when(F.col(TARGET) == 1, F.lit(float(ratio))).otherwise(F.lit(1.0)))
            weight = "ratio_weight"
        return fit_boosted(train, TARGET, FEATURES, weight, self.objective, self.n_trees, self.depth, self.rate)


#: Bins of a feature in gradient boosting; children may have any weight that is not rounding.
GBT_BINS = 32
LEAST_WEIGHT = 1e-6


@dataclass
class GBTRegressor:
    """Gradient boosting: trees on the residuals by squared error, leaves their means."""

    depth: int
    n_trees: int = 200
    rate: float = 0.1

    def fit(self, train: DataFrame) -> GradientBoostedModel:
        return _gradient_boosted(self, train, "squared", None)


@dataclass
class GBTClassifier:
    """Gradient boosting of the deviance: trees on the residuals by squared error, a Newton step per leaf."""

    depth: int
    n_trees: int = 200
    rate: float = 0.1
    weight: str | None = None

    def fit(self, train: DataFrame) -> GradientBoostedModel:
        return _gradient_boosted(self, train, "deviance", self.weight)


def _gradient_boosted(est, train: DataFrame, objective: str, weight: str | None) -> GradientBoostedModel:
    m = fit_boosted(train, TARGET, FEATURES, weight, objective, est.n_trees, est.depth, est.rate, lam=0.0,
                    min_child_weight=LEAST_WEIGHT, bins=GBT_BINS)
    return GradientBoostedModel(m.objective, m.base, m.rate, m.cuts, m.trees)


@dataclass
class Forest:
    """A random forest: the regressor tries all features at a split, the classifier the square root of their number."""

    classes: bool
    depth: int
    n_trees: int = 200
    seed: int = 42
    weight: str | None = None

    def fit(self, train: DataFrame) -> ForestModel:
        size = len((train.select(FEATURES).first() or [[]])[0])
        per_split = math.ceil(math.sqrt(size)) if self.classes else None
        return fit_forest(train, TARGET, FEATURES, self.weight, self.classes, self.n_trees, self.depth, per_split, self.seed)


BOOSTED = "Boosted Trees"


def regression_estimators(n_train: int, target_sd: float, n_trees: int = 200, seed: int = 42,
                          alpha: float = 1.0, boosted: bool = False) -> dict:
    family = LinearFamily()
    est = {
        "Linear Regression": family.estimator(0.0),
        "Ridge Regression": family.estimator(alpha),
        "Random Forest": Forest(False, 12, n_trees, seed),
        "Gradient Boosting": GBTRegressor(5, n_trees),
    }
    if boosted:
        est[BOOSTED] = BoostedTrees("squared", 6, n_trees)
    return est


def classification_estimators(sum_weights: float, n_trees: int = 200, seed: int = 42,
                              weighted: bool = True, boosted: bool = False) -> dict:
    wcol = {"weightCol": WEIGHT} if weighted else {}
    est = {
        "Logistic Regression": LogisticRegression(featuresCol=FEATURES, labelCol=TARGET, maxIter=1000,
                                                  regParam=1.0 / max(sum_weights, 1.0), elasticNetParam=0.0,
                                                  standardization=False, **wcol),
        "Random Forest": Forest(True, 10, n_trees, seed, WEIGHT if weighted else None),
        "Gradient Boosting": GBTClassifier(4, n_trees, weight=WEIGHT if weighted else None),
    }
    if boosted:  # positives weigh negatives / positives of the training part; no resampling
        est[BOOSTED] = BoostedTrees("logistic", 5, n_trees, ratio_weights=True)
    return est


def fit_boosted_regressor(mf: "ModelFrame", n_trees: int = 200) -> BoostedModel:
    """Depth-6 boosted trees on the training part."""
    return BoostedTrees("squared", 6, n_trees).fit(mf.train)


def fit_boosted_classifier(mf: "ModelFrame", n_trees: int = 200) -> BoostedModel:
    """Depth-5 boosted trees where positives weigh negatives / positives of the
    training part (the class-ratio variant; no resampling)."""
    return BoostedTrees("logistic", 5, n_trees, ratio_weights=True).fit(mf.train)


# ---------------------------------------------------------------- scoring
def score_regression(model, df: DataFrame, key: str = "customer_id", log_target: bool = True) -> DataFrame:
    """Predictions back on the original scale (``expm1`` of the log model)."""
    p = model.transform(df)
    back = (lambda c: F.expm1(c)) if log_target else (lambda c: c)
    return p.select(key, back(F.col(TARGET)).alias("actual"), back(F.col("prediction")).alias("predicted"))


def score_classification(model, df: DataFrame, key: str = "customer_id") -> DataFrame:
    """Class at 0.5 and the probability of class 1."""
    p = model.transform(df)
    one = F.col("probability") if dict(p.dtypes)["probability"] == "double" else vector_to_array("probability")[1]
    return p.select(key, F.col(TARGET).cast("int").alias("label"), one.alias("score"),
                    F.col("prediction").cast("int").alias("prediction"))


# ------------------------------------------------------------- bake-offs
def _fit_all(estimators: dict, train: DataFrame, measure: Callable, parallelism: int, fit: Callable | None = None) -> tuple[dict, list]:
    """Every model and its metrics; fits are independent, so they run as concurrent jobs.
    ``fit(name, estimator)`` gives a model from elsewhere (a store)."""
    def one(item):
        name, est = item
        model = fit(name, est) if fit else est.fit(train)
        return name, model, measure(model)

    kept = train.persist()
    try:
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            done = list(pool.map(one, estimators.items()))
    finally:
        kept.unpersist()
    return {n: m for n, m, _ in done}, [(n, *r) for n, _, r in done]


def compare_resampling(mf: ModelFrame, k: int = 5, seed: int = 42) -> DataFrame:
    """Logistic regression on the training part as it is, with balanced class weights and
    oversampled by SMOTE: AUC / precision / recall / F1 on the same test part."""
    rows = []
    for name, frame, weighted in (("plain", mf, False), ("class weights", mf, True), ("smote", oversampled(mf, k, seed), False)):
        sum_w = frame.train.agg(F.sum(WEIGHT)).first()[0] if weighted else frame.n_train
        est = classification_estimators(sum_w or 1.0, seed=seed, weighted=weighted)["Logistic Regression"]
        scored = cut_lineage(score_classification(est.fit(frame.train), frame.test))
        prf = me.precision_recall_f1(scored).first()
        rows.append((name, frame.n_train, float(me.roc_auc(scored).first()["auc"]), float(prf["precision"]), float(prf["recall"]), float(prf["f1"])))
    return mf.train.sparkSession.createDataFrame(rows, "training string, n_train long, auc double, precision double, recall double, f1 double")


def _best(rows: list, at: int) -> str | None:
    """The name with the largest value; the first one wins ties."""
    best = None
    for r in rows:
        if r[at] is not None and (best is None or r[at] > best[at]):
            best = r
    return best and best[0]


def compare_regressors(mf: ModelFrame, n_trees: int = 200, seed: int = 42, boosted: bool = False, parallelism: int = 3,
                       fit: Callable | None = None):
    """Fit every regressor on train; RMSE / MAE / R² on test (dollar scale);
    best (flagged ``is_best``) = highest R² (the first one wins ties)."""
    def measure(model):
        m = me.regression_metrics(score_regression(model, mf.test)).first()
        return float(m["rmse"]), float(m["mae"]), float(m["r2"])

    fitted, rows = _fit_all(regression_estimators(mf.n_train, mf.target_sd, n_trees, seed, boosted=boosted), mf.train, measure, parallelism, fit)
    best = _best(rows, 3)
    table = mf.train.sparkSession.createDataFrame([(*r, r[0] == best) for r in rows],
                                                  "model string, rmse double, mae double, r2 double, is_best boolean")
    return table, best, fitted


def compare_classifiers(mf: ModelFrame, n_trees: int = 200, seed: int = 42, weighted: bool = True, boosted: bool = False,
                        parallelism: int = 3, fit: Callable | None = None):
    """Fit every classifier on train; AUC / precision / recall / F1 on test;
    best (flagged ``is_best``) = highest AUC (the first one wins ties)."""
    def measure(model):
        scored = cut_lineage(score_classification(model, mf.test))  # two metrics read it
        prf = me.precision_recall_f1(scored).first()
        return float(me.roc_auc(scored).first()["auc"]), float(prf["precision"]), float(prf["recall"]), float(prf["f1"])

    sum_w = mf.train.agg(F.sum(WEIGHT)).first()[0] or float(mf.n_train)
    fitted, rows = _fit_all(classification_estimators(sum_w, n_trees, seed, weighted, boosted), mf.train, measure, parallelism, fit)
    best = _best(rows, 1)
    table = mf.train.sparkSession.createDataFrame([(*r, r[0] == best) for r in rows],
                                                  "model string, auc double, precision double, recall double, f1 double, is_best boolean")
    return table, best, fitted


def feature_importance(spark: SparkSession, model, names: Sequence[str], k: int = 15) -> DataFrame:
    """Impurity importances (trees) or |coefficient| (linear models), top ``k``."""
    if hasattr(model, "featureImportances"):
        vals = model.featureImportances.toArray().tolist()
        kind = "importance"
    else:
        coef = model.coefficients.toArray().tolist()
        vals = [abs(c) for c in coef]
        kind = "abs_coefficient"
    df = spark.createDataFrame([(n, float(v), kind) for n, v in zip(names, vals)],
                               "feature string, importance double, kind string")
    return df.orderBy(F.desc("importance"), F.asc("feature")).limit(k)
