"""Queries: model bake-offs, scored test parts and feature importances.

Models are non-deterministic across partitionings, so these carry no SQL
oracle; tests check their properties instead.  Queries share
splits and fitted models, which lie in a model store under the shared folder; a query
that names one model fits that one only.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from stayrate.operators import eda
from stayrate.operators import features as fe
from stayrate.operators import metrics as me
from stayrate.operators import models as mo
from stayrate.operators.store import Bundle, ModelStore
from stayrate.plans.q_features import features_df
from stayrate.plans.registry import finish, register
from stayrate.session import checkpoint_dir, cut_lineage
from stayrate.sources.fixtures import fixture

N_TREES = 200


def clv_frame(spark, sf) -> mo.ModelFrame:
    fx = fixture(spark, sf)
    df = eda.attach_labels(features_df(spark, sf), fx.clv_labels)
    cols = [c for c in fe.model_columns(df) if c != "clv"]
    return mo.build_model_frame(df, cols, "clv", log_target=True)


def churn_frame(spark, sf) -> mo.ModelFrame:
    fx = fixture(spark, sf)
    df = eda.attach_labels(features_df(spark, sf), fx.churn_labels)
    cols = [c for c in fe.model_columns(df) if c != "churn_30d"]
    return mo.build_model_frame(df, cols, "churn_30d", stratify=True, class_weighted=True)


def _store(spark) -> ModelStore:
    return ModelStore(spark, f"{checkpoint_dir(spark).rstrip('/')}/stayrate-models")


class Fits:
    """The stored split of one target and its models, each under a key of its own: a query
    that names a model fits that one only, and what one query fitted the others load."""

    def __init__(self, spark, sf, kind: str, frame, estimators):
        fx = fixture(spark, sf)
        self.store, self.kind, self._estimators = _store(spark), kind, estimators
        self._inputs = [fx.customers, fx.transactions, fx.events, fx.support_tickets]

        def make():
            mf = frame(spark, sf)
            weights = mf.train.agg(F.sum(mo.WEIGHT)).first()[0] or float(mf.n_train)
            return {}, {"train": mf.train, "test": mf.test}, {"feature_cols": mf.feature_cols, "n_train": mf.n_train,
                                                               "target_sd": mf.target_sd, "sum_weights": weights}

        self.bundle = self.store.get_or_fit(self.key("frame", {"seed": 42}), make)
        f = self.bundle.facts
        self.feature_cols = f["feature_cols"]
        self.train, self.test = self.bundle.frame("train"), self.bundle.frame("test")
        self.frame = mo.ModelFrame(self.train, self.test, self.feature_cols, f["n_train"], f["target_sd"])

    def key(self, name: str, params) -> str:
        return self.store.key(f"{self.kind}-{name}", self._inputs, params)

    def model(self, name: str, est=None):
        def fit():
            return {name: (est or self._estimators(self)[name]).fit(self.train)}, {}, {}

        return self.store.get_or_fit(self.key(name.replace(" ", "-").lower(), {"n_trees": N_TREES, "seed": 42}), fit).model(name)


class Bakeoff:
    """A stored bake-off: its table, the test part and the fitted models by name."""

    def __init__(self, fits: Fits, bundle: Bundle, schema: str):
        self.fits, self.facts, self.bundle = fits, bundle.facts, self
        self.path, self.models = bundle.path, [r[0] for r in self.facts["table"]]
        self.table = bundle.spark.createDataFrame([tuple(r) for r in self.facts["table"]], schema)
        self.test, self.train = fits.test, fits.train
        self.best, self.feature_cols = self.facts["best"], fits.feature_cols

    def model(self, name: str | None = None):
        return self.fits.model(name or self.best)


def _regression_fits(spark, sf) -> Fits:
    return Fits(spark, sf, "regression", clv_frame,
                lambda f: mo.regression_estimators(f.frame.n_train, f.frame.target_sd, N_TREES, boosted=True))


def _classification_fits(spark, sf) -> Fits:
    return Fits(spark, sf, "classification", churn_frame,
                lambda f: mo.classification_estimators(f.bundle.facts["sum_weights"], N_TREES, boosted=True))


def _bakeoff(fits: Fits, compare, schema: str) -> Bakeoff:
    """Compared once per input and parameters: later sessions on the same folder load it."""
    def fit():
        table, best, _ = compare(fits.frame, N_TREES, boosted=True, fit=fits.model)
        return {}, {}, {"table": [list(r) for r in table.collect()], "best": best}

    return Bakeoff(fits, fits.store.get_or_fit(fits.key("bakeoff", {"n_trees": N_TREES, "seed": 42}), fit), schema)


def _regression(spark, sf) -> Bakeoff:
    return _bakeoff(_regression_fits(spark, sf), mo.compare_regressors,
                    "model string, rmse double, mae double, r2 double, is_best boolean")


def _classification(spark, sf) -> Bakeoff:
    return _bakeoff(_classification_fits(spark, sf), mo.compare_classifiers,
                    "model string, auc double, precision double, recall double, f1 double, is_best boolean")


@register("compare_models_regression")
def q_compare_models_regression(spark, sf):
    """Linear, ridge, random forest and boosted trees on log1p(clv)."""
    return finish(_regression(spark, sf).table)


@register("score_regression")
def q_score_regression(spark, sf):
    """Test-part predictions of the best regressor, back on the dollar scale."""
    b = _regression(spark, sf)
    return finish(mo.score_regression(b.model(), b.test))


@register("feature_importance_regression")
def q_feature_importance_regression(spark, sf):
    b = _regression(spark, sf)
    return finish(mo.feature_importance(spark, b.model(), b.feature_cols, 15))


@register("compare_models_classification")
def q_compare_models_classification(spark, sf):
    """Weighted logistic regression, weighted random forest, boosted trees."""
    return finish(_classification(spark, sf).table)


@register("score_classification")
def q_score_classification(spark, sf):
    b = _classification(spark, sf)
    return finish(mo.score_classification(b.model(), b.test))


@register("feature_importance_classification")
def q_feature_importance_classification(spark, sf):
    b = _classification(spark, sf)
    return finish(mo.feature_importance(spark, b.model(), b.feature_cols, 15))


@register("compare_resampling")
def q_compare_resampling(spark, sf):
    """Logistic churn models on plain, weighted and SMOTE-balanced training rows."""
    return finish(mo.compare_resampling(churn_frame(spark, sf)))


def _per_classifier(spark, sf, measure):
    """``measure`` of every fitted classifier on the test part, under its name."""
    b, out = _classification(spark, sf), None
    for name in b.bundle.models:
        scored = cut_lineage(mo.score_classification(b.model(name), b.test))
        one = measure(scored).select(F.lit(name).alias("model"), "*")
        out = one if out is None else out.unionByName(one)
    return out


@register("model_roc_curves")
def q_model_roc_curves(spark, sf):
    """ROC curve of every fitted classifier on the test part."""
    return finish(_per_classifier(spark, sf, me.roc_curve))


@register("model_pr_curves")
def q_model_pr_curves(spark, sf):
    """Precision-recall curve of every fitted classifier on the test part."""
    return finish(_per_classifier(spark, sf, me.pr_curve))


@register("model_average_precision")
def q_model_average_precision(spark, sf):
    """Average precision of every fitted classifier on the test part."""
    return finish(_per_classifier(spark, sf, me.average_precision))


@register("best_model_confusion_matrix")
def q_best_model_confusion_matrix(spark, sf):
    """Confusion matrix of the best classifier on the test part."""
    b = _classification(spark, sf)
    return finish(me.confusion_matrix(mo.score_classification(b.model(), b.test)))


# One query per fitted estimator of the bake-offs, scored on the
# test part; models come from the store.
REGRESSORS = {"fit_linear": "Linear Regression", "fit_ridge": "Ridge Regression",
              "fit_rf_regressor": "Random Forest", "fit_gbt_regressor": "Gradient Boosting",
              "fit_boosted_regressor": mo.BOOSTED}
CLASSIFIERS = {"fit_logistic": "Logistic Regression", "fit_rf_classifier": "Random Forest",
               "fit_gbt_classifier": "Gradient Boosting", "fit_boosted_classifier": mo.BOOSTED}

for _q, _model in REGRESSORS.items():
    def _mk(model_name):
        def q(spark, sf):
            f = _regression_fits(spark, sf)
            return finish(mo.score_regression(f.model(model_name), f.test))
        q.__doc__ = f"{model_name} on log1p(clv), test-part predictions in dollars."
        return q
    register(_q)(_mk(_model))

for _q, _model in CLASSIFIERS.items():
    def _mk(model_name):
        def q(spark, sf):
            f = _classification_fits(spark, sf)
            return finish(mo.score_classification(f.model(model_name), f.test))
        q.__doc__ = f"{model_name} churn classifier, test-part class and probability."
        return q
    register(_q)(_mk(_model))
