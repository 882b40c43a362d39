"""A query that names one model fits that one only; the others load what it fitted."""

import pytest

from stayrate.operators import models as mo
from stayrate.operators.store import ModelStore
from stayrate.plans import QUERIES, q_models

SMALL = "/root/testdata/sf0.001"


def test_a_named_model_is_fitted_alone(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(q_models, "_store", lambda s: ModelStore(s, str(tmp_path)))
    for cls in (mo.Forest, mo.BoostedTrees, mo.GBTRegressor, mo.GBTClassifier):
        monkeypatch.setattr(cls, "fit", lambda *a, **k: pytest.fail("another model was fitted"))
    for name in ("fit_linear", "fit_ridge", "fit_logistic"):
        assert QUERIES[name](spark, SMALL).count() == 30
    monkeypatch.setattr(mo, "build_model_frame", lambda *a, **k: pytest.fail("split again"))
    monkeypatch.setattr(mo.PenalisedSquares, "fit", lambda *a, **k: pytest.fail("fitted again"))
    assert QUERIES["fit_linear"](spark, SMALL).count() == 30
