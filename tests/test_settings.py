"""Registered model queries run at their operators' own settings."""

import importlib.util
import json
from pathlib import Path

import pytest

from trolley.operators import learn
from trolley.registry import QUERIES
from trolley.sources import Ledger
from trolley.workspace import workspace

ROOT = Path(__file__).resolve().parents[1] / "trolley"
SF = "/root/testdata/sf0.001"


def fresh(name: str):
    """The module as written, without the small settings of the tests."""
    path = ROOT.joinpath(*name.split(".")).with_suffix(".py")
    spec = importlib.util.spec_from_file_location(f"trolley.{name}_as_written", path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def test_settings_as_written():
    assert fresh("workspace").Workspace.trees is None
    written = fresh("operators.learn")
    assert written.SEARCH == {"k": 5, "max_rounds": 200, "patience": 20}
    assert (written.CATEGORICAL["maxIter"], written.CATEGORICAL["maxDepth"]) == (100, 8)
    assert written.ROUND_SWEEP == [250, 350, 400, 450, 500]


@pytest.mark.parametrize(
    "query, fits, settings",
    [
        ("gbt_cv_f1", 4, lambda: learn.CROSS_VALIDATE),
        ("gbt_round_sweep", 4, lambda: learn.CROSS_VALIDATE | {"maxIter": max(learn.ROUND_SWEEP)}),
        ("gbt_rounds", lambda: learn.SEARCH["k"], lambda: learn.SUBMIT | {"maxIter": learn.SEARCH["max_rounds"]}),
        ("gbt_categorical", 1, lambda: learn.CATEGORICAL),
        ("gbt_categorical_cv_f1", 4, lambda: learn.CATEGORICAL),
    ],
)
def test_models_have_the_settings(spark, tmp_path, monkeypatch, query, fits, settings):
    """The query's fits, as the ledger has kept them."""
    monkeypatch.setattr(workspace(spark, SF), "ledger", Ledger(spark, str(tmp_path / "ledger")))
    assert QUERIES[query](spark, SF).count() > 0
    kept = [json.loads(f.read_text()) for f in tmp_path.glob("ledger/*/*/result/metadata/part-*")]
    assert len(kept) == (fits() if callable(fits) else fits)
    for model in kept:
        known = model["defaultParamMap"] | model["paramMap"]
        assert {k: known[k] for k in settings()} == settings()
