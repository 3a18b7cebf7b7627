import pytest

from holdfast import (
    EvalSpec, LabelSpec, LogisticSpec, ModelingSpec, SNAPSHOT_RULES, SNAPSHOT_SPEC, SearchSpec,
    SplitSpec,
)


def test_snapshot_contract():
    assert len(SNAPSHOT_RULES) == 21
    assert SNAPSHOT_SPEC.id_column == "customerID"
    assert list(SNAPSHOT_SPEC.numeric) == [
        "SeniorCitizen", "tenure", "MonthlyCharges", "TotalCharges"
    ]
    assert len(SNAPSHOT_SPEC.categorical) == 15
    assert SNAPSHOT_SPEC.label == LabelSpec("Churn", "Yes", "No", 0.5)
    assert [r.name for r in SNAPSHOT_RULES if r.nullable] == ["TotalCharges"]
    assert SNAPSHOT_SPEC.label.primary_metrics == (
        "roc_auc", "average_precision", "f1", "recall"
    )


def test_split_shares_must_sum_to_one():
    with pytest.raises(ValueError, match="sum to 1"):
        SplitSpec(0.5, 0.5, 0.1)
    assert SplitSpec.from_mapping(
        {"train_ratio": 0.7, "val_ratio": 0.15, "test_ratio": 0.15, "random_state": 7}
    ) == SplitSpec(seed=7)


def test_feature_settings():
    cfg = {"id_column": "id", "numeric_features": ["a"], "categorical_features": ["b"]}
    spec = ModelingSpec.from_mapping(cfg, LabelSpec("y"), {"a": "flag"})
    assert spec.features == ["a", "b"] and spec.numeric == {"a": "flag"}
    with pytest.raises(ValueError, match="one_hot"):
        ModelingSpec.from_mapping({**cfg, "encoding": "target"}, LabelSpec("y"))
    with pytest.raises(ValueError, match="lack"):
        ModelingSpec.from_mapping({"id_column": "id"}, LabelSpec("y"))
    with pytest.raises(ValueError, match="more than one role"):
        ModelingSpec("id", {"a": "number"}, ("a",), LabelSpec("y"))


def test_grid_and_floor():
    grid = EvalSpec().thresholds()
    assert len(grid) == 99 and grid[0] == 0.01 and grid[-1] == 0.99
    assert 0.47000000000000003 in grid
    assert EvalSpec().floor() == 0.5
    assert EvalSpec().floor(LabelSpec("y", recall_floor=0.6)) == 0.6
    assert EvalSpec(recall_floor=0.7).floor(LabelSpec("y")) == 0.7


def test_bad_settings_are_refused():
    for wrong in (
        lambda: SearchSpec(folds=1), lambda: SearchSpec(draws=0), lambda: SearchSpec(grid={}),
        lambda: LogisticSpec(inverse_penalty=0), lambda: LogisticSpec(class_weight="x"),
        lambda: EvalSpec(beta=0), lambda: EvalSpec(grid_points=1),
        lambda: LabelSpec("y", "a", "a"), lambda: LabelSpec("y", recall_floor=2.0),
        lambda: ModelingSpec("id", {"a": "odd"}, (), LabelSpec("y")),
    ):
        with pytest.raises(ValueError):
            wrong()
