"""Settings the operators read, checked when they are built."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

#: How a numeric feature is read when a scoring row is checked.
#:   flag      0 or 1
#:   whole     integer, zero or more
#:   amount    number, zero or more
#:   optional  number, may be blank
#:   number    any number, required
NUMERIC_KINDS = ("flag", "whole", "amount", "optional", "number")


@dataclass(frozen=True)
class LabelSpec:
    """Which column is the label, what its two values are, and what is reported on it."""

    column: str
    positive: str = "Yes"
    negative: str = "No"
    recall_floor: float = 0.5
    primary_metrics: tuple[str, ...] = ("roc_auc", "average_precision", "f1", "recall")

    def __post_init__(self) -> None:
        if self.positive == self.negative:
            raise ValueError("the positive and the negative label must differ")
        if not 0.0 <= self.recall_floor <= 1.0:
            raise ValueError("recall_floor must lie in [0, 1]")


@dataclass(frozen=True)
class ModelingSpec:
    """Id, numeric features (name -> kind), categorical features and label of a snapshot table."""

    id_column: str
    numeric: Mapping[str, str]
    categorical: tuple[str, ...]
    label: LabelSpec
    encoding: str = "one_hot"
    #: Most one-hot levels over all columns; None sets no limit. A fitted model holds every level.
    most_levels: int | None = None

    def __post_init__(self) -> None:
        if self.encoding != "one_hot":
            raise ValueError(f"unsupported encoding {self.encoding!r}: only 'one_hot' is known")
        odd = sorted({k for k in self.numeric.values() if k not in NUMERIC_KINDS})
        if odd:
            raise ValueError(f"unknown numeric kinds {odd}; choose from {NUMERIC_KINDS}")
        names = [self.id_column, *self.numeric, *self.categorical, self.label.column]
        twice = sorted({n for n in names if names.count(n) > 1})
        if twice:
            raise ValueError(f"columns used in more than one role: {twice}")

    @property
    def features(self) -> list[str]:
        """Feature columns in model order: numeric block, then categorical block."""
        return [*self.numeric, *self.categorical]

    @classmethod
    def from_mapping(
        cls, cfg: Mapping[str, Any], label: LabelSpec, kinds: Mapping[str, str] | None = None
    ) -> ModelingSpec:
        """Build from a settings mapping with id_column, numeric_features, categorical_features."""
        need = ("id_column", "numeric_features", "categorical_features")
        lacking = [k for k in need if k not in cfg]
        if lacking:
            raise ValueError(f"feature settings lack {lacking}")
        kinds = kinds or {}
        return cls(
            id_column=str(cfg["id_column"]),
            numeric={str(c): kinds.get(str(c), "number") for c in cfg["numeric_features"]},
            categorical=tuple(str(c) for c in cfg["categorical_features"]),
            label=label,
            encoding=str(cfg.get("encoding", "one_hot")),
        )


@dataclass(frozen=True)
class SplitSpec:
    """Shares of the three splits and the seed of the hash order."""

    train: float = 0.70
    validation: float = 0.15
    test: float = 0.15
    seed: int = 42

    def __post_init__(self) -> None:
        shares = (self.train, self.validation, self.test)
        if min(shares) <= 0.0:
            raise ValueError("every split share must be above 0")
        if abs(sum(shares) - 1.0) > 1e-6:
            raise ValueError(f"split shares must sum to 1, got {sum(shares)}")

    @classmethod
    def from_mapping(cls, cfg: Mapping[str, Any]) -> SplitSpec:
        return cls(
            train=float(cfg["train_ratio"]),
            validation=float(cfg["val_ratio"]),
            test=float(cfg["test_ratio"]),
            seed=int(cfg["random_state"]),
        )


@dataclass(frozen=True)
class LogisticSpec:
    """L2-penalised logistic regression: inverse penalty, iterations, class weighting."""

    inverse_penalty: float = 1.0
    max_iter: int = 2000
    class_weight: str | None = "balanced"
    tolerance: float = 1e-6
    seed: int = 42

    def __post_init__(self) -> None:
        if self.inverse_penalty <= 0:
            raise ValueError("inverse_penalty must be above 0")
        if self.class_weight not in (None, "balanced"):
            raise ValueError("class_weight is 'balanced' or None")


@dataclass(frozen=True)
class SearchSpec:
    """Random search over boosted-tree settings with stratified folds."""

    folds: int = 5
    draws: int = 18
    seed: int = 42
    unbalance: bool = True
    fixed: Mapping[str, Any] = field(default_factory=dict)
    grid: Mapping[str, Sequence[Any]] = field(
        # The searched settings and their lists.
        default_factory=lambda: {
            "learning_rate": [0.03, 0.05, 0.08, 0.1, 0.12],
            "num_leaves": [31, 47, 63, 96],
            "max_depth": [4, 6, 8, -1],
            "min_child_samples": [20, 40, 60, 100],
            "n_estimators": [100, 200, 350],
            "subsample": [0.75, 0.85, 1.0],
            "colsample_bytree": [0.75, 0.85, 1.0],
            "reg_lambda": [0.0, 0.5, 1.0, 5.0],
        }
    )
    parallelism: int = 4

    def __post_init__(self) -> None:
        if self.folds < 2:
            raise ValueError("folds must be 2 or more")
        if self.draws < 1:
            raise ValueError("draws must be 1 or more")
        if not self.grid or any(len(v) == 0 for v in self.grid.values()):
            raise ValueError("every searched setting needs at least one value")


@dataclass(frozen=True)
class EvalSpec:
    """Threshold search: recall floor (None: the label's), F-beta weight, grid size."""

    recall_floor: float | None = None
    beta: float = 1.25
    grid_points: int = 99

    def __post_init__(self) -> None:
        if self.beta <= 0:
            raise ValueError("beta must be above 0")
        if self.grid_points < 2:
            raise ValueError("grid_points must be 2 or more")
        if self.recall_floor is not None and self.recall_floor < 0.0:
            raise ValueError("recall_floor must be 0 or more")

    def floor(self, label: LabelSpec | None = None) -> float:
        """Recall floor in force: own setting, else the label's, else one half."""
        if self.recall_floor is not None:
            return float(self.recall_floor)
        return float(label.recall_floor) if label is not None else 0.5

    def thresholds(self) -> list[float]:
        """Evenly spaced cuts from 0.01 to 0.99."""
        step = (0.99 - 0.01) / (self.grid_points - 1)
        inner = [0.01 + i * step for i in range(self.grid_points - 1)]
        return [*inner, 0.99]
