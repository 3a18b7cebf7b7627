from __future__ import annotations

import subprocess
import sys
import textwrap
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from holdfast import SNAPSHOT_SPEC, SearchSpec
from holdfast.operators import training
from holdfast.sources.ledger import SearchLedger, point_key, search_key

SMALL = SearchSpec(
    folds=2, draws=2, parallelism=1,
    grid={"n_estimators": [2, 3], "max_depth": [2], "min_child_samples": [5], "learning_rate": [0.1]},
)


@pytest.fixture(scope="module")
def whole(spark, customers, tmp_path_factory):
    """An undisturbed search, for comparison."""
    path = str(tmp_path_factory.mktemp("whole"))
    return training.random_search(customers, SNAPSHOT_SPEC, SMALL, path)


def rows(result):
    return sorted((r["trial"], r["fold"], r["roc_auc"], tuple(sorted(r["params"].items()))) for r in result.trials.collect())


def counted(monkeypatch, fail_after=None):
    """Counts the fits; from the given one on they fail."""
    made, trees = [], training._trees

    def fit(point, seed):
        if fail_after is not None and len(made) >= fail_after:
            raise RuntimeError("lost")
        made.append(point)
        return trees(point, seed)

    monkeypatch.setattr(training, "_trees", fit)
    return made


def test_failed_search_goes_on(spark, customers, whole, tmp_path, monkeypatch):
    ledger = str(tmp_path)
    with monkeypatch.context() as m:
        counted(m, fail_after=3)
        with pytest.raises(RuntimeError, match="lost"):
            training.random_search(customers, SNAPSHOT_SPEC, SMALL, ledger)
    made = counted(monkeypatch)
    result = training.random_search(customers, SNAPSHOT_SPEC, SMALL, ledger)
    assert len(made) == 2  # the fit that was missing, and the refit
    assert rows(result) == rows(whole) and result.best == whole.best
    assert result.best_score == pytest.approx(whole.best_score)


def test_more_draws_add_to_the_ledger(spark, customers, tmp_path, monkeypatch):
    one = SearchSpec(folds=2, draws=1, grid=SMALL.grid)
    training.random_search(customers, SNAPSHOT_SPEC, one, str(tmp_path))
    made = counted(monkeypatch)
    result = training.random_search(customers, SNAPSHOT_SPEC, SMALL, str(tmp_path))
    assert len(made) == 3 and len(rows(result)) == 4


def test_other_rows_or_settings_are_another_search(spark, customers):
    key = search_key(customers, SNAPSHOT_SPEC, SMALL)
    assert key == search_key(customers.repartition(7), SNAPSHOT_SPEC, SMALL)
    changed = customers.withColumn("tenure", F.when(F.col("customerID").endswith("_b3"), 9).otherwise(F.col("tenure")))
    others = [
        search_key(changed, SNAPSHOT_SPEC, SMALL),
        search_key(customers, SNAPSHOT_SPEC, SearchSpec(folds=3, draws=2, grid=SMALL.grid)),
        search_key(customers, SNAPSHOT_SPEC, SearchSpec(folds=2, draws=2, grid=SMALL.grid, seed=7)),
    ]
    assert len({key, *others}) == 4


def test_appends_are_idempotent(spark, tmp_path):
    book = SearchLedger(spark, str(tmp_path), "k")
    assert book.results().collect() == [] and book.finished() == set()
    for value in (0.5, 0.75):
        book.append({"b": 1, "a": 2}, 0, value)
    (tmp_path / "search=k" / f"point={point_key({'a': 2})}" / "fold=1").mkdir(parents=True)  # broken off
    assert book.finished() == {(point_key({"a": 2, "b": 1}), 0)}
    assert [(r["roc_auc"], r["params"]) for r in book.results().collect()] == [(0.75, {"a": "2", "b": "1"})]


def test_killed_driver(spark, customers, whole, tmp_path, monkeypatch):
    """A process that dies after two fits; this one finishes its search."""
    customers.write.parquet(f"{tmp_path}/rows")
    script = f"""
    import os, sys
    sys.path.insert(0, {str(Path(__file__).resolve().parents[1])!r})
    from pyspark.sql import SparkSession
    from holdfast import SNAPSHOT_SPEC, SearchSpec
    from holdfast.operators import training
    from holdfast.sources.ledger import SearchLedger

    spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config(
        "spark.sql.shuffle.partitions", "4").config("spark.checkpoint.dir", {str(tmp_path / "shared")!r}).getOrCreate()
    append, done = SearchLedger.append, []

    def dying(self, *given):
        append(self, *given)
        done.append(given)
        if len(done) == 2:
            os._exit(9)

    SearchLedger.append = dying
    rows = spark.read.parquet({f"{tmp_path}/rows"!r})
    training.random_search(rows, SNAPSHOT_SPEC, SearchSpec(folds=2, draws=2, parallelism=1, grid={SMALL.grid!r}), {f"{tmp_path}/ledger"!r})
    """
    ended = subprocess.run([sys.executable, "-c", textwrap.dedent(script)], capture_output=True, timeout=300)
    assert ended.returncode == 9, ended.stderr[-2000:]
    made = counted(monkeypatch)
    table = spark.read.parquet(f"{tmp_path}/rows")
    result = training.random_search(table, SNAPSHOT_SPEC, SMALL, f"{tmp_path}/ledger")
    assert len(made) == 3 and rows(result) == rows(whole)
