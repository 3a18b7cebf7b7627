import math
import shutil

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from holdfast.contracts import SNAPSHOT_SPEC
from holdfast.functions.labels import label_binary, label_ternary
from holdfast.operators import features, row_rules, scoring, splitting, training
from holdfast.operators.quality import ValidationError
from holdfast.plans import evaluate, score, train
from holdfast.sources import fingerprint, registry, sinks
from holdfast.spec import LogisticSpec, ModelingSpec, LabelSpec, SearchSpec
from holdfast.streaming import scoring as stream_scoring

LABEL = SNAPSHOT_SPEC.label
SMALL = SearchSpec(
    folds=2, draws=2, seed=0,
    grid={"learning_rate": [0.1, 0.3], "n_estimators": [3], "max_depth": [2, 3],
          "min_child_samples": [2]},
)


@pytest.fixture(scope="module")
def split(customers, spark, tmp_path_factory):
    out = splitting.stratified_split(customers, "customerID", "Churn")
    path = sinks.write_splits(out, str(tmp_path_factory.mktemp("split") / "s.parquet"))
    return spark.read.parquet(path)


def part(split, name):
    return split.where(F.col("split") == name).drop("split")


@pytest.fixture(scope="module")
def trained(split, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("baseline"))
    done = train.train_logistic_job(
        part(split, "train"), part(split, "validation"), SNAPSHOT_SPEC,
        model_path=f"{base}/model", runs_path=f"{base}/runs",
    )
    return base, done


@pytest.fixture(scope="module")
def champion(split, trained):
    base, _ = trained
    summary = evaluate.evaluation_job(
        split, SNAPSHOT_SPEC, base, champion_path=f"{base}/champion",
        champion_model=f"{base}/model", fallback_model=f"{base}/none",
    )
    return base, summary


def test_label_encoders_differ_on_unknown(spark):
    df = spark.createDataFrame([("Yes",), ("No",), ("Maybe",), (None,)], "Churn string")
    got = df.select(label_binary(LABEL).alias("b"), label_ternary(LABEL).alias("t")).collect()
    assert [tuple(r) for r in got] == [(1, 1), (0, 0), (0, None), (0, None)]


def test_class_weights(spark):
    df = spark.createDataFrame([("Yes",)] * 2 + [("No",)] * 6, "Churn string")
    balanced = {r["y"]: r["weight"] for r in training.class_weights(df, LABEL).collect()}
    assert balanced == {0: pytest.approx(8 / 12), 1: 2.0}
    tilted = {r["y"]: r["weight"] for r in training.class_weights(df, LABEL, "unbalance").collect()}
    assert tilted == {0: 1.0, 1: 3.0}
    assert {r[training.WEIGHT] for r in training.with_weight(df, LABEL, None).collect()} == {1.0}
    with pytest.raises(ValueError):
        training.class_weights(df, LABEL, "odd")


def test_logistic_solves_the_penalised_problem(spark):
    """The gradient of 0.5 * |w|^2 + C * sum(weight * loss) vanishes at the fitted model."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=300)
    y = rng.random(300) < 1 / (1 + np.exp(-(0.7 * x - 1)))
    df = spark.createDataFrame(
        [(i, float(v), "Yes" if t else "No") for i, (v, t) in enumerate(zip(x, y))],
        "id long, x double, y string",
    )
    spec = ModelingSpec("id", {"x": "number"}, (), LabelSpec("y"))
    model = training.fit_logistic(df, spec, LogisticSpec(inverse_penalty=0.5, tolerance=1e-10))
    (_, b), (_, w) = training.model_coefficients(model)
    z = (x - x.mean()) / x.std()
    weight = np.where(y, 300 / (2 * y.sum()), 300 / (2 * (~y).sum()))
    miss = weight * (1 / (1 + np.exp(-(w * z + b))) - y)
    assert w + 0.5 * (miss * z).sum() == pytest.approx(0.0, abs=1e-4)
    assert miss.sum() == pytest.approx(0.0, abs=1e-4)


def test_training_job(spark, split, trained):
    base, done = trained
    assert set(done.metrics) == {"val_roc_auc", "val_average_precision", "val_f1", "val_recall"}
    assert all(0.0 <= v <= 1.0 for v in done.metrics.values())
    logged = spark.read.parquet(f"{base}/runs").collect()
    assert len(logged) == 1 and logged[0]["params"]["n_train"] == "139"
    loaded = PipelineModel.load(f"{base}/model")
    def scores(model):
        rows = training.score_rows(model, part(split, "test")).select("customerID", training.SCORE)
        return {r[0]: r[1] for r in rows.collect()}

    assert scores(loaded) == scores(done.model)


def test_features_are_fitted_on_train_only(split, trained):
    _, done = trained
    stats = features.fit_statistics(part(split, "train"), SNAPSHOT_SPEC)
    assert features.model_feature_names(done.model) == stats.names
    assert done.model.stages[-1].numFeatures == len(stats.names)


def test_draws_are_seeded_and_distinct():
    points = training.draw_points(SearchSpec())
    assert len(points) == 18 == len({tuple(sorted(p.items())) for p in points})
    assert points == training.draw_points(SearchSpec())
    assert points != training.draw_points(SearchSpec(seed=1))
    assert len(training.draw_points(SearchSpec(draws=50, grid={"max_depth": [2, 3]}))) == 2


def test_tree_settings():
    got = training.tree_settings(
        {"learning_rate": 0.05, "n_estimators": 100, "max_depth": -1, "num_leaves": 63,
         "min_child_samples": 60, "colsample_bytree": 0.75, "subsample": 0.75, "reg_lambda": 1.0}
    )
    assert got == {
        "stepSize": 0.05, "maxIter": 100, "maxDepth": math.ceil(math.log2(63)),
        "minInstancesPerNode": 60, "featureSubsetStrategy": "0.75",
    }
    assert training.tree_settings({"max_depth": 4, "colsample_bytree": 1.0}) == {
        "maxDepth": 4, "featureSubsetStrategy": "all"
    }


def test_search_job(spark, split, tmp_path):
    base = str(tmp_path)
    done, result = train.train_trees_job(
        part(split, "train"), part(split, "validation"), SNAPSHOT_SPEC,
        model_path=f"{base}/model", runs_path=f"{base}/runs", search=SMALL,
    )
    trials = result.trials.collect()
    assert {(r["trial"], r["fold"]) for r in trials} == {(t, f) for t in (0, 1) for f in (0, 1)}
    assert all(0.0 <= r["roc_auc"] <= 1.0 for r in trials)
    best = training.best_trial(result.trials).first()
    assert best["mean_roc_auc"] == pytest.approx(result.best_score)
    assert result.best == training.draw_points(SMALL)[best["trial"]]
    runs = spark.read.parquet(f"{base}/runs")
    parent = runs.where("parent_run_id is null").collect()
    assert len(parent) == 1 and parent[0]["run_id"] == done.run_id
    children = runs.where(F.col("parent_run_id") == done.run_id).collect()
    assert sorted(r["name"] for r in children) == ["trial_1", "trial_2"]
    assert all("cv_mean_roc_auc" in r["metrics"] for r in children)
    record = train.best_settings(SMALL, result, done.metrics)
    assert record["settings"]["n_estimators"] == 3
    # the planted signal (fibre and charges) is found
    assert done.metrics["val_roc_auc"] > 0.8


def test_evaluation_job_freezes_the_champion(spark, champion):
    base, summary = champion
    facts = {(r["split"], r["metric"]): r["value"] for r in summary.collect()}
    frozen = registry.read_champion(spark, f"{base}/champion")
    assert frozen["threshold"] == facts[("validation", "threshold")]
    assert 0.01 <= frozen["threshold"] <= 0.99
    assert frozen["test_metrics"]["recall"] == facts[("test", "recall")]
    assert frozen["model_source"] == "champion"
    with pytest.raises(ValueError, match="missing"):
        evaluate.score_held_out(
            PipelineModel.load(f"{base}/model"),
            spark.createDataFrame([("test",)], "split string"), SNAPSHOT_SPEC,
        )


# --- scoring rows ---------------------------------------------------------------------------


def checked_one(sample, **changes):
    row = sample.where("customerID = '5575-GNVDE'")
    for c, v in changes.items():
        row = row.withColumn(c, v if not isinstance(v, (str, int, float, type(None))) else F.lit(v))
    return row_rules.check_rows(row, SNAPSHOT_SPEC).first()


@pytest.mark.parametrize(
    "column, value, kept",
    [
        ("TotalCharges", " ", None), ("TotalCharges", "-5", -5.0), ("TotalCharges", "12.5", 12.5),
        ("SeniorCitizen", "1", 1), ("SeniorCitizen", " 0 ", 0), ("SeniorCitizen", "0.5", 0),
        ("SeniorCitizen", 1.9, 1), ("SeniorCitizen", "1e0", 1),
        ("tenure", 3.9, 3), ("tenure", -0.5, 0), ("tenure", " 7 ", 7),
        ("MonthlyCharges", "20", 20.0), ("MonthlyCharges", "inf", float("inf")),
        ("gender", " Alien ", "Alien"), ("customerID", " x ", "x"),
    ],
)
def test_accepted_values(sample, column, value, kept):
    row = checked_one(sample, **{column: value})
    assert row["reasons"] == [] and row[column] == kept


@pytest.mark.parametrize(
    "column, value",
    [
        ("TotalCharges", "abc"), ("SeniorCitizen", "2"), ("SeniorCitizen", "x"),
        ("SeniorCitizen", None), ("SeniorCitizen", float("nan")), ("SeniorCitizen", float("inf")),
        ("tenure", "2.5"), ("tenure", -1), ("tenure", None), ("tenure", float("nan")),
        ("MonthlyCharges", -0.1), ("MonthlyCharges", None), ("MonthlyCharges", float("nan")),
        ("MonthlyCharges", "nan"), ("gender", "  "), ("gender", None), ("gender", 3),
        ("customerID", " "), ("customerID", None),
    ],
)
def test_refused_values(sample, column, value):
    row = checked_one(sample, **{column: value})
    assert len(row["reasons"]) == 1 and row["reasons"][0].startswith(column)


def test_columns_of_a_scoring_table(sample):
    with pytest.raises(ValidationError, match="bogus"):
        row_rules.check_rows(sample.withColumn("bogus", F.lit(1)), SNAPSHOT_SPEC)
    with pytest.raises(ValidationError, match="gender"):
        row_rules.check_rows(sample.drop("gender"), SNAPSHOT_SPEC)
    lean = row_rules.check_rows(sample.drop("TotalCharges", "Churn"), SNAPSHOT_SPEC)
    assert lean.where("size(reasons) > 0").isEmpty()


def test_batch_scoring(spark, sample, customers, champion, tmp_path):
    base, _ = champion
    bad = customers.limit(3).withColumn("MonthlyCharges", F.lit(-1.0)).withColumn(
        "customerID", F.concat(F.lit("bad"), F.col("customerID"))
    )
    source = sinks.write_table(customers.unionByName(bad), str(tmp_path / "in.parquet"))
    done = score.score_batch(
        spark, source, str(tmp_path / "out.parquet"), SNAPSHOT_SPEC, f"{base}/champion",
        mode=score.QUARANTINE, rejects_path=str(tmp_path / "rejects.parquet"), runs_path=str(tmp_path / "runs"),
    )
    assert done.scores.columns == [
        "customerID", "churn_probability", "predicted_churn", "actual_churn"
    ]
    assert done.scores.count() == 200 and done.rejects.count() == 3
    assert done.scores.where("churn_probability between 0 and 1").count() == 200
    cut = registry.read_champion(spark, f"{base}/champion")["threshold"]
    off = done.scores.where(
        (F.col("predicted_churn") == "Yes") != (F.col("churn_probability") >= cut)
    )
    assert off.isEmpty()
    run = spark.read.parquet(str(tmp_path / "runs")).first()
    assert (run["n_rows"], run["n_rejected"], run["threshold_source"]) == (200, 3, "champion")
    assert run["input_digest"] == fingerprint.content_fingerprint(spark.read.parquet(source)).first()["digest_sum"]
    with pytest.raises(ValidationError, match="MonthlyCharges"):  # the default call loses no row
        score.score_batch(
            spark, source, str(tmp_path / "x.parquet"), SNAPSHOT_SPEC, f"{base}/champion"
        )
    assert not (tmp_path / "x.parquet").exists()
    with pytest.raises(ValueError, match="rejects_path"):
        score.score_batch(
            spark, source, str(tmp_path / "x.parquet"), SNAPSHOT_SPEC, f"{base}/champion",
            mode=score.QUARANTINE,
        )
    with pytest.raises(ValueError, match="mode"):
        score.score_table(customers, done, SNAPSHOT_SPEC, 0.5, mode="odd")


def test_batch_scoring_of_csv_without_labels(spark, raw, champion, tmp_path):
    base, _ = champion
    source = sinks.write_table(raw.drop("Churn"), str(tmp_path / "in.csv"))
    done = score.score_batch(
        spark, source, str(tmp_path / "out.csv"), SNAPSHOT_SPEC, f"{base}/champion",
        threshold_override=0.0,
    )
    rows = done.scores.collect()
    assert done.scores.columns == ["customerID", "churn_probability", "predicted_churn"]
    assert len(rows) == 4 and {r["predicted_churn"] for r in rows} == {"Yes"}
    assert done.metadata["threshold_source"] == "override"


def test_late_labels(spark, customers, champion):
    base, _ = champion
    model = PipelineModel.load(f"{base}/model")
    scores = scoring.score_projection(
        training.score_rows(model, customers), SNAPSHOT_SPEC, 0.5, with_actual=False
    )
    table = scoring.scored_vs_actual(scores, customers, SNAPSHOT_SPEC).collect()
    assert sum(r["n_rows"] for r in table) == 200


def test_stream_scores_equal_batch_scores(spark, sample, customers, champion, tmp_path):
    base, _ = champion
    model = PipelineModel.load(f"{base}/model")
    rows = customers.unionByName(sample.limit(1).withColumn("tenure", F.lit(-5).cast("long")))
    source = str(tmp_path / "in")
    rows.repartition(3).write.json(source)
    incoming = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).json(source)
    path, state = str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        stream_scoring.score_stream(
            incoming, model, SNAPSHOT_SPEC, 0.5, path=path, checkpoint=state
        ).awaitTermination()
        scores = stream_scoring.committed(spark, path, "scores").drop("batch")
        return sorted(map(tuple, scores.collect()))

    streamed = run()
    batch, refused = score.score_table(rows, model, SNAPSHOT_SPEC, 0.5, score.QUARANTINE)
    assert streamed == sorted(map(tuple, batch.collect()))
    assert stream_scoring.committed(spark, path, "rejects").count() == refused.count() == 1
    commits = stream_scoring.committed(spark, path, "commits")
    assert commits.count() == 3
    assert commits.agg(F.sum("n_scored"), F.sum("n_refused")).first()[:] == (200, 1)

    # a driver lost after writing the last batch, before Spark noted it: the batch is replayed
    for note in (tmp_path / "state" / "commits").glob("*2*"):
        note.unlink()
    assert run() == streamed
    assert stream_scoring.committed(spark, path, "commits").count() == 3
    # and one lost between the two sinks: the batch does not show until it is whole
    shutil.rmtree(f"{path}/commits/batch=2")
    last = stream_scoring.committed(spark, path, "scores")
    assert last.select("batch").distinct().count() == 2
    for note in (tmp_path / "state" / "commits").glob("*2*"):
        note.unlink()
    assert run() == streamed
