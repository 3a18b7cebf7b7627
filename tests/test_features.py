import statistics

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from holdfast.contracts import SNAPSHOT_SPEC
from holdfast.operators import features
from holdfast.spec import LabelSpec, ModelingSpec

SPEC = ModelingSpec("id", {"x": "number"}, ("c",), LabelSpec("y"))


def vectors(model, df):
    rows = features.transform_features(model, df).select(
        *df.columns, vector_to_array(features.FEATURES).alias("v")
    )
    return rows.collect()


@pytest.fixture(scope="module")
def train(spark):
    rows = [(1, 1.0, "b"), (2, 2.0, "a"), (3, 6.0, "b"), (4, None, "a"), (5, 2.0, None)]
    return spark.createDataFrame(rows, "id long, x double, c string")


def test_statistics(train):
    stats = features.fit_statistics(train, SPEC)
    filled = [1.0, 2.0, 6.0, 2.0, 2.0]
    assert stats.numeric["x"].median == 2.0
    assert stats.numeric["x"].mean == pytest.approx(statistics.fmean(filled))
    assert stats.numeric["x"].std == pytest.approx(statistics.pstdev(filled))
    # a and b are equally frequent: the smaller one wins
    assert stats.categorical["c"].mode == "a"
    assert stats.categorical["c"].levels == ("a", "b")
    assert stats.names == ["x", "c_a", "c_b"]


def test_transform(spark, train):
    model, stats = features.fit_features(train, SPEC)
    new = spark.createDataFrame(
        [(1, None, "b"), (2, float("nan"), None), (3, 2.6, "never seen")],
        "id long, x double, c string",
    )
    got = {r["id"]: r["v"] for r in vectors(model, new)}
    s = stats.numeric["x"]
    imputed = (s.median - s.mean) / s.std
    assert got[1] == pytest.approx([imputed, 0.0, 1.0])
    assert got[2] == pytest.approx([imputed, 1.0, 0.0])
    assert got[3] == pytest.approx([(2.6 - s.mean) / s.std, 0.0, 0.0])


def test_constant_and_empty_columns(spark):
    df = spark.createDataFrame(
        [(1, 5.0, None, None, "k"), (2, 5.0, None, None, "k")],
        "id long, x double, gone double, hole string, c string",
    )
    spec = ModelingSpec("id", {"x": "number", "gone": "number"}, ("hole", "c"), LabelSpec("y"))
    model, stats = features.fit_features(df, spec)
    assert stats.names == ["x", "c_k"]
    assert [r["v"] for r in vectors(model, df)] == [[0.0, 1.0], [0.0, 1.0]]
    empty = ModelingSpec("id", {"gone": "number"}, ("hole",), LabelSpec("y"))
    with pytest.raises(ValueError, match="no feature column"):
        features.fit_features(df, empty)


def test_missing_columns_are_listed_sorted(customers):
    with pytest.raises(ValueError, match=r"\['Contract', 'tenure'\]"):
        features.feature_matrix(customers.drop("tenure", "Contract"), SNAPSHOT_SPEC)
    assert features.feature_matrix(customers, SNAPSHOT_SPEC).columns == SNAPSHOT_SPEC.features


def test_vector_has_one_element_per_name(customers):
    model, stats = features.fit_features(customers, SNAPSHOT_SPEC)
    row = vectors(model, customers.limit(1))[0]
    assert len(row["v"]) == len(stats.names)
    manifest = features.feature_manifest(customers, SNAPSHOT_SPEC, stats).collect()
    facts = {(r["fact"], r["name"]): r["value"] for r in manifest}
    assert facts[("n_features_out", None)] == len(stats.names)
    assert facts[("n_train_rows", None)] == 200
    assert facts[("n_distinct", "Contract")] == 2
    assert facts[("max_distinct", None)] == 2
    assert facts[("feature_name", "SeniorCitizen")] == 0


def test_saved_model_gives_the_same_vectors(customers, tmp_path):
    model, _ = features.fit_features(customers, SNAPSHOT_SPEC)
    path = str(tmp_path / "features")
    model.write().overwrite().save(path)
    again = PipelineModel.load(path)
    assert vectors(model, customers) == vectors(again, customers)


def test_odd_level_names(spark):
    odd = ["it's", 'say "x"', "back\\slash", "`tick`", "100 %", "ünï"]
    df = spark.createDataFrame([(i, 1.0, v) for i, v in enumerate(odd)], "id long, x double, c string")
    model, stats = features.fit_features(df, SPEC)
    for r in vectors(model, df):
        assert sum(r["v"][1:]) == 1.0
        assert stats.names[1 + r["v"][1:].index(1.0)] == f"c_{r['c']}"


@pytest.mark.parametrize("n", [1, 2, 9, 10, 1001, 1002])
def test_bracketed_median(spark, n):
    df = spark.range(n).select(F.pow(F.col("id") * 7 % 1003, F.lit(2)).alias("x"))
    want = statistics.median([float((i * 7 % 1003) ** 2) for i in range(n)])
    assert features.exact_medians(df, ["x"]) == {"x": want}
    assert features.exact_medians(df, ["x"], limit=0, sketch=50) == {"x": want}
    assert features.exact_medians(df, ["x"], limit=5, sketch=10) == {"x": want}


def test_median_between_two_hot_values(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") < 1000, 1.0).when(F.col("id") < 1500, F.col("id") / 10000)
        .otherwise(2.0).alias("half"),
        F.when(F.col("id") % 2 == 0, 5.0).alias("same"),
        F.lit(None).cast("double").alias("none"),
    )
    want = {"half": 1.5, "same": 5.0, "none": None}
    assert features.exact_medians(df, list(want)) == want
    assert features.exact_medians(df, list(want), limit=1, sketch=20) == want


def test_too_many_levels_are_refused(spark):
    df = spark.range(30).select(F.col("id").cast("string").alias("c"))
    with pytest.raises(ValueError, match="too many"):
        features.fit_categorical(df, ["c"], most_levels=20)


def test_fit_and_transform_read_text_alike(spark):
    """Text that only one of two readers would take for a number is missing in both."""
    texts = ["1", " 2 ", "\t3\n", "1f", "100d", "NaN", "nan", "", None, "4e0", "x", "Infinity"][:11]
    df = spark.createDataFrame([(str(i), t, "a", "Yes" if i % 2 else "No") for i, t in enumerate(texts)],
                               "id string, n string, c string, y string")
    spec = ModelingSpec("id", {"n": "number"}, ("c",), LabelSpec("y"))
    model, stats = features.fit_features(df, spec)
    known = [1.0, 2.0, 3.0, 4.0]
    assert stats.numeric["n"].median == 2.5
    filled = [known[0], known[1], known[2]] + [2.5] * 6 + [4.0, 2.5]
    mean = sum(filled) / len(filled)
    spread = (sum((x - mean) ** 2 for x in filled) / len(filled)) ** 0.5
    rows = features.transform_features(model, df).orderBy(F.col("id").cast("int")).collect()
    got = [float(r[features.FEATURES][0]) for r in rows]
    assert got == pytest.approx([(x - mean) / spread for x in filled])
