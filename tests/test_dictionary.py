from __future__ import annotations

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from holdfast import SNAPSHOT_SPEC, ModelingSpec
from holdfast.operators import dictionary, features

LABEL = SNAPSHOT_SPEC.label


def vectors(rows, key):
    return {r[0]: r[1] for r in rows.select(key, vector_to_array(features.FEATURES)).collect()}


def test_vectors_equal_those_of_the_model(spark, customers, tmp_path):
    train = customers.where("customerID not like '%_b7'")
    model, stats = features.fit_features(train, SNAPSHOT_SPEC)
    fitted = dictionary.fit_features(train, SNAPSHOT_SPEC, str(tmp_path / "d"))
    odd = customers.limit(3).withColumn("customerID", F.concat(F.lit("odd"), "customerID"))
    odd = odd.withColumn("Contract", F.lit("never seen")).withColumn("gender", F.lit(None).cast("string"))
    rows = customers.unionByName(odd)
    want = vectors(features.transform_features(model, rows), "customerID")
    assert vectors(fitted.transform(rows), "customerID") == want and len(want) == 203
    loaded = dictionary.load(spark, str(tmp_path / "d"))
    assert vectors(loaded.transform(rows), "customerID") == want
    assert [r["feature"] for r in loaded.names(spark).orderBy("place").collect()] == stats.names
    assert loaded.transform(rows).columns == [*rows.columns, features.FEATURES]


def test_many_levels_in_many_ranges(spark, tmp_path):
    """Levels over many ranges, a frequent one among them, in two columns."""
    rows = spark.range(60_000).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), "id")).alias("a"),
        F.when(F.col("id") % 5 > 0, (F.col("id") % 700).cast("string")).alias("b"),
        F.lit("Yes").alias("y"),
    )
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        levels = dictionary.ranked_levels(rows, ["a", "b"]).collect()
        spec = ModelingSpec("id", {}, ("a", "b"), LABEL)
        fitted = dictionary.fit_features(rows, spec, str(tmp_path / "d"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    a = sorted(["hot", *(f"v{i}" for i in range(60_000) if i % 3)])
    b = sorted({str(i % 700) for i in range(60_000) if i % 5})
    assert {(r["column"], r["value"]): r["code"] for r in levels} == {
        **{("a", v): i for i, v in enumerate(a)}, **{("b", v): i for i, v in enumerate(b)},
    }
    assert {r["n"] for r in levels if r["value"] == "hot"} == {20_000}
    assert fitted.sizes == {"a": len(a), "b": len(b)}
    some = fitted.transform(rows.where("id in (1, 3, 5)")).select("id", features.FEATURES).collect()
    mode_b = min(b, key=lambda v: (-sum(1 for i in range(int(v), 60_000, 700) if i % 5), v))
    places = {r["id"]: sorted(int(i) for i in r[features.FEATURES].indices) for r in some}
    assert places == {
        1: [a.index("v1"), len(a) + b.index("1")], 3: [a.index("hot"), len(a) + b.index("3")],
        5: [a.index("v5"), len(a) + b.index(mode_b)],
    }


def test_columns_without_values(spark, tmp_path):
    rows = spark.createDataFrame([("1", None, "x", "Yes"), ("2", None, "y", "No")], "id string, n double, c string, y string")
    fitted = dictionary.fit_features(rows, ModelingSpec("id", {"n": "number"}, ("c",), LABEL), str(tmp_path / "a"))
    assert fitted.numeric == [] and fitted.sizes == {"c": 2}
    numbers = rows.withColumn("n", F.lit(2.0)).withColumn("c", F.lit(None).cast("string"))
    fitted = dictionary.fit_features(numbers, ModelingSpec("id", {"n": "number"}, ("c",), LABEL), str(tmp_path / "b"))
    assert fitted.sizes == {} and vectors(fitted.transform(numbers), "id") == {"1": [0.0], "2": [0.0]}
    with pytest.raises(ValueError, match="no feature column"):
        dictionary.fit_features(rows, ModelingSpec("id", {"n": "number"}, (), LABEL), str(tmp_path / "c"))
