import hashlib

import pytest
from pyspark.sql import functions as F

from holdfast.contracts import SNAPSHOT_SPEC
from holdfast.operators import splitting
from holdfast.plans import prepare
from holdfast.sources import sinks
from holdfast.spec import LabelSpec, SplitSpec


def by_hand(ids_by_class, quotas, seed=42):
    """id -> split by sorting every class on its hash."""
    out = {}
    for c, ids in ids_by_class.items():
        order = sorted(ids, key=lambda i: hashlib.md5(f"{seed}:{i}".encode()).hexdigest())
        test, validation = quotas[c]["test"], quotas[c]["validation"]
        for at, i in enumerate(order):
            out[i] = "test" if at < test else "validation" if at < test + validation else "train"
    return out


def test_published_quotas():
    found = splitting.split_quotas({"No": 5174, "Yes": 1869}, SplitSpec())
    assert found["No"] == {"train": 3621, "validation": 776, "test": 777}
    assert found["Yes"] == {"train": 1308, "validation": 281, "test": 280}


def test_split_equals_sorting_by_hash(spark):
    ids = {"Yes": range(0, 3000, 4), "No": [i for i in range(3000) if i % 4]}
    rows = [(i, c) for c, group in ids.items() for i in group]
    df = spark.createDataFrame(rows, "id long, y string")
    got = {r["id"]: r["split"] for r in splitting.stratified_split(df, "id", "y").collect()}
    quotas = splitting.split_quotas({c: len(list(g)) for c, g in ids.items()}, SplitSpec())
    assert got == by_hand(ids, quotas)


def test_deep_prefixes_give_the_same_split(spark, monkeypatch):
    df = spark.range(2000).select("id", F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("y"))
    plain = {tuple(r) for r in splitting.stratified_split(df, "id", "y").collect()}
    monkeypatch.setattr(splitting, "DIGITS", 1)
    monkeypatch.setattr(splitting, "LIST_LIMIT", 2)
    assert {tuple(r) for r in splitting.stratified_split(df, "id", "y").collect()} == plain


def test_split_does_not_depend_on_layout(customers):
    def run(df):
        return {
            r["customerID"]: r["split"]
            for r in splitting.stratified_split(df, "customerID", "Churn").collect()
        }

    assert run(customers) == run(customers.repartition(9).orderBy(F.desc("MonthlyCharges")))
    seeded = splitting.stratified_split(customers, "customerID", "Churn", SplitSpec(seed=1))
    assert run(customers) != {r["customerID"]: r["split"] for r in seeded.collect()}


def test_split_is_sound(customers):
    split = splitting.stratified_split(customers, "customerID", "Churn").cache()
    checks = {r["check"]: r["value"] for r in splitting.split_integrity(split, SNAPSHOT_SPEC).collect()}
    assert checks["ids_in_two_splits"] == 0 and checks["rows_without_split"] == 0
    assert max(v for k, v in checks.items() if k.startswith("rate_gap")) <= 0.12
    manifest = {r["split"]: r for r in splitting.split_manifest(split, SNAPSHOT_SPEC.label).collect()}
    # 170 * (0.15 / 0.85) is a hair above 30 in floating point, and the share is rounded up
    assert {s: r["n_rows"] for s, r in manifest.items()} == {
        "train": 139, "validation": 31, "test": 30
    }
    assert splitting.split_overlap(split, "customerID", "train", "test").isEmpty()


def test_integrity_sees_a_leak(customers):
    split = splitting.stratified_split(customers, "customerID", "Churn")
    leaked = split.unionByName(split.where("split = 'test'").limit(1).withColumn("split", F.lit("train")))
    checks = {r["check"]: r["value"] for r in splitting.split_integrity(leaked, SNAPSHOT_SPEC).collect()}
    assert checks["ids_in_two_splits"] == 1


def test_empty_split_has_rate_zero(customers):
    only = customers.withColumn("split", F.lit("train"))
    rows = {r["split"]: r for r in splitting.split_manifest(only, SNAPSHOT_SPEC.label).collect()}
    assert (rows["test"]["n_rows"], rows["test"]["positive_rate"]) == (0, 0.0)


def test_too_small_or_unlabelled(sample, customers):
    with pytest.raises(ValueError):
        splitting.stratified_split(sample, "customerID", "Churn")
    with pytest.raises(ValueError, match="no label"):
        splitting.stratified_split(
            customers.withColumn("Churn", F.when(F.col("tenure") == 2, "Yes")), "customerID", "Churn"
        )
    with pytest.raises(ValueError, match="no rows"):
        splitting.stratified_split(customers.limit(0), "customerID", "Churn")


def test_folds(spark):
    df = spark.range(103).select("id", F.when(F.col("id") < 23, "Yes").otherwise("No").alias("y"))
    folds = splitting.stratified_folds(df, "id", "y", 5)
    sizes = {r["fold"]: r["count"] for r in folds.groupBy("fold").count().collect()}
    assert sorted(sizes) == [0, 1, 2, 3, 4] and set(sizes.values()) == {20, 21}
    per_class = [r["count"] for r in folds.where("y = 'Yes'").groupBy("fold").count().collect()]
    assert set(per_class) == {4, 5}
    with pytest.raises(ValueError, match="folds"):
        splitting.stratified_folds(df, "id", "y", 200)


def test_one_id_on_a_third_of_the_rows(spark):
    hot = spark.range(600).select(
        F.when(F.col("id") < 200, F.lit(-1)).otherwise(F.col("id")).alias("id"), F.lit("a").alias("y")
    )
    split = splitting.stratified_split(hot, "id", "y")
    per_id = split.groupBy("id").agg(F.countDistinct("split").alias("k"))
    assert split.count() == 600 and per_id.where("k > 1").isEmpty()


def test_from_raw_file(spark, raw, tmp_path):
    many = splitting.replicate_rows(raw, 40, "customerID")
    path = sinks.write_table(many, str(tmp_path / "raw.csv"))
    split, manifest = prepare.split_from_raw(spark, path, str(tmp_path / "out"))
    assert split.count() == 160
    assert {r["n_rows"] for r in manifest.collect()} == {112, 24}
    report = spark.read.json(str(tmp_path / "out" / "split_manifest.json"))
    assert report.count() == 3
    plan = split.where("split = 'train'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_many_classes(spark):
    """200 classes with 20,000 rows each: exact quotas, whatever the number of rows."""
    rows = spark.range(4_000_000).select("id", (F.col("id") % 200).cast("string").alias("y"))
    split = splitting.stratified_split(rows, "id", "y")
    splitting.assert_quotas(split, "y", SplitSpec())
    assert split.columns == ["id", "y", "split"]


def test_literal_and_joined_cuts_agree(spark, monkeypatch):
    rows = spark.range(3000).select("id", (F.col("id") % 7).cast("string").alias("y"), F.lit(1).alias("_cls"))
    few = sorted(map(tuple, splitting.stratified_split(rows, "id", "y").collect()))
    folds = sorted(map(tuple, splitting.stratified_folds(rows.drop("_cls"), "id", "y", 4).collect()))
    monkeypatch.setattr(splitting, "LITERAL_CLASSES", 2)
    monkeypatch.setattr(splitting, "COUNTS", 100)
    monkeypatch.setattr(splitting, "LIST_LIMIT", 3)
    assert sorted(map(tuple, splitting.stratified_split(rows.drop("_cls"), "id", "y").collect())) == [
        (i, y, s) for i, y, _, s in few]
    assert sorted(map(tuple, splitting.stratified_folds(rows.drop("_cls"), "id", "y", 4).collect())) == folds


def test_null_and_repeated_ids(spark, tmp_path):
    rows = spark.range(1000).select(F.when(F.col("id") > 2, F.col("id")).alias("id"), F.lit("a").alias("y"))
    with pytest.raises(ValueError, match="3 rows have no id"):
        splitting.stratified_split(rows, "id", "y")
    with pytest.raises(ValueError, match="3 rows have no id"):
        splitting.stratified_folds(rows, "id", "y", 3)
    again = spark.range(1000).select((F.col("id") % 10).alias("id"), F.lit("a").alias("y"))
    with pytest.raises(ValueError, match="ids repeat"):
        splitting.assert_quotas(splitting.stratified_split(again, "id", "y"), "y", SplitSpec())


def test_label_spec_on_other_columns(spark):
    df = spark.createDataFrame([("train", "b"), ("train", "g")], "split string, l string")
    rate = splitting.split_manifest(df, LabelSpec("l", "b", "g")).where("split = 'train'").first()
    assert rate["positive_rate"] == 0.5
