import pytest
from pyspark.sql import functions as F

from holdfast.contracts import SNAPSHOT_SPEC
from holdfast.operators import categories, eda
from holdfast.plans import explore

LABEL = SNAPSHOT_SPEC.label


def facts(df):
    return {(r["section"], r["name"]): r["value"] for r in eda.eda_summary(df, LABEL).collect()}


def test_summary_of_the_sample(sample):
    found = facts(sample)
    assert found[("shape", "n_rows")] == 4 and found[("shape", "n_columns")] == 21
    assert found[("label_count", "Yes")] == 2 and found[("label_count", "No")] == 2
    assert found[("positive_rate_pct", "Yes")] == 50.0
    assert found[("missing_count", "TotalCharges")] == 1
    assert found[("missing_pct", "TotalCharges")] == 25.0
    assert [k for k in found if k[0] == "missing_count"] == [("missing_count", "TotalCharges")]
    assert found[("cardinality", "gender")] == 2
    assert ("cardinality", "Churn") not in found
    # a constant column has no correlation
    assert ("label_correlation", "SeniorCitizen") not in found
    assert found[("label_correlation", "MonthlyCharges")] > 0


def test_correlation_matches_pandas(customers):
    pdf = customers.toPandas()
    y = (pdf["Churn"] == "Yes").astype(int)
    want = {c: pdf[c].corr(y) for c in ("tenure", "MonthlyCharges", "TotalCharges")}
    got = {
        r["column"]: r["correlation"]
        for r in eda.label_correlation(customers, LABEL, eda.number_columns(customers, LABEL)).collect()
    }
    assert got == pytest.approx(want)
    assert list(got) == sorted(want, key=lambda c: -abs(want[c]))


def test_unknown_label_counts_as_a_value(sample):
    odd = sample.withColumn("Churn", F.when(F.col("tenure") == 2, F.lit(None)).otherwise("Maybe"))
    found = facts(odd)
    assert found[("label_count", "<missing>")] == 2 and found[("label_count", "Maybe")] == 2
    assert found[("positive_rate_pct", "Yes")] == 0.0
    assert not [k for k in found if k[0] == "label_correlation"]


def test_class_distribution_keeps_absent_classes(sample):
    rows = eda.class_distribution(sample.where("Churn = 'No'"), LABEL).collect()
    assert [tuple(r) for r in rows] == [("No", 2, 100.0), ("Yes", 0, 0.0)]


def test_cardinality_counts_missing_once(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,), (None,)], "c string")
    assert eda.cardinality(df, ["c"]).first()["n_distinct"] == 3
    assert eda.cardinality(df, ["c"], approx=True).first()["n_distinct"] == 3


def test_job_writes_a_report(spark, customers, tmp_path):
    back = explore.eda_job(customers, LABEL, str(tmp_path))
    assert back.where("section = 'shape' and name = 'n_rows'").first()["value"] == 200.0


def test_category_sets(spark):
    a = spark.createDataFrame([("x", "1"), (None, "2")], "c string, d string")
    b = spark.createDataFrame([("y", "1"), ("x", "3")], "c string, d string")
    union = {tuple(r) for r in categories.category_union(a, b, ["c", "d"]).collect()}
    assert union == {("c", "x"), ("c", "y"), ("d", "1"), ("d", "2"), ("d", "3")}
    new = {tuple(r) for r in categories.unseen_categories(a, b, ["c", "d"]).collect()}
    assert new == {("c", "y"), ("d", "3")}
