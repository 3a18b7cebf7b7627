import pytest
from pyspark.sql import functions as F

from holdfast.contracts import SNAPSHOT_RULES, SNAPSHOT_SPEC
from holdfast.operators import quality
from holdfast.plans import prepare
from holdfast.sources import sinks


def broken(df):
    return {
        (r["rule"], r["column"]): r["n_failed"]
        for r in quality.violations(df, SNAPSHOT_RULES).collect()
    }


def test_sample_is_valid(sample):
    assert broken(sample) == {}
    assert quality.assert_valid(sample, SNAPSHOT_RULES) is sample


def test_column_order_is_free(sample):
    assert broken(sample.select(*reversed(sample.columns))) == {}


def test_extra_and_missing_columns(sample):
    assert broken(sample.withColumn("extra", F.lit(1))) == {("column_unexpected", "extra"): 1}
    assert ("column_missing", "gender") in broken(sample.drop("gender"))
    with pytest.raises(quality.ValidationError, match="extra"):
        quality.assert_valid(sample.withColumn("extra", F.lit(1)), SNAPSHOT_RULES)


def test_domain_range_null_and_type(sample):
    first = F.col("customerID") == "7590-VHVEG"
    def put(column, value):
        return sample.withColumn(column, F.when(first, value).otherwise(F.col(column)))

    assert broken(put("Churn", F.lit("Maybe"))) == {("domain", "Churn"): 1}
    assert broken(put("SeniorCitizen", F.lit(2))) == {("domain", "SeniorCitizen"): 1}
    assert broken(put("tenure", F.lit(-1))) == {("minimum", "tenure"): 1}
    assert broken(put("TotalCharges", F.lit(-0.5))) == {("minimum", "TotalCharges"): 1}
    assert broken(put("MonthlyCharges", F.lit(None))) == {("not_null", "MonthlyCharges"): 1}
    assert broken(sample.withColumn("tenure", F.col("tenure") + 0.5))[("type", "tenure")] == 4
    with pytest.raises(quality.ValidationError, match="Maybe"):
        quality.assert_valid(put("Churn", F.lit("Maybe")), SNAPSHOT_RULES)


def test_raw_text_with_blank_total_is_accepted(spark, raw, tmp_path):
    path = sinks.write_table(raw, str(tmp_path / "raw.csv"))
    table = prepare.load_and_validate(spark, path)
    assert dict(table.dtypes)["TotalCharges"] == "double"
    assert table.where("TotalCharges is null").count() == 1
    assert dict(table.dtypes)["tenure"] == "bigint"


def test_raw_file_with_bad_label_is_refused(spark, raw, tmp_path):
    bad = raw.withColumn("Churn", F.lit("Maybe"))
    path = sinks.write_table(bad, str(tmp_path / "bad.csv"))
    with pytest.raises(quality.ValidationError):
        prepare.load_and_validate(spark, path)
    assert prepare.load_and_validate(spark, path, skip_validation=True).count() == 4


def test_flag_repair(spark):
    df = spark.createDataFrame([("0",), ("1",), (None,)], "SeniorCitizen string")
    assert [r[0] for r in prepare.prepare_modeling(df).collect()] == [0, 1, 0]


def test_sample_value_is_the_smallest(sample):
    bad = sample.withColumn("Contract", F.col("customerID"))
    row = quality.violations(bad, SNAPSHOT_RULES).first()
    assert (row["n_failed"], row["sample_value"]) == (4, "3668-QPYBK")


def test_leakage(customers):
    rows = {
        r["column"]: r
        for r in quality.leakage_checks(
            customers.withColumn("gender", F.col("Churn")), SNAPSHOT_SPEC
        ).collect()
    }
    assert rows["customerID"]["suspect"] and rows["customerID"]["n_values"] == 200
    assert rows["gender"]["suspect"] and rows["gender"]["share"] == 1.0
    assert not rows["Partner"]["suspect"]
    doubled = customers.unionByName(customers.limit(1))
    checks = quality.leakage_checks(doubled, SNAPSHOT_SPEC).where("check = 'id_unique'")
    assert not checks.first()["suspect"]
