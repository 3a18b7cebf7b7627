from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from holdfast.contracts import SNAPSHOT_RULES, SNAPSHOT_SCHEMA  # noqa: E402
from holdfast.operators.splitting import replicate_rows  # noqa: E402
from holdfast.sources.readers import typed  # noqa: E402

SMALL = "/root/testdata/sf0.001"

# Four customers: the sample rows every area is tested on. TotalCharges of the first is blank.
SAMPLE = [
    ("7590-VHVEG", "Female", "0", "Yes", "No", "1", "No", "No phone service", "DSL", "No", "Yes",
     "No", "No", "No", "No", "Month-to-month", "Yes", "Electronic check", "29.85", "", "No"),
    ("5575-GNVDE", "Male", "0", "No", "No", "34", "Yes", "No", "DSL", "Yes", "No", "Yes", "No",
     "No", "No", "One year", "No", "Mailed check", "56.95", "1889.5", "No"),
    ("3668-QPYBK", "Male", "0", "No", "No", "2", "Yes", "No", "Fiber optic", "Yes", "Yes", "No",
     "No", "No", "No", "Month-to-month", "Yes", "Mailed check", "53.85", "108.15", "Yes"),
    ("9237-HQITU", "Female", "0", "No", "No", "2", "Yes", "No", "Fiber optic", "No", "No", "No",
     "No", "No", "No", "Month-to-month", "Yes", "Electronic check", "70.7", "151.65", "Yes"),
]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("holdfast-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def raw(spark):
    """The sample as a CSV scan gives it: text columns."""
    names = [f"`{r.name}` string" for r in SNAPSHOT_RULES]
    return spark.createDataFrame(SAMPLE, ", ".join(names))


@pytest.fixture(scope="session")
def sample(spark, raw):
    """The sample, typed."""
    table = typed(raw, SNAPSHOT_RULES)
    return spark.createDataFrame(table.collect(), SNAPSHOT_SCHEMA)


@pytest.fixture(scope="session")
def customers(spark, sample, tmp_path_factory):
    """The sample 50 times with new ids and numbers that differ: 200 customers, half churned."""
    path = str(tmp_path_factory.mktemp("data") / "customers.parquet")
    copy = F.substring_index("customerID", "_b", -1).cast("double")
    many = replicate_rows(sample, 50, "customerID").withColumn(
        "MonthlyCharges", F.col("MonthlyCharges") + copy / 10
    )
    many.coalesce(2).write.parquet(path)
    return spark.read.parquet(path)
