"""A corpus pipeline: language, near-duplicates, benchmark passages, secrets, mixture.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its output is written as Parquet and
read again as the next stage's docs. All stages but the last return the columns of their input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from holdfast.llm.decontaminate import drop_leaks
from holdfast.llm.entries import entry, table
from holdfast.llm.langid import keep_identified
from holdfast.llm.mixing import mix
from holdfast.llm.secrets import redact
from holdfast.llm.simhash import drop_near_duplicates
from holdfast.workspace import new_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known stay; those without a letter or a clear language go."""
    return keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return drop_near_duplicates(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, copied or edited, go."""
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    return redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training mix: pieces of documents in blocks, dealt to shards."""
    return mix(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("benchmark_passages", benchmark_passages),
    ("secrets", secrets),
    ("mixture", mixture),
]

#: No SQL: stages are trained models and similarity joins. tests/llm checks run() by brute force.
ORACLE_SQL = None


@entry("pipeline")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the whole of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = new_path(spark, name)
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
