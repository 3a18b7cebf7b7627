"""Level dictionaries as tables: one-hot features of columns with any number of levels.

``features`` keeps the levels of a fit in the model, which the driver has to hold. Here the levels are
a table: ranked by ranges, joined back to the rows. The driver knows a size and a mode per column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, OneHotEncoderModel, VectorAssembler
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from holdfast.operators import eda, features
from holdfast.spec import ModelingSpec
from holdfast.workspace import new_path


def ranked_levels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n, code): every level with its count and its place, from 0, among the sorted
    levels of its column. Missing values are no level.

    Levels are dealt by ranges of (column, value) and numbered inside each range; what meets in one
    place is a row for each range and column.
    """
    counts = eda.value_counts(df, columns).where(F.col("value").isNotNull())
    ranges = counts.repartitionByRange("column", "value").sortWithinPartitions("column", "value")
    place = F.monotonically_increasing_id()
    ranges = ranges.withColumn("_range", F.spark_partition_id()).withColumn("_place", place)
    path = new_path(df.sparkSession, "levels")
    ranges.write.parquet(path)
    ranges = df.sparkSession.read.schema(ranges.schema).parquet(path)
    parts = ranges.groupBy("column", "_range").agg(
        F.count("*").alias("_n"), F.min("_place").alias("_first")
    )
    before = Window.partitionBy("column").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "column", "_range", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    code = F.col("_place") - F.col("_first") + F.col("_before")
    return ranges.join(F.broadcast(parts), ["column", "_range"]).select(
        "column", "value", "n", code.alias("code")
    )


@dataclass(frozen=True)
class DictionaryFeatures:
    """Fitted features whose levels are a table under ``path``."""

    path: str
    repair: PipelineModel
    encoder: OneHotEncoderModel | None
    assembler: VectorAssembler

    @property
    def numeric(self) -> list[str]:
        return [c.removeprefix("_num_") for c in self.assembler.getInputCols() if c.startswith("_num_")]

    @property
    def sizes(self) -> dict[str, int]:
        """Levels per column, in vector order."""
        if self.encoder is None:
            return {}
        columns = [c.removeprefix("_idx_") for c in self.encoder.getInputCols()]
        return {c: n - 1 for c, n in zip(columns, self.encoder.categorySizes, strict=True)}

    def levels(self, spark: SparkSession) -> DataFrame:
        """(column, value, n, code) of the training rows."""
        return spark.read.schema("value string, n long, code long, column string").parquet(f"{self.path}/levels")

    def names(self, spark: SparkSession) -> DataFrame:
        """(place, feature): what stands at each place of the vector, a row for each."""
        numeric = self.numeric
        named = spark.createDataFrame(list(enumerate(numeric)), "place long, feature string")
        if not self.sizes:
            return named
        starts, at = [], len(numeric)
        for c, n in self.sizes.items():
            starts.append((c, at))
            at += n
        starts = F.broadcast(spark.createDataFrame(starts, "column string, start long"))
        found = self.levels(spark).join(starts, "column")
        feature = F.concat_ws("_", "column", "value")
        return named.unionAll(found.select((F.col("start") + F.col("code")).alias("place"), feature.alias("feature")))

    def transform(self, df: DataFrame) -> DataFrame:
        """The rows with their feature vector, as ``features.transform_features`` gives it.

        Each column's codes come by a join on its values. Spark broadcasts a column's levels where
        their table is small, and splits a frequent value's rows where it is not. Unknown values
        are all zero.
        """
        rows = self.repair.transform(df)
        levels = self.levels(df.sparkSession)
        for c, size in self.sizes.items():
            own = levels.where(F.col("column") == c).select(
                F.col("value").alias(f"_txt_{c}"), F.col("code").cast("double").alias(f"_idx_{c}")
            )
            rows = rows.join(own, f"_txt_{c}", "left")
            rows = rows.withColumn(f"_idx_{c}", F.coalesce(f"_idx_{c}", F.lit(float(size))))
        if self.encoder is not None:
            rows = self.encoder.transform(rows)
            for c, size in self.sizes.items():
                rows = _unnamed(rows, f"_hot_{c}", size)
        rows = self.assembler.transform(rows).select(*df.columns, features.FEATURES)
        return _unnamed(rows, features.FEATURES, len(self.numeric) + sum(self.sizes.values()))

    def save(self) -> None:
        """Beside the levels; ``load`` reads all of it back."""
        self.repair.write().overwrite().save(f"{self.path}/repair")
        self.assembler.write().overwrite().save(f"{self.path}/assembler")
        if self.encoder is not None:
            self.encoder.write().overwrite().save(f"{self.path}/encoder")


def _unnamed(df: DataFrame, column: str, size: int) -> DataFrame:
    """The vector column with its size as metadata, in place of a name for each of its places, which
    would travel with every task."""
    return df.withMetadata(column, {"ml_attr": {"num_attrs": size}})


def load(spark: SparkSession, path: str) -> DictionaryFeatures:
    assembler = VectorAssembler.load(f"{path}/assembler")
    hot = any(c.startswith("_hot_") for c in assembler.getInputCols())
    return DictionaryFeatures(
        path,
        PipelineModel.load(f"{path}/repair"),
        OneHotEncoderModel.load(f"{path}/encoder") if hot else None,
        assembler,
    )


def _facts(levels: DataFrame) -> Mapping[str, tuple[int, str]]:
    """(levels, most frequent value, the smallest on ties) per column: a row for each column."""
    best = F.min(F.struct((-F.col("n")).alias("less"), "value"))["value"]
    found = levels.groupBy("column").agg(F.count("*").alias("size"), best.alias("mode"))
    return {r["column"]: (r["size"], r["mode"]) for r in found.collect()}


def fit_features(train: DataFrame, spec: ModelingSpec, path: str) -> DictionaryFeatures:
    """Fit on training rows: numbers as ``features.fit_features``, levels as a table under ``path``.

    Vectors equal those of ``features.fit_features``: numbers first, then a place for each level in
    sorted order. No list of levels is gathered in a task or on the driver, so there is no limit on
    them. Columns without a single training value are left out; it is an error if none is left.
    """
    spark = train.sparkSession
    x = features.feature_matrix(train, spec)
    numeric = features.fit_numeric(x, list(spec.numeric))
    facts: Mapping[str, tuple[int, str]] = {}
    if spec.categorical:
        levels = ranked_levels(x, list(spec.categorical))
        levels.select("value", "n", "code", "column").write.partitionBy("column").mode("overwrite").parquet(f"{path}/levels")
        facts = _facts(spark.read.schema("value string, n long, code long, column string").parquet(f"{path}/levels"))
    columns = [c for c in spec.categorical if c in facts]
    if not columns and not numeric:
        raise ValueError("no feature column has any value in the training rows")
    stats = features.FeatureStats(numeric, {c: features.CategoryStats(facts[c][1], ()) for c in columns})
    encoder = None
    if columns:
        # One row that holds each column's highest code: the slot of unknown values, dropped as last.
        top = spark.range(1).select(*[F.lit(float(facts[c][0])).alias(f"_idx_{c}") for c in columns])
        encoder = OneHotEncoder(
            inputCols=[f"_idx_{c}" for c in columns],
            outputCols=[f"_hot_{c}" for c in columns],
            dropLast=True,
            handleInvalid="error",
        ).fit(top)
    fitted = DictionaryFeatures(
        path,
        PipelineModel(stages=[features.repair_stage(stats)]),
        encoder,
        VectorAssembler(
            inputCols=[*[f"_num_{c}" for c in numeric], *[f"_hot_{c}" for c in columns]],
            outputCol=features.FEATURES,
        ),
    )
    fitted.save()
    return fitted
