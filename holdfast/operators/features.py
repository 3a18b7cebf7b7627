"""Feature fitting on training rows: impute, scale, one-hot, assemble.

Fitting gathers a handful of statistics per column; the fitted result is a plain Spark ML
``PipelineModel``, so it can be saved, loaded, chained with a classifier and used in a stream.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    OneHotEncoder,
    SQLTransformer,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from holdfast.functions import repair
from holdfast.operators import eda
from holdfast.spec import ModelingSpec

#: Columns with no more values than this are sorted whole to find the median.
MEDIAN_LIMIT = 100_000
#: Sketch accuracy used to close in on the median of larger columns.
SKETCH = 10_000
#: The assembled vector; helper columns start with an underscore to stay apart from a table's own.
FEATURES = "_features"


@dataclass(frozen=True)
class NumericStats:
    median: float
    mean: float
    std: float


@dataclass(frozen=True)
class CategoryStats:
    mode: str
    levels: tuple[str, ...]


@dataclass(frozen=True)
class FeatureStats:
    """Fitted statistics; columns without a single training value are left out."""

    numeric: Mapping[str, NumericStats]
    categorical: Mapping[str, CategoryStats]

    @property
    def names(self) -> list[str]:
        """Output feature names: numeric columns, then column_level."""
        levels = [f"{c}_{v}" for c, s in self.categorical.items() for v in s.levels]
        return [*self.numeric, *levels]


def feature_matrix(df: DataFrame, spec: ModelingSpec) -> DataFrame:
    """Feature columns only, in model order; missing ones are an error."""
    lacking = sorted(set(spec.features) - set(df.columns))
    if lacking:
        raise ValueError(f"feature columns missing: {lacking}")
    return df.select(*spec.features)


def exact_medians(
    df: DataFrame, columns: Sequence[str], limit: int = MEDIAN_LIMIT, sketch: int = SKETCH
) -> dict[str, float | None]:
    """Exact median of each column, missing values ignored, in a few wide aggregates.

    A column with up to ``limit`` values uses the built-in median. A longer one is bracketed by
    quantile sketches until few rows lie strictly inside the bracket; only those, grouped by
    value, are then ranked.
    """
    if not columns:
        return {}
    cols = list(columns)
    sizes = df.agg(*[F.count(c).alias(c) for c in cols]).first()
    done: dict[str, float | None] = {c: None for c in cols if sizes[c] == 0}
    short = [c for c in cols if 0 < sizes[c] <= limit]
    if short:
        row = df.agg(*[F.median(c).alias(c) for c in short]).first()
        done.update({c: float(row[c]) for c in short})

    # column -> (low, high, rows below low); the middle ranks lie in [low, high]
    bracket: dict[str, tuple[float, float, int, int]] = {}
    open_ = {c: (float("-inf"), float("inf"), 0, sizes[c]) for c in cols if c not in done}
    while open_:
        sketched = df.agg(
            *[
                F.percentile_approx(
                    F.when(F.col(c).between(lo, hi), F.col(c)),
                    [
                        max(0.0, ((sizes[c] - 1) // 2 + 1 - below) / n - 2 / sketch),
                        min(1.0, (sizes[c] // 2 + 1 - below) / n + 2 / sketch),
                    ],
                    sketch,
                ).alias(c)
                for c, (lo, hi, below, n) in open_.items()
            ]
        ).first()
        edges = {c: (float(sketched[c][0]), float(sketched[c][1])) for c in open_}
        counted = df.agg(
            *[
                e.alias(f"{name}{i}")
                for i, (c, (lo, hi)) in enumerate(edges.items())
                for name, e in (
                    ("below", F.count_if(F.col(c) < lo)),
                    ("held", F.count_if(F.col(c).between(lo, hi))),
                    ("inside", F.count_if((F.col(c) > lo) & (F.col(c) < hi))),
                )
            ]
        ).first()
        for i, (c, (lo, hi)) in enumerate(edges.items()):
            old = open_.pop(c)
            below, held, inside = (counted[f"{n}{i}"] for n in ("below", "held", "inside"))
            first, last = (sizes[c] - 1) // 2 + 1, sizes[c] // 2 + 1
            if not below < first <= last <= below + held:
                raise RuntimeError(f"median of {c!r} not bracketed")
            if inside <= limit or (lo, hi) == old[:2]:
                bracket[c] = (lo, hi, below, held)
            else:
                open_[c] = (lo, hi, below, held)
    if bracket:
        done.update(_ranked_medians(df, bracket, sizes))
    return {c: done[c] for c in cols}


def _ranked_medians(df: DataFrame, bracket: Mapping, sizes: Mapping[str, int]) -> dict[str, float]:
    """Middle values from the few distinct values inside each bracket."""
    near = df.select(
        *[F.when(F.col(c).between(b[0], b[1]), F.col(c)).alias(c) for c, b in bracket.items()]
    ).unpivot([], list(bracket), "column", "value")
    counts = (
        near.where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )
    start = F.create_map(*[F.lit(x) for c, b in bracket.items() for x in (c, b[2])])
    first = F.create_map(*[F.lit(x) for c in bracket for x in (c, (sizes[c] - 1) // 2 + 1)])
    last = F.create_map(*[F.lit(x) for c in bracket for x in (c, sizes[c] // 2 + 1)])
    upto = Window.partitionBy("column").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.withColumn("upto", F.sum("n").over(upto) + start[F.col("column")])
    before = F.col("upto") - F.col("n")
    middle = ranked.groupBy("column").agg(
        *[
            F.max(
                F.when(
                    (before < rank[F.col("column")]) & (F.col("upto") >= rank[F.col("column")]),
                    F.col("value"),
                )
            ).alias(name)
            for name, rank in (("low", first), ("high", last))
        ]
    )
    return {r["column"]: (r["low"] + r["high"]) / 2.0 for r in middle.collect()}


def fit_numeric(df: DataFrame, columns: Sequence[str]) -> dict[str, NumericStats]:
    """Median, and mean and population deviation after median imputation, per column."""
    numbers = df.select(*[repair.to_number(df, c).alias(c) for c in columns])
    medians = {c: m for c, m in exact_medians(numbers, columns).items() if m is not None}
    if not medians:
        return {}
    filled = {c: F.coalesce(F.col(c), F.lit(m)) for c, m in medians.items()}
    row = numbers.agg(
        *[F.avg(x).alias(f"a{i}") for i, x in enumerate(filled.values())],
        *[F.stddev_pop(x).alias(f"s{i}") for i, x in enumerate(filled.values())],
    ).first()
    return {
        c: NumericStats(m, float(row[f"a{i}"]), float(row[f"s{i}"]))
        for i, (c, m) in enumerate(medians.items())
    }


def fit_categorical(
    df: DataFrame, columns: Sequence[str], most_levels: int | None = None
) -> dict[str, CategoryStats]:
    """Most frequent value (smallest on ties) and sorted levels per column, one pass for all.

    Counting, ordering and the choice of the mode are Spark's; the driver gets the list of levels,
    which the encoder has to hold anyway: as many as there are categories, unless ``most_levels``
    sets a limit, beyond which the table is refused.
    """
    if not columns:
        return {}
    counts = eda.value_counts(df, columns).where(F.col("value").isNotNull())
    if most_levels is not None and not counts.offset(most_levels).isEmpty():
        raise ValueError(f"more than {most_levels} categories: too many to one-hot encode")
    best = F.struct((-F.col("n")).alias("less"), F.col("value").alias("value"))
    found = counts.groupBy("column").agg(
        F.min(best)["value"].alias("mode"), F.sort_array(F.collect_list("value")).alias("levels")
    )
    rows = {r["column"]: r for r in found.collect()}
    return {c: CategoryStats(rows[c]["mode"], tuple(rows[c]["levels"])) for c in columns if c in rows}


def fit_statistics(train: DataFrame, spec: ModelingSpec) -> FeatureStats:
    """All statistics, from training rows only."""
    x = feature_matrix(train, spec)
    return FeatureStats(
        fit_numeric(x, list(spec.numeric)),
        fit_categorical(x, list(spec.categorical), spec.most_levels),
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _named(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _number_sql(value: float) -> str:
    return f"cast('{value!r}' as double)"


def _read_sql(column: str) -> str:
    """A column read as ``repair.to_number`` reads it when fitting, whatever its type then."""
    text = f"btrim(cast({_named(column)} as string), {_quoted(repair.BLANKS)})"
    from_text = f"case when {text} rlike r'{repair.READABLE_TEXT}' then try_cast({text} as double) end"
    from_number = f"nullif(try_cast({_named(column)} as double), double('NaN'))"
    return f"case when typeof({_named(column)}) = 'string' then {from_text} else {from_number} end"


def repair_stage(stats: FeatureStats) -> SQLTransformer:
    """Imputed and scaled numbers and imputed text, as columns beside the originals."""
    parts = []
    for c, s in stats.numeric.items():
        spread = s.std if s.std > 0 else 1.0
        filled = f"coalesce({_read_sql(c)}, {_number_sql(s.median)})"
        scaled = f"({filled} - {_number_sql(s.mean)}) / {_number_sql(spread)}"
        parts.append(f"{scaled} as {_named('_num_' + c)}")
    for c, s in stats.categorical.items():
        filled = f"coalesce(cast({_named(c)} as string), {_quoted(s.mode)})"
        parts.append(f"{filled} as {_named('_txt_' + c)}")
    return SQLTransformer(statement=f"select *, {', '.join(parts)} from __THIS__")


def _levels_table(df: DataFrame, stats: FeatureStats) -> DataFrame:
    """The fitted levels side by side, shorter lists repeated: all that the indexer learns."""
    lists = [s.levels for s in stats.categorical.values()]
    longest = max(len(levels) for levels in lists)
    rows = [tuple(levels[i % len(levels)] for levels in lists) for i in range(longest)]
    schema = ", ".join(f"{_named('_txt_' + c)} string" for c in stats.categorical)
    return df.sparkSession.createDataFrame(rows, schema)


def feature_model(train: DataFrame, stats: FeatureStats) -> PipelineModel:
    """Fitted statistics as a self-contained model that adds the feature vector."""
    if not stats.names:
        raise ValueError("no feature column has any value in the training rows")
    stages: list = [repair_stage(stats)]
    cats = list(stats.categorical)
    if cats:
        indexer = StringIndexer(
            inputCols=[f"_txt_{c}" for c in cats],
            outputCols=[f"_idx_{c}" for c in cats],
            stringOrderType="alphabetAsc",
            handleInvalid="keep",
        ).fit(_levels_table(train, stats))
        stages.append(indexer)
        # The indexer's "keep" slot takes unknown values; dropping that last slot, and only
        # that one, leaves every level its own column and unknown values all zero.
        encoder = OneHotEncoder(
            inputCols=[f"_idx_{c}" for c in cats],
            outputCols=[f"_hot_{c}" for c in cats],
            dropLast=True,
            handleInvalid="error",
        ).fit(PipelineModel(stages=stages).transform(train))
        stages = [*stages, encoder]
    stages.append(
        VectorAssembler(
            inputCols=[*[f"_num_{c}" for c in stats.numeric], *[f"_hot_{c}" for c in cats]],
            outputCol=FEATURES,
        )
    )
    return PipelineModel(stages=stages)


def model_feature_names(model: PipelineModel) -> list[str]:
    """Output feature names of a fitted or loaded model, in vector order."""
    names: list[str] = []
    levels: dict[str, list[str]] = {}
    for stage in model.stages:
        if isinstance(stage, StringIndexerModel):
            columns = [c.removeprefix("_idx_") for c in stage.getOutputCols()]
            levels = {
                c: [f"{c}_{v}" for v in labels] for c, labels in zip(columns, stage.labelsArray)
            }
        elif isinstance(stage, VectorAssembler):
            for c in stage.getInputCols():
                if c.startswith("_num_"):
                    names.append(c.removeprefix("_num_"))
                else:
                    names += levels[c.removeprefix("_hot_")]
    return names


def fit_features(train: DataFrame, spec: ModelingSpec) -> tuple[PipelineModel, FeatureStats]:
    """Fit on training rows; apply the model to any rows."""
    stats = fit_statistics(train, spec)
    return feature_model(train, stats), stats


def transform_features(model: PipelineModel, df: DataFrame) -> DataFrame:
    """The rows with their feature vector and without the helper columns."""
    return model.transform(df).select(*df.columns, FEATURES)


def feature_manifest(train: DataFrame, spec: ModelingSpec, stats: FeatureStats) -> DataFrame:
    """Tidy record of a fit: rows, values per categorical column, output features."""
    spark = train.sparkSession
    facts = [("n_features_out", None, len(stats.names))]
    facts += [("feature_name", name, i) for i, name in enumerate(stats.names)]
    fixed = spark.createDataFrame(facts, "fact string, name string, value long")
    counted = eda.cardinality(train, list(spec.categorical)).select(
        F.lit("n_distinct").alias("fact"), F.col("column").alias("name"),
        F.col("n_distinct").alias("value"),
    )
    largest = counted.agg(F.max("value").alias("value")).select(
        F.lit("max_distinct").alias("fact"), F.lit(None).cast("string").alias("name"), "value"
    )
    rows = train.agg(F.count("*").alias("value")).select(
        F.lit("n_train_rows").alias("fact"), F.lit(None).cast("string").alias("name"), "value"
    )
    return rows.unionByName(counted).unionByName(largest).unionByName(fixed)
