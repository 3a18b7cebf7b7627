"""Splitting and feature queries."""

from __future__ import annotations

from pyspark.ml.stat import Summarizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast import workspace
from holdfast.catalog import tables as t
from holdfast.catalog.entries import entry
from holdfast.catalog.scans import FEED_NUMBER
from holdfast.operators import dictionary, features, splitting, training
from holdfast.plans import prepare
from holdfast.spec import LabelSpec, ModelingSpec

SPEC = t.SNAPSHOT_SPEC
NUMBERS, TEXTS = list(SPEC.numeric), list(SPEC.categorical)
FOLDS = 5


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitting.stratified_split(
        t.written_snapshot(spark, sf_dir), SPEC.id_column, SPEC.label.column, t.SPLIT
    )


@entry("stratified_split", f"with {t.SPLIT_SQL} select customer_id, churn, split from split")
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir).select("customer_id", "churn", "split")


MANIFEST_SQL = (
    f"with {t.SPLIT_SQL}, names as (select unnest(['train', 'validation', 'test']) as split) "
    "select split, count(customer_id) as n_rows, round(coalesce(avg(case when churn = 'Yes' then "
    "cast(1 as double) when churn = 'No' then 0 end), 0), 6) as positive_rate "
    "from names left join split using (split) group by split"
)


@entry("split_manifest", MANIFEST_SQL)
def split_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitting.split_manifest(_split(spark, sf_dir), SPEC.label)


@entry("split_job", MANIFEST_SQL)
def split_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Splits written with a folder per split, and the manifest counted on what was written."""
    _, manifest = prepare.split_job(
        t.snapshot(spark, sf_dir), SPEC, t.SPLIT, workspace.new_path(spark, "splits")
    )
    return manifest


@entry(
    "split_overlap",
    f"with {t.SPLIT_SQL} select customer_id from split where split = 'train' intersect "
    "select customer_id from split where split = 'test'",
)
def split_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitting.split_overlap(_split(spark, sf_dir), "customer_id", "train", "test")


@entry(
    "union_splits",
    f"with {t.SNAPSHOT_SQL} select segment, churn, count(*) as n_rows from snapshot group by 1, 2",
)
def union_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three splits put together again hold every row once."""
    split = _split(spark, sf_dir)
    parts = [split.where(F.col("split") == s) for s in splitting.SPLIT_NAMES]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return whole.groupBy("segment", "churn").agg(F.count("*").alias("n_rows"))


@entry(
    "stratified_kfold",
    f"with {t.SNAPSHOT_SQL}, cls as (select churn, count(*) as c from snapshot group by churn), "
    "laid as (select churn, c, coalesce(sum(c) over (order by churn rows between unbounded "
    "preceding and 1 preceding), 0) as start from cls), "
    f"folds as (select unnest(range(0, {FOLDS})) as fold), "
    f"dealt as (select churn, fold, cast(floor((start + c - 1 - fold + {FOLDS}) / {FOLDS}) - floor((start - 1 - fold + {FOLDS}) "
    f"/ {FOLDS}) as bigint) as q from laid cross join folds), "
    "upto as (select churn, fold, sum(q) over (partition by churn order by fold) as hi, "
    "sum(q) over (partition by churn order by fold) - q as lo from dealt), "
    "ordered as (select customer_id, churn, row_number() over (partition by churn order by "
    "md5(concat('42:', cast(customer_id as varchar)))) as rn from snapshot) "
    "select customer_id, o.churn, cast(u.fold as integer) as fold from ordered o join upto u "
    "on o.churn = u.churn and rn > lo and rn <= hi",
)
def stratified_kfold(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.written_snapshot(spark, sf_dir)
    folds = splitting.stratified_folds(rows, SPEC.id_column, SPEC.label.column, FOLDS)
    return folds.select("customer_id", "churn", "fold")


@entry(
    "replicate_rows",
    "select concat(cast(c_custkey as varchar), '_b', cast(i as varchar)) as c_custkey, "
    "c_mktsegment from customer cross join range(0, 3) r(i)",
)
def replicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = t.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return splitting.replicate_rows(customers, 3, "c_custkey")


# --- features: fitted on the train split ------------------------------------------------------

TRAIN_SQL = t.SPLIT_SQL + ", train as (select * from split where split = 'train')"
MEDIANS_SQL = (
    TRAIN_SQL
    + ", med as (select "
    + ", ".join(f"median(cast({c} as double)) as m_{c}" for c in NUMBERS)
    + " from train)"
)
SCALE_SQL = (
    MEDIANS_SQL
    + ", fit as (select "
    + ", ".join(
        f"max(m_{c}) as m_{c}, avg(coalesce(cast({c} as double), m_{c})) as a_{c}, "
        f"stddev_pop(coalesce(cast({c} as double), m_{c})) as s_{c}"
        for c in NUMBERS
    )
    + " from train cross join med)"
)
MODES_SQL = (
    TRAIN_SQL
    + ", long as ("
    + " union all ".join(f"select '{c}' as col, {c} as v from train" for c in TEXTS)
    + "), counts as (select col, v, count(*) as n from long where v is not null group by col, v)"
    ", modes as (select col, v from (select *, row_number() over (partition by col order by n "
    "desc, v) as rn from counts) x where rn = 1)"
)


def _train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir).where(F.col("split") == "train")


def _listed(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Fitted statistics (a few per column) as a table."""
    return spark.createDataFrame(rows, schema)


@entry(
    "impute_median",
    f"with {MEDIANS_SQL} "
    + " union all ".join(
        f"select '{c}' as \"column\", round(m_{c}, 8) as median from med" for c in NUMBERS
    ),
)
def impute_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbers = _train(spark, sf_dir).select(*[F.col(c).cast("double").alias(c) for c in NUMBERS])
    medians = features.exact_medians(numbers, NUMBERS)
    return _listed(
        spark, [(c, round(m, 8)) for c, m in medians.items()], "column string, median double"
    )


@entry(
    "line_medians",
    " union all ".join(
        f"select '{c}' as \"column\", round(median({c}), 6) as median from lineitem"
        for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    ),
)
def line_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medians by bracketing, with the limits set so low that every step is taken."""
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    lines = t.table(spark, sf_dir, "lineitem").select(*columns)
    medians = features.exact_medians(lines, columns, limit=500, sketch=200)
    return _listed(
        spark, [(c, round(m, 6)) for c, m in medians.items()], "column string, median double"
    )


@entry(
    "scale_standard",
    f"with {SCALE_SQL} select customer_id, "
    + ", ".join(
        f"round((coalesce(cast({c} as double), m_{c}) - a_{c}) / s_{c}, 6) as {c}" for c in NUMBERS
    )
    + " from split cross join fit",
)
def scale_standard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer's numbers, imputed and scaled by the train statistics."""
    split = _split(spark, sf_dir)
    fitted = features.fit_numeric(split.where(F.col("split") == "train"), NUMBERS)
    return split.select(
        "customer_id",
        *[
            F.round(
                (F.coalesce(F.col(c).cast("double"), F.lit(s.median)) - s.mean)
                / (s.std if s.std > 0 else 1.0),
                6,
            ).alias(c)
            for c, s in fitted.items()
        ],
    )


@entry("impute_mode", f'with {MODES_SQL} select col as "column", v as mode from modes')
def impute_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted = features.fit_categorical(_train(spark, sf_dir), TEXTS)
    return _listed(
        spark, [(c, s.mode) for c, s in fitted.items()], "column string, mode string"
    )


# A median of two six-digit values has seven digits: eight leave no tie to round.
DIGITS = {"median": 8, "mean": 4, "std": 4}
FITTED_SQL = (
    f"with {SCALE_SQL}"
    + MODES_SQL[len(TRAIN_SQL):]
    + ", facts as ("
    + " union all ".join(
        f"select '{c}' as \"column\", '{k}' as stat, "
        f"round({p}_{c}, {DIGITS[k]}) as value from fit"
        for c in NUMBERS
        for k, p in (("median", "m"), ("mean", "a"), ("std", "s"))
    )
    + ")"
)


@entry(
    "features_fit",
    FITTED_SQL
    + ' select "column", stat, cast(null as varchar) as text, value from facts union all '
    "select col, 'mode', v, cast(null as double) from modes union all "
    "select col, 'level', v, cast(n as double) * 0 from counts",
)
def features_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything a fit holds: medians, means, deviations, modes and levels."""
    stats = features.fit_statistics(_train(spark, sf_dir), SPEC)
    rows: list[tuple] = []
    for c, s in stats.numeric.items():
        rows += [(c, k, None, round(getattr(s, k), n)) for k, n in DIGITS.items()]
    for c, s in stats.categorical.items():
        rows.append((c, "mode", s.mode, None))
        rows += [(c, "level", v, 0.0) for v in s.levels]
    return _listed(spark, rows, "column string, stat string, text string, value double")


ENCODED_SQL = (
    f"with {SCALE_SQL}"
    + MODES_SQL[len(TRAIN_SQL):]
    + ", held as (select * from split), filled as (select "
    + ", ".join(
        f"coalesce({c}, (select v from modes where col = '{c}')) as {c}" for c in TEXTS
    )
    + " from held), seen as ("
    + " union all ".join(
        f"select '{c}' as col, {c} as v, count(*) as k from filled group by {c}" for c in TEXTS
    )
    + "), hot as (select concat(c.col, '_', c.v) as feature, coalesce(s.k, 0) as n_ones "
    "from counts c left join seen s on s.col = c.col and s.v = c.v)"
)


def _sums(model_rows: DataFrame) -> DataFrame:
    """Sum and non-zero count of every element of the feature vector, in one aggregate."""
    measured = model_rows.select(
        Summarizer.metrics("sum", "numNonZeros").summary(F.col(features.FEATURES)).alias("m")
    )
    return measured.select(
        F.posexplode(
            F.arrays_zip(
                vector_to_array("m.sum").alias("total"),
                vector_to_array("m.numNonZeros").alias("nonzero"),
            )
        ).alias("at", "v")
    ).select("at", "v.total", "v.nonzero")


def _encoded(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    """Per output feature: sums over every customer, encoded by the train fit."""
    split = _split(spark, sf_dir)
    model, stats = features.fit_features(split.where(F.col("split") == "train"), SPEC)
    named = F.element_at(F.array(*[F.lit(n) for n in stats.names]), F.col("at") + 1)
    sums = _sums(features.transform_features(model, split))
    return sums.withColumn("feature", named), stats.names


@entry("one_hot", ENCODED_SQL + " select feature, n_ones from hot")
def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each one-hot column is set over all customers, unknown values being all zero."""
    sums, names = _encoded(spark, sf_dir)
    return sums.where(~F.col("feature").isin(NUMBERS)).select(
        "feature", F.col("total").cast("long").alias("n_ones")
    )


@entry("one_hot_dictionary", ENCODED_SQL + " select feature, n_ones from hot")
def one_hot_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``one_hot``, with the levels and the features' names as tables."""
    split = _split(spark, sf_dir)
    path = workspace.new_path(spark, "dictionary")
    dictionary.fit_features(split.where(F.col("split") == "train"), SPEC, path)
    fitted = dictionary.load(spark, path)
    sums = _sums(fitted.transform(split)).join(fitted.names(spark), F.col("at") == F.col("place"))
    return sums.where(~F.col("feature").isin(NUMBERS)).select(
        "feature", F.col("total").cast("long").alias("n_ones")
    )


CODED = ("user_id", "event_type", "value")


@entry(
    "level_codes",
    "with long as ("
    + " union all ".join(f"select '{c}' as \"column\", cast({c} as varchar) as value from events" for c in CODED[:2])
    + " union all select 'value', cast(cast(floor(value) as bigint) as varchar) from events), counts as "
    "(select \"column\", value, count(*) as n from long where value is not null group by 1, 2) select *, "
    "row_number() over (partition by \"column\" order by value) - 1 as code from counts",
)
def level_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every level of three columns of events with its place among the column's sorted levels."""
    events = t.table(spark, sf_dir, "events").withColumn("value", F.floor("value"))
    return dictionary.ranked_levels(events, CODED)


@entry(
    "features_transform",
    ENCODED_SQL
    + " select feature, round(cast(n_ones as double), 4) as total from hot union all "
    + " union all ".join(
        f"select '{c}', round(sum((coalesce(cast({c} as double), m_{c}) - a_{c}) / s_{c}), 4) "
        "from split cross join fit"
        for c in NUMBERS
    ),
)
def features_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The assembled vector over all customers, summed per feature."""
    sums, _ = _encoded(spark, sf_dir)
    return sums.select("feature", F.round("total", 4).alias("total"))


@entry(
    "text_features",
    f"with {t.FEED_SQL}, x as (select {FEED_NUMBER.format(c='price_text')} as p from feed), "
    "m as (select median(p) as middle from x), f as (select coalesce(p, middle) as v from x "
    "cross join m), s as (select avg(v) as a, stddev_pop(v) as s from f) select count(*) as n_rows, "
    "round(sum(abs((v - a) / s)), 3) as total, round(min((v - a) / s), 6) as least "
    "from f cross join s",
)
def text_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers that arrive as text, read alike by the fit and by the transform."""
    feed = t.feed(spark, sf_dir)
    spec = ModelingSpec("order_key", {"price_text": "number"}, ("flag_text",), LabelSpec("status"))
    model, _ = features.fit_features(feed, spec)
    scaled = vector_to_array(features.FEATURES)[0]
    return features.transform_features(model, feed).agg(
        F.count("*").alias("n_rows"),
        F.round(F.sum(F.abs(scaled)), 3).alias("total"),
        F.round(F.min(scaled), 6).alias("least"),
    )


@entry(
    "feature_manifest",
    f"with {MODES_SQL}, per as (select col, count(distinct v) + max(case when v is null then 1 "
    "else 0 end) as k from long group by col), names as ("
    + " union all ".join(f"select '{c}' as name, {i} as value" for i, c in enumerate(NUMBERS))
    + " union all select concat(col, '_', v), "
    + f"{len(NUMBERS) - 1} + row_number() over (order by list_position("
    + f"{TEXTS!r}, col), v) from counts) "
    "select 'n_train_rows' as fact, cast(null as varchar) as name, count(*) as value from train "
    "union all select 'n_distinct', col, k from per union all select 'max_distinct', null, max(k) "
    "from per union all select 'feature_name', name, value from names union all "
    "select 'n_features_out', null, count(*) from names",
)
def feature_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = _train(spark, sf_dir)
    return features.feature_manifest(train, SPEC, features.fit_statistics(train, SPEC))


@entry(
    "class_weights",
    f"with {t.SNAPSHOT_SQL}, c as (select cast(count(*) filter (where churn <> 'Yes') as double) "
    "as n0, cast(count(*) filter (where churn = 'Yes') as double) as n1 from snapshot) "
    "select 'balanced' as mode, 0 as y, cast(n0 as bigint) as n_rows, round((n0 + n1) / (2 * n0), "
    "6) as weight from c union all select 'balanced', 1, cast(n1 as bigint), "
    "round((n0 + n1) / (2 * n1), 6) from c union all select 'unbalance', 0, cast(n0 as bigint), "
    "round(greatest(1, n1 / n0), 6) from c union all select 'unbalance', 1, cast(n1 as bigint), "
    "round(greatest(1, n0 / n1), 6) from c",
)
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.snapshot(spark, sf_dir)

    def listed(mode: str) -> DataFrame:
        weights = training.class_weights(rows, SPEC.label, mode)
        return weights.select(
            F.lit(mode).alias("mode"), "y", "n_rows", F.round("weight", 6).alias("weight")
        )

    return listed(training.BALANCED).unionByName(listed(training.UNBALANCE))
