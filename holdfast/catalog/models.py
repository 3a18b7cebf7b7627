"""Queries that fit models, score with them and stream."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast import workspace
from holdfast.catalog import tables as t
from holdfast.catalog.entries import entry
from holdfast.operators import features, splitting, training
from holdfast.operators.quality import Check
from holdfast.plans import evaluate, score, train
from holdfast.sources import registry, sinks
from holdfast.spec import LabelSpec, LogisticSpec, ModelingSpec, SearchSpec
from holdfast.streaming import labels, late, windows
from holdfast.streaming import scoring as stream_scoring

SPEC = t.SNAPSHOT_SPEC
#: A search small enough to run as a query: the rows are whole, only the settings are few.
SMALL_SEARCH = SearchSpec(
    folds=2,
    draws=2,
    grid={
        "learning_rate": [0.1, 0.2],
        "n_estimators": [5, 8],
        "max_depth": [3, 4],
        "min_child_samples": [20],
    },
)
POINT = {"learning_rate": 0.1, "n_estimators": 8, "max_depth": 4, "min_child_samples": 20}


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The split snapshot: a projection of the written table."""
    return splitting.stratified_split(
        t.written_snapshot(spark, sf_dir), SPEC.id_column, SPEC.label.column, t.SPLIT
    )


def _part(split: DataFrame, name: str) -> DataFrame:
    return split.where(F.col("split") == name).drop("split")


@entry("train_logistic")
def train_logistic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coefficients of the balanced logistic baseline."""
    train_rows = _part(_split(spark, sf_dir), "train")
    model = training.fit_logistic(train_rows, SPEC)
    return spark.createDataFrame(
        training.model_coefficients(model), "feature string, coefficient double"
    )


OPTIMUM_SQL = (
    f"with {t.SPLIT_SQL}, train as (select * from split where split = 'train') "
    + " union all ".join(
        f"select '{c}' as feature, cast(0 as double) as slope from (select 1) x"
        for c in SPEC.numeric
    )
    + " union all "
    + " union all ".join(
        f"select distinct concat('{c}_', {c}), cast(0 as double) from train where {c} is not null"
        for c in SPEC.categorical
    )
    + " union all select '(intercept)', cast(0 as double)"
)


@entry("logistic_optimum", OPTIMUM_SQL)
def logistic_optimum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slope of the penalised loss per weight and feature at the fitted model: zero everywhere."""
    train_rows = _part(_split(spark, sf_dir), "train")
    settings = LogisticSpec(tolerance=1e-9)
    model = training.fit_logistic(train_rows, SPEC, settings)
    weighted = training.with_weight(train_rows, SPEC.label, settings.class_weight)
    miss = F.col(training.WEIGHT) * (training.positive_probability() - F.col(training.Y))
    parts = F.concat(F.array(F.lit(1.0)), vector_to_array(features.FEATURES))
    sums = (
        model.transform(weighted)
        .select(miss.alias("miss"), training.WEIGHT, F.posexplode(parts).alias("at", "x"))
        .groupBy("at")
        .agg(F.sum(F.col("miss") * F.col("x")).alias("pull"), F.sum(training.WEIGHT).alias("w"))
    )
    fitted = training.model_coefficients(model)
    names = F.array(*[F.lit(n) for n, _ in fitted])
    # The intercept carries no penalty.
    shrink = F.array(F.lit(0.0), *[F.lit(c / settings.inverse_penalty) for _, c in fitted[1:]])
    slope = (F.col("pull") + F.element_at(shrink, F.col("at") + 1)) / F.col("w")
    return sums.select(
        F.element_at(names, F.col("at") + 1).alias("feature"),
        (F.round(slope, 3) + 0.0).alias("slope"),
    )


@entry("train_gbt")
def train_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation metrics of boosted trees."""
    split = _split(spark, sf_dir)
    model = training.fit_trees(_part(split, "train"), SPEC, POINT)
    metrics = train.validation_metrics(model, _part(split, "validation"), SPEC)
    return spark.createDataFrame(list(metrics.items()), "metric string, value double")


def _searched(spark: SparkSession, sf_dir: str) -> tuple[train.Trained, training.SearchResult, str]:
    split = _split(spark, sf_dir)
    base = workspace.new_path(spark, "search")
    trained, result = train.train_trees_job(
        _part(split, "train"), _part(split, "validation"), SPEC,
        model_path=f"{base}/model", runs_path=f"{base}/runs", search=SMALL_SEARCH,
    )
    return trained, result, f"{base}/runs"


@entry("random_search")
def random_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every trial's score on every fold."""
    split = _split(spark, sf_dir)
    return training.random_search(_part(split, "train"), SPEC, SMALL_SEARCH).trials


@entry("best_params")
def best_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Settings of the best trial with its cross-validated score and validation metrics."""
    trained, result, _ = _searched(spark, sf_dir)
    best = train.best_settings(SMALL_SEARCH, result, trained.metrics)
    facts = [("cv_best_mean_roc_auc", str(best["cv_best_mean_roc_auc"]))]
    facts += [(k, str(v)) for part in ("validation_metrics", "settings") for k, v in best[part].items()]
    return spark.createDataFrame(facts, "name string, value string")


@entry("run_log")
def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The search as logged: one parent run and a run per trial."""
    _, _, runs = _searched(spark, sf_dir)
    logged = spark.read.parquet(runs)
    return logged.select(
        "name", F.col("parent_run_id").isNotNull().alias("is_trial"),
        F.explode("metrics").alias("metric", "value"),
    )


def _baseline(
    spark: SparkSession, sf_dir: str
) -> tuple[DataFrame, train.Trained, str]:
    split = _split(spark, sf_dir)
    base = workspace.new_path(spark, "baseline")
    trained = train.train_logistic_job(
        _part(split, "train"), _part(split, "validation"), SPEC,
        model_path=f"{base}/model", runs_path=f"{base}/runs",
    )
    return split, trained, base


@entry("train_job")
def train_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit, measure, log and save; the logged validation metrics as a leaderboard."""
    _, _, base = _baseline(spark, sf_dir)
    return registry.leaderboard(spark.read.parquet(f"{base}/runs"), "val_roc_auc").drop("run_id")


def _evaluated(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    split, _, base = _baseline(spark, sf_dir)
    summary = evaluate.evaluation_job(
        split, SPEC, base, champion_path=f"{base}/champion", champion_model=f"{base}/model"
    )
    return summary, base


@entry("evaluation_job")
def evaluation_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot, split, fit, score, choose the cut, evaluate: the whole way."""
    summary, _ = _evaluated(spark, sf_dir)
    return summary


@entry("champion_freeze")
def champion_freeze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The frozen champion as appended by the evaluation."""
    _, base = _evaluated(spark, sf_dir)
    return spark.read.parquet(f"{base}/champion").drop("ts", "model_path")


@entry("champion_read")
def champion_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, base = _evaluated(spark, sf_dir)
    champion = registry.read_champion(spark, f"{base}/champion")
    return spark.createDataFrame(
        [(champion["threshold"], champion["recall_floor"], champion["floor_kept"])],
        "threshold double, recall_floor double, floor_kept boolean",
    )


@entry(
    "champion_resolve",
    f"with {t.SPLIT_SQL} select source, count(*) as n_scored from split cross join "
    "(select unnest(['override', 'champion', 'fallback']) as source) x where split = 'test' "
    "group by source",
)
def champion_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which model each order of candidates falls on, and how many rows it scores."""
    split, trained, base = _baseline(spark, sf_dir)
    cases = [
        registry.resolve_model(spark, f"{base}/model"),
        registry.resolve_model(spark, None, f"{base}/model", f"{base}/other"),
        registry.resolve_model(spark, None, f"{base}/gone", f"{base}/model"),
    ]
    parts = []
    for path, which in cases:
        scored = training.score_rows(PipelineModel.load(path), _part(split, "test"))
        parts.append(
            scored.agg(F.count(training.SCORE).alias("n_scored")).select(
                F.lit(which).alias("source"), "n_scored"
            )
        )
    return reduce(DataFrame.unionByName, parts)


def prepared_batch(spark: SparkSession, sf_dir: str) -> tuple[Callable[[], score.Scored], str]:
    """A champion frozen and the customers written; what scores that file, and the folder it all is in."""
    _, base = _evaluated(spark, sf_dir)
    source = sinks.write_table(t.snapshot(spark, sf_dir), f"{base}/snapshot.parquet")

    def run() -> score.Scored:
        return score.score_batch(
            spark, source, f"{base}/scores.parquet", SPEC, f"{base}/champion", mode=score.QUARANTINE,
            rejects_path=f"{base}/rejects.parquet", runs_path=f"{base}/scoring_runs",
        )

    return run, base


def _batch(spark: SparkSession, sf_dir: str) -> tuple[score.Scored, str]:
    """All customers scored from a file with the frozen champion, refused rows set aside."""
    run, base = prepared_batch(spark, sf_dir)
    return run(), base


@entry("score_batch")
def score_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    done, _ = _batch(spark, sf_dir)
    return done.scores


@entry(
    "score_rejects",
    f"with {t.SNAPSHOT_SQL} select customer_id, 'top_priority: must not be empty' as reasons "
    "from snapshot where top_priority is null",
)
def score_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers refused by the row rules: no order history, so no usual priority."""
    done, _ = _batch(spark, sf_dir)
    return done.rejects.select("customer_id", F.array_join("reasons", "; ").alias("reasons"))


@entry(
    "score_accounting",
    f"with {t.SNAPSHOT_SQL} select 'scored' as outcome, cast(null as varchar) as reason, "
    "count(top_priority) as n_rows from snapshot union all select 'refused', "
    "'top_priority: must not be empty', count(*) from snapshot where top_priority is null "
    "having count(*) > 0 union all select 'read', null, count(*) from snapshot",
)
def score_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row read is scored or refused: rows by outcome, refused ones by reason."""
    done, base = _batch(spark, sf_dir)

    def outcome(rows: DataFrame, name: str) -> DataFrame:
        return rows.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("outcome"), F.lit(None).cast("string").alias("reason"), "n_rows"
        )

    refused = done.rejects.select(F.explode("reasons").alias("reason")).groupBy("reason")
    read = spark.read.parquet(f"{base}/snapshot.parquet")
    return (
        outcome(done.scores, "scored")
        .unionByName(refused.agg(F.count("*").alias("n_rows")).withColumn("outcome", F.lit("refused")))
        .unionByName(outcome(read, "read"))
    )


@entry(
    "score_metadata",
    f"with {t.SNAPSHOT_SQL} select 'v1' as version, 'champion' as threshold_source, "
    "count(top_priority) as n_rows, count(*) - count(top_priority) as n_rejected from snapshot",
)
def score_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scoring run as recorded; rows were counted on what was written."""
    _, base = _batch(spark, sf_dir)
    runs = spark.read.parquet(f"{base}/scoring_runs")
    return runs.select("version", "threshold_source", "n_rows", "n_rejected")


# --- streams ---------------------------------------------------------------------------------


@entry(
    "score_stream",
    f"with {t.SNAPSHOT_SQL} select customer_id, top_priority is null as refused, case when "
    "top_priority is not null then true end as scored_in_range from snapshot",
)
def score_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON rows streamed through the row rules and the model: scores, and rejects beside them."""
    split, trained, base = _baseline(spark, sf_dir)
    rows = t.snapshot(spark, sf_dir)
    rows.write.json(f"{base}/incoming")
    incoming = spark.readStream.schema(rows.schema).json(f"{base}/incoming")
    stream_scoring.score_stream(
        incoming, trained.model, SPEC, 0.5, path=f"{base}/stream", checkpoint=f"{base}/stream_state"
    ).awaitTermination()
    scores = stream_scoring.committed(spark, f"{base}/stream", "scores")
    rejects = stream_scoring.committed(spark, f"{base}/stream", "rejects")
    return scores.select(
        "customer_id",
        F.lit(False).alias("refused"),
        F.col(training.SCORE).between(0.0, 1.0).alias("scored_in_range"),
    ).unionByName(
        rejects.select(
            "customer_id",
            F.lit(True).alias("refused"),
            F.lit(None).cast("boolean").alias("scored_in_range"),
        )
    )


def _event_checks() -> list[Check]:
    known = F.col("event_type").isin("click", "purchase", "signup", "view")
    return [
        Check("domain", "event_type", ~known),
        Check("minimum", "value", F.col("value") < 1.0),
        Check("not_null", "user_id", F.col("user_id").isNull()),
    ]


EVENT_WINDOWS_SQL = (
    "select cast(time_bucket(interval '6 hours', ts, timestamp '1970-01-01') as timestamp) as "
    "window_start, count(*) as n_rows, count(*) filter (where event_type not in ('click', "
    "'purchase', 'signup', 'view')) as domain_event_type, count(*) filter (where value < 1) as "
    "minimum_value, count(*) filter (where user_id is null) as not_null_user_id "
    "from events group by 1"
)


def _naive(df: DataFrame) -> DataFrame:
    return df.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table, one file or a folder of them, as a file stream, its times as instants."""
    events = t.table(spark, sf_dir, "events")
    source = spark.readStream.schema(events.schema)
    if any(f.endswith("/events.parquet") for f in events.inputFiles()):
        # a stream reads folders: of this one, the one file
        source = source.option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    else:
        source = source.parquet(f"{sf_dir}/events.parquet")
    return source.withColumn("ts", F.col("ts").cast(T.TimestampType()))


@entry("validate_windows", EVENT_WINDOWS_SQL)
def validate_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failures per six hours, on the table."""
    return windows.window_failures(t.table(spark, sf_dir, "events"), "ts", "6 hours", _event_checks())


@entry("validate_stream", EVENT_WINDOWS_SQL)
def validate_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same counts kept by a stream."""
    base = workspace.new_path(spark, "validate_stream")
    windows.validate_stream(
        _event_stream(spark, sf_dir), "ts", "6 hours", _event_checks(),
        output=f"{base}/out", checkpoint=f"{base}/state", watermark="1 hour",
    ).awaitTermination()
    return _naive(windows.latest_windows(spark.read.parquet(f"{base}/out")))


LATE_WINDOWS_SQL = EVENT_WINDOWS_SQL.replace(
    " from events",
    ", count(*) filter (where event_id % 3 = 0 and time_bucket(interval '6 hours', ts, timestamp "
    "'1970-01-01') + interval '6 hours' <= (select max(ts) from events where event_id % 3 <> 0) - "
    "interval '1 hour') as n_late from events",
    1,
)


@entry("late_windows", LATE_WINDOWS_SQL)
def late_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window counts where every third event comes in a second run, mostly late: none is left out."""
    base = workspace.new_path(spark, "late_windows")
    events = t.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast(T.TimestampType()))
    third = F.col("event_id") % 3 == 0
    for part in (events.where(~third), events.where(third)):
        part.write.mode("append").parquet(f"{base}/in")
        late.count_stream(
            spark.readStream.schema(events.schema).parquet(f"{base}/in"), "ts", "6 hours", _event_checks(),
            path=f"{base}/out", checkpoint=f"{base}/state", delay="1 hour",
        ).awaitTermination()
    return _naive(late.with_late(late.counts(spark, f"{base}/out")))


DRIFT_WINDOWS_SQL = (
    "with half as (select min(ts) + (max(ts) - min(ts)) / 2 as middle from events), "
    "ref as (select event_type as v, count(*) as r from events cross join half where ts < middle "
    "group by 1), win as (select cast(time_bucket(interval '1 day', ts, timestamp '1970-01-01') as "
    "timestamp) as w, event_type as v, count(*) as c from events group by 1, 2), "
    "cells as (select w, v, cast(r as double) as r, 0 as c from (select distinct w from win) x "
    "cross join ref union all select w, v, 0, c from win), tab as (select w, v, sum(r) as r, "
    "cast(sum(c) as double) as c from cells group by 1, 2), tot as (select *, sum(r) over p as ar, "
    "sum(c) over p as ac, count(*) over p as k from tab window p as (partition by w)), "
    "e as (select *, (r + c) / (ar + ac) * ar as er, (r + c) / (ar + ac) * ac as ec from tot) "
    "select w as window_start, 'event_type' as \"column\", max(k) as n_values, "
    "cast(max(ar) as bigint) as n_ref, cast(max(ac) as bigint) as n_cur, max(k) - 1 as dof, "
    "round(sum((r - er) * (r - er) / er + (c - ec) * (c - ec) / ec), 6) as statistic "
    "from e group by w"
)


def _event_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category counts of the first half of the event time."""
    events = t.table(spark, sf_dir, "events")
    first, last = F.min("ts"), F.max("ts")
    half = events.agg((first + (last - first) / 2).alias("at")).scalar()
    return events.where(F.col("ts") < half).groupBy(
        F.lit("event_type").alias("column"), F.col("event_type").alias("value")
    ).agg(F.count("*").alias("n"))


WINDOW_COLUMNS = ["window_start", "column", "n_values", "n_ref", "n_cur", "dof", "statistic"]


def _tested(counts: DataFrame, reference: DataFrame) -> DataFrame:
    found = windows.drift_windows(counts, reference).select(*WINDOW_COLUMNS)
    return found.withColumn("statistic", F.round("statistic", 6))


@entry("drift_windows", DRIFT_WINDOWS_SQL)
def drift_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day's event types against the first half, on the table."""
    counts = windows.window_category_counts(
        t.table(spark, sf_dir, "events"), "ts", "1 day", ["event_type"]
    )
    return _tested(counts, _event_reference(spark, sf_dir))


@entry("drift_stream", DRIFT_WINDOWS_SQL)
def drift_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same test on counts kept by a stream."""
    base = workspace.new_path(spark, "drift_stream")
    windows.drift_stream(
        _event_stream(spark, sf_dir), "ts", "1 day", ["event_type"],
        output=f"{base}/out", checkpoint=f"{base}/state", watermark="1 hour",
    ).awaitTermination()
    counts = _naive(windows.latest_counts(spark.read.parquet(f"{base}/out")))
    return _tested(counts, _event_reference(spark, sf_dir))


# --- labels that come later ------------------------------------------------------------------

VIEWS = ModelingSpec("user_id", {}, (), LabelSpec("bought"))
LATE_LABELS_SQL = (
    "with s as (select distinct user_id, ts, case when value >= 50 then 'Yes' else 'No' end as p from events where "
    "event_type = 'view'), l as (select user_id, ts as lts, case when value >= 50 then 'Yes' else 'No' end as a from "
    "events where event_type = 'purchase'), j as (select s.*, lts, a, row_number() over (partition by s.user_id, "
    "s.ts, p order by lts, a) as rn from s left join l on l.user_id = s.user_id and lts >= s.ts and lts <= s.ts + "
    "interval 1 day) select user_id, cast(ts as timestamp) as scored_at, p as predicted_churn, cast(lts as timestamp) "
    "as labelled_at, a as actual_churn from j where rn = 1"
)


def _views(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Views as scores of users, purchases as labels that come later; large ones are positive."""
    events = t.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast(T.TimestampType()))
    large = F.when(F.col("value") >= 50, "Yes").otherwise("No")
    scores = events.where("event_type = 'view'").select(
        "user_id", F.col("ts").alias("scored_at"), large.alias("predicted_churn")
    )
    found = events.where("event_type = 'purchase'").select(
        "user_id", F.col("ts").alias("labelled_at"), large.alias("bought")
    )
    return scores, found


def _plain_times(labelled: DataFrame) -> DataFrame:
    return labelled.withColumns({c: F.col(c).cast("timestamp_ntz") for c in (labels.SCORED, labels.LABELLED)})


@entry("late_labels", LATE_LABELS_SQL)
def late_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every score with its first label within a day, from tables."""
    return _plain_times(labels.scored_with_labels(*_views(spark, sf_dir), VIEWS, "1 day"))


@entry("label_stream", LATE_LABELS_SQL)
def label_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from two streams, a file at a time; rows far in the future close all scores."""
    base = workspace.new_path(spark, "label_stream")
    streams = []
    for name, table in zip(("scores", "labels"), _views(spark, sf_dir), strict=True):
        time = table.columns[1]
        table.repartitionByRange(3, time).write.parquet(f"{base}/{name}")
        for year in (2100, 2101, 2102):
            end = F.lit(f"{year}-01-01 00:00:00").cast("timestamp")
            table.limit(1).select(F.lit(-1).cast("long").alias("user_id"), end.alias(time), F.lit("No").alias(table.columns[2])).write.mode(
                "append"
            ).parquet(f"{base}/{name}")
        stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1)
        streams.append(stream.parquet(f"{base}/{name}"))
    labels.label_stream(
        *streams, VIEWS, "1 day", watermark="60 days", path=f"{base}/out", checkpoint=f"{base}/state"
    ).awaitTermination()
    found = labels.streamed_labels(spark, f"{base}/out", VIEWS)
    return _plain_times(found.where("user_id >= 0"))
