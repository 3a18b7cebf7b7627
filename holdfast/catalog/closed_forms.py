"""The model jobs on features whose fitted model SQL can state.

A logistic model on one categorical column whose penalty vanishes gives every level its weighted
share of positives; a single tree of one level on a flag gives either side a figure of its weighted
mean. The jobs run as they do on all columns; only the columns are few.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from holdfast import workspace
from holdfast.catalog import metrics as m
from holdfast.catalog import tables as t
from holdfast.catalog.entries import ORACLES, entry
from holdfast.operators import splitting, training
from holdfast.plans import evaluate, score, train
from holdfast.sources import registry, sinks
from holdfast.spec import LogisticSpec, ModelingSpec, SearchSpec
from holdfast.streaming import scoring as streaming

LEVELS = ModelingSpec("customer_id", {}, ("segment",), t.SNAPSHOT_SPEC.label)
FLAG = ModelingSpec("customer_id", {"is_debtor": "flag"}, (), t.SNAPSHOT_SPEC.label)
SHARP = LogisticSpec(inverse_penalty=1e9, tolerance=1e-12)
ONE_SPLIT = {"learning_rate": 0.1, "n_estimators": 1, "max_depth": 1, "min_child_samples": 1}

_TRAIN = (
    t.SPLIT_SQL
    + ", train as (select *, case when churn = 'Yes' then 1 else 0 end as y from split where "
    "split = 'train'), sides as (select cast(sum(y) as double) as n1, cast(sum(1 - y) as double) "
    "as n0 from train)"
)
SHARES_SQL = (
    _TRAIN + ", shares as (select segment, (sum(y) / max(n1)) / (sum(y) / max(n1) + sum(1 - y) / "
    "max(n0)) as p from train cross join sides group by segment)"
)
#: Held-out rows with the closed-form score, under the names the metric queries use.
SCORED_SQL = (
    SHARES_SQL + ", scored as (select customer_id, split, p as score, case when churn = 'Yes' then 1 "
    "else 0 end as y from split join shares using (segment) where split <> 'train')"
)


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitting.stratified_split(
        t.written_snapshot(spark, sf_dir), "customer_id", t.SNAPSHOT_SPEC.label.column, t.SPLIT
    ).select("customer_id", "segment", "is_debtor", "churn", "split")


def _part(split: DataFrame, name: str) -> DataFrame:
    return split.where(F.col("split") == name).drop("split")


def _trained(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, train.Trained, str]:
    split = _split(spark, sf_dir)
    base = workspace.new_path(spark, "levels")
    trained = train.train_logistic_job(
        _part(split, "train"), _part(split, "validation"), LEVELS,
        model_path=f"{base}/model", runs_path=f"{base}/runs", settings=SHARP,
    )
    return split, trained, base


def _evaluated(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, str]:
    split, _, base = _trained(spark, sf_dir)
    summary = evaluate.evaluation_job(
        split, LEVELS, base, champion_path=f"{base}/champion", champion_model=f"{base}/model"
    )
    return split, summary, base


@entry(
    "logistic_by_level",
    f"with {SHARES_SQL} select segment, round(p, 4) as probability from shares",
)
def logistic_by_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fitted probability of every level."""
    split = _split(spark, sf_dir)
    rows = _part(split, "train")
    model = training.fit_logistic(rows, LEVELS, SHARP)
    levels = rows.select("segment").distinct()
    found = training.score_rows(model, levels, "p")
    return found.select("segment", F.round("p", 4).alias("probability"))


@entry(
    "tree_by_flag",
    f"with {_TRAIN}, w as (select greatest(1, n0 / n1) as w1, greatest(1, n1 / n0) as w0 from sides), "
    "means as (select is_debtor, sum((2 * y - 1) * case y when 1 then w1 else w0 end) / "
    "sum(case y when 1 then w1 else w0 end) as f from train cross join w group by is_debtor) "
    "select is_debtor, round(1 / (1 + exp(-2 * f)), 4) as probability from means",
)
def tree_by_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One boosted tree of one level: the figure on either side of the flag."""
    rows = _part(_split(spark, sf_dir), "train")
    model = training.fit_trees(rows, FLAG, ONE_SPLIT)
    found = training.score_rows(model, rows.select("is_debtor").distinct(), "p")
    return found.select("is_debtor", F.round("p", 4).alias("probability"))


@entry(
    "train_job_levels",
    f"with {SCORED_SQL}{m.CUMULATIVE_TAIL}, r as (select {m.AREA} as a, {m.PRECISION} as p from cum "
    "where split = 'validation'), sizes as (select count(*) filter (where split = 'train') as tr, "
    "count(*) filter (where split = 'validation') as va from split) select 'baseline_logistic' as "
    "name, round(a, 4) as val_roc_auc, round(p, 4) as val_average_precision, cast(tr as varchar) as "
    "n_train, cast(va as varchar) as n_val from r cross join sizes",
)
def train_job_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The logged run: its leaderboard row and the sizes it recorded."""
    _, _, base = _trained(spark, sf_dir)
    runs = spark.read.parquet(f"{base}/runs")
    board = registry.leaderboard(runs, "val_roc_auc").join(runs.select("run_id", "params"), "run_id")
    return board.select(
        "name",
        F.round("val_roc_auc", 4).alias("val_roc_auc"),
        F.round("val_average_precision", 4).alias("val_average_precision"),
        F.col("params")["n_train"].alias("n_train"),
        F.col("params")["n_val"].alias("n_val"),
    )


#: The summary's own SQL over the closed-form scores.
SUMMARY_SQL = ORACLES["evaluation_summary"].replace(t.SCORED_SQL, SCORED_SQL)


@entry(
    "evaluation_job_levels",
    f"select split, metric, round(value, 4) as value from ({SUMMARY_SQL}) x",
)
def evaluation_job_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole way from the snapshot to the summary, every figure checked."""
    _, summary, _ = _evaluated(spark, sf_dir)
    return summary.select("split", "metric", F.round("value", 4).alias("value"))


CHAMPION_SQL = (
    f"with summary as ({SUMMARY_SQL}), one as (select max(value) filter (where metric = 'threshold') "
    "as threshold, max(value) filter (where split = 'validation' and metric = 'recall') as recall, "
    "max(value) filter (where split = 'test' and metric = 'roc_auc') as test_auc from summary) "
)


@entry(
    "champion_freeze_levels",
    CHAMPION_SQL + "select 'champion' as model_source, round(threshold, 4) as threshold, "
    "cast(0.5 as double) as recall_floor, cast(1.25 as double) as beta, recall >= 0.5 as floor_kept, "
    "round(test_auc, 4) as test_roc_auc from one",
)
def champion_freeze_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The champion as appended by the evaluation."""
    _, _, base = _evaluated(spark, sf_dir)
    return spark.read.parquet(f"{base}/champion").select(
        "model_source",
        F.round("threshold", 4).alias("threshold"),
        "recall_floor",
        "beta",
        "floor_kept",
        F.round(F.col("test_metrics")["roc_auc"], 4).alias("test_roc_auc"),
    )


@entry(
    "score_batch_levels",
    f"with summary as ({SUMMARY_SQL}), chosen_cut as (select max(value) as frozen from summary where metric = "
    f"'threshold'), {SHARES_SQL} select customer_id, round(p, 4) as churn_probability, case when "
    "p >= frozen then 'Yes' else 'No' end as predicted_churn, churn as actual_churn from split join "
    "shares using (segment) cross join chosen_cut",
)
def score_batch_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers scored from a file with the champion as it is read back."""
    split, _, base = _evaluated(spark, sf_dir)
    champion = registry.read_champion(spark, f"{base}/champion")
    source = sinks.write_table(split.select("customer_id", "segment", "churn"), f"{base}/in.parquet")
    done = score.score_batch(spark, source, f"{base}/out.parquet", LEVELS, f"{base}/champion")
    if done.metadata["threshold"] != champion["threshold"]:
        raise RuntimeError("scored at another cut than the champion's")
    return done.scores.withColumn("churn_probability", F.round("churn_probability", 4))


SEARCH = SearchSpec(
    folds=3, draws=2,
    grid={"n_estimators": [1, 2], "max_depth": [1], "min_child_samples": [1], "learning_rate": [0.1]},
)


@entry(
    "random_search_shape",
    f"with {t.SPLIT_SQL}, grid as (select * from (values (0), (1)) a(trial), (values (0), (1), (2)) "
    "b(fold)) select trial, fold, true as in_range from grid "
    "where (select count(*) from split where split = 'train') > 0",
)
def random_search_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score between 0 and 1 for every trial on every fold."""
    rows = _part(_split(spark, sf_dir), "train")
    trials = training.random_search(rows, FLAG, SEARCH).trials
    return trials.select("trial", "fold", F.col("roc_auc").between(0.0, 1.0).alias("in_range"))


#: Settings that differ in one without effect: every trial has the same closed form.
ALIKE = {
    "n_estimators": [1], "max_depth": [1], "min_child_samples": [1], "learning_rate": [0.1],
    "subsample": [0.75, 0.85, 1.0],
}
#: A tree of one level orders a held-out fold by the flag, the side with the larger share of
#: positives in the other folds first; rows on one side tie.
FOLD_AUC_SQL = (
    f"with {_TRAIN}, f_cls as (select churn, count(*) as c from train group by churn), f_laid as (select "
    "churn, c, coalesce(sum(c) over (order by churn rows between unbounded preceding and 1 preceding), "
    "0) as start from f_cls), f_folds as (select unnest(range(0, 3)) as fold), f_dealt as (select churn, "
    "fold, cast(floor((start + c - 1 - fold + 3) / 3) - floor((start - 1 - fold + 3) / 3) as bigint) "
    "as q from f_laid cross join f_folds), f_upto as (select churn, fold, sum(q) over (partition by churn "
    "order by fold) as hi, sum(q) over (partition by churn order by fold) - q as lo from f_dealt), "
    "f_ordered as (select *, row_number() over (partition by churn order by md5(concat('42:', "
    "cast(customer_id as varchar)))) as f_rn from train), folded as (select o.churn, o.y, o.is_debtor, cast(u.fold as integer) "
    "as fold from f_ordered o join f_upto u on o.churn = u.churn and f_rn > u.lo and f_rn <= u.hi), held as "
    "(select fold, cast(sum(y * is_debtor) as double) as p1, cast(sum(y * (1 - is_debtor)) as double) "
    "as p0, cast(sum((1 - y) * is_debtor) as double) as n1, cast(sum((1 - y) * (1 - is_debtor)) as "
    "double) as n0 from folded group by fold), every as (select sum(p1) as a1, sum(p0) as a0, sum(n1) "
    "as b1, sum(n0) as b0 from held), aucs as (select fold, (case when (a1 - p1) / (a1 - p1 + b1 - n1) > "
    "(a0 - p0) / (a0 - p0 + b0 - n0) then p1 * n0 else p0 * n1 end + (p1 * n1 + p0 * n0) / 2) / "
    "((p1 + p0) * (n1 + n0)) as roc_auc from held cross join every), trials as (select trial, fold, "
    "roc_auc from aucs cross join (values (0), (1), (2)) x(trial))"
)


def _resumed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, training.SearchResult]:
    """A search of one draw, then one of three over the same ledger: it fits what is missing."""
    rows = _part(_split(spark, sf_dir), "train")
    ledger = workspace.new_path(spark, "ledger")
    for draws in (1, 3):
        search = SearchSpec(folds=3, draws=draws, grid=ALIKE)
        result = training.random_search(rows, FLAG, search, ledger)
    return rows, result


@entry("search_trials", FOLD_AUC_SQL + " select trial, fold, round(roc_auc, 6) as roc_auc from trials")
def search_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fit of a resumed search, as the ledger has it."""
    _, result = _resumed(spark, sf_dir)
    return result.trials.select("trial", "fold", F.round("roc_auc", 6).alias("roc_auc"))


@entry(
    "search_leaders",
    FOLD_AUC_SQL + " select trial, round(avg(roc_auc), 6) as mean_roc_auc, round(stddev_pop(roc_auc), 6) "
    "as std_roc_auc, cast(row_number() over (order by avg(roc_auc) desc, trial) as integer) as place "
    "from trials group by trial",
)
def search_leaders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trials by their mean over the folds; equal ones by their draw."""
    _, result = _resumed(spark, sf_dir)
    table = training.trial_table(result.trials.withColumn("roc_auc", F.round("roc_auc", 9)))
    order = Window.orderBy(F.desc("mean_roc_auc"), "trial")  # a row for each trial
    return table.select(
        "trial",
        F.round("mean_roc_auc", 6).alias("mean_roc_auc"),
        F.round("std_roc_auc", 6).alias("std_roc_auc"),
        F.row_number().over(order).alias("place"),
    )


@entry("search_refit", ORACLES["tree_by_flag"])
def search_refit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best trial of the ledger, fitted on all training rows: the figure on either side."""
    rows, result = _resumed(spark, sf_dir)
    found = training.score_rows(result.model, rows.select("is_debtor").distinct(), "p")
    return found.select("is_debtor", F.round("p", 4).alias("probability"))


#: Records of customers, every eleventh of each kind broken, with a number for text, with a field too
#: many or one too few; what becomes of each.
RECORDS_SQL = (
    f"with {SHARES_SQL}, plain as (select customer_id, mod(customer_id, 11) as kind, segment, churn, "
    "concat('{\"customer_id\":', cast(customer_id as varchar)) as head, concat(',\"segment\":\"', "
    "segment, '\"') as middle, concat(',\"churn\":\"', churn, '\"') as tail, p from split join shares "
    "using (segment)), records as (select *, case kind when 0 then concat(head, middle, tail) when 1 "
    "then concat(head, ',\"segment\":5', tail, '}') when 2 then concat(head, middle, tail, "
    "',\"other\":true}') when 3 then concat(head, tail, '}') else concat(head, middle, tail, '}') end as "
    "record, case kind when 0 then 'not a JSON object' when 1 then 'segment: must be text' when 2 then "
    "'other: unknown field' when 3 then 'segment: must not be empty' end as reasons from plain) "
)


def _records(split: DataFrame) -> DataFrame:
    kind = F.col("customer_id") % 11
    head = F.concat(F.lit('{"customer_id":'), "customer_id")
    middle = F.concat(F.lit(',"segment":"'), "segment", F.lit('"'))
    tail = F.concat(F.lit(',"churn":"'), "churn", F.lit('"'))
    end = F.lit("}")
    return split.select(
        F.when(kind == 0, F.concat(head, middle, tail))
        .when(kind == 1, F.concat(head, F.lit(',"segment":5'), tail, end))
        .when(kind == 2, F.concat(head, middle, tail, F.lit(',"other":true'), end))
        .when(kind == 3, F.concat(head, tail, end))
        .otherwise(F.concat(head, middle, tail, end))
        .alias("value")
    )


def _streamed(spark: SparkSession, sf_dir: str) -> str:
    """All customers as JSON lines in several files, through the stream a file at a time."""
    split, trained, base = _trained(spark, sf_dir)
    _records(split).repartition(3, "value").write.text(f"{base}/records")
    lines = spark.readStream.option("maxFilesPerTrigger", 1).text(f"{base}/records")
    streaming.score_record_stream(
        lines, trained.model, LEVELS, 0.5, path=f"{base}/stream", checkpoint=f"{base}/state"
    ).awaitTermination()
    return f"{base}/stream"


@entry(
    "score_record_stream",
    RECORDS_SQL + "select cast(customer_id as varchar) as customer_id, round(p, 4) as churn_probability, "
    "case when p >= 0.5 then 'Yes' else 'No' end as predicted_churn, churn as actual_churn from records "
    "where reasons is null",
)
def score_record_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of the records that can be read."""
    scores = streaming.committed(spark, _streamed(spark, sf_dir), "scores").drop("batch")
    return scores.withColumn("churn_probability", F.round("churn_probability", 4))


@entry("record_rejects", RECORDS_SQL + "select record, reasons from records where reasons is not null")
def record_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records that cannot, as they came, each with its reasons."""
    rejects = streaming.committed(spark, _streamed(spark, sf_dir), "rejects")
    return rejects.select(F.col("_record").alias("record"), F.array_join("reasons", "; ").alias("reasons"))


@entry(
    "score_batch_override",
    f"with {SHARES_SQL} select customer_id, round(p, 4) as churn_probability, case when p >= 0.35 then 'Yes' "
    "else 'No' end as predicted_churn, churn as actual_churn, 'override' as threshold_source, "
    "cast(0.35 as double) as threshold, (select count(*) from split) as n_rows from split join shares "
    "using (segment)",
)
def score_batch_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers scored with a cut given to the job in place of the champion's, beside the run's
    record of it."""
    split, _, base = _evaluated(spark, sf_dir)
    source = sinks.write_table(split.select("customer_id", "segment", "churn"), f"{base}/in.parquet")
    done = score.score_batch(
        spark, source, f"{base}/out.parquet", LEVELS, f"{base}/champion",
        threshold_override=0.35, runs_path=f"{base}/scoring_runs",
    )
    run = spark.read.parquet(f"{base}/scoring_runs").select("threshold_source", "threshold", "n_rows")
    scores = done.scores.withColumn("churn_probability", F.round("churn_probability", 4))
    return scores.join(F.broadcast(run))


@entry(
    "champion_read_levels",
    CHAMPION_SQL + "select round(threshold, 4) as threshold, cast(0.5 as double) as recall_floor, recall >= 0.5 "
    "as floor_kept, round(test_auc, 4) as test_roc_auc from one",
)
def champion_read_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The champion as the registry reads it back."""
    _, _, base = _evaluated(spark, sf_dir)
    found = registry.read_champion(spark, f"{base}/champion")
    row = (
        round(found["threshold"], 4), found["recall_floor"], found["floor_kept"],
        round(found["test_metrics"]["roc_auc"], 4),
    )
    return spark.createDataFrame([row], "threshold double, recall_floor double, floor_kept boolean, test_roc_auc double")


DEBTORS = ModelingSpec("customer_id", {}, ("is_debtor",), t.SNAPSHOT_SPEC.label)


@entry(
    "champion_resolve_models",
    f"with {SHARES_SQL}, debt as (select is_debtor, (sum(y) / max(n1)) / (sum(y) / max(n1) + sum(1 - y) / "
    "max(n0)) as p from train cross join sides group by is_debtor), w as (select greatest(1, n0 / n1) as w1, "
    "greatest(1, n1 / n0) as w0 from sides), tree as (select is_debtor, 1 / (1 + exp(-2 * sum((2 * y - 1) * case "
    "y when 1 then w1 else w0 end) / sum(case y when 1 then w1 else w0 end))) as p from train cross join w group "
    "by is_debtor), test as (select * from split where split = 'test'), every as (select 'override' as source, "
    "customer_id, s.p from test join shares s using (segment) union all select 'champion', customer_id, d.p from "
    "test join debt d using (is_debtor) union all select 'fallback', customer_id, r.p from test join tree r using "
    "(is_debtor)) select source, customer_id, round(p, 4) as probability from every",
)
def champion_resolve_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three models, each the choice of one order of candidates: the scores tell which was taken."""
    split = _split(spark, sf_dir)
    rows, base = _part(split, "train"), workspace.new_path(spark, "models")
    fitted = {
        "given": training.fit_logistic(rows, LEVELS, SHARP),
        "frozen": training.fit_logistic(rows, DEBTORS, SHARP),
        "spare": training.fit_trees(rows, FLAG, ONE_SPLIT),
    }
    for name, model in fitted.items():
        model.write().overwrite().save(f"{base}/{name}")
    cases = [
        (f"{base}/given", f"{base}/frozen", f"{base}/spare"),
        (None, f"{base}/frozen", f"{base}/spare"),
        (None, f"{base}/gone", f"{base}/spare"),
    ]
    parts = []
    for given in cases:
        path, which = registry.resolve_model(spark, *given)
        scored = training.score_rows(PipelineModel.load(path), _part(split, "test"), "p")
        parts.append(scored.select(F.lit(which).alias("source"), "customer_id", F.round("p", 4).alias("probability")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
