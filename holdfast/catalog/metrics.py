"""Evaluation and drift queries on scored lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast import workspace
from holdfast.catalog import tables as t
from holdfast.catalog.entries import entry
from holdfast.operators import drift, evaluation, ranking, threshold, training
from holdfast.operators.running import measure_ranges
from holdfast.plans import drift as drift_plan
from holdfast.sources import sinks
from holdfast.spec import EvalSpec, LabelSpec, ModelingSpec

EVAL = EvalSpec()
BETA = "cast(1.25 as double)"
Y = "y"


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


AREA = (
    "sum(cast(neg as double) * (cpos - pos) + cast(neg as double) * pos / 2) / "
    "(cast(sum(pos) as double) * cast(sum(neg) as double))"
)
#: The cumulative table's SQL over any ``scored``.
CUMULATIVE_TAIL = t.CUMULATIVE_SQL[len(t.SCORED_SQL):]
PRECISION = "sum(cast(pos as double) * cpos / (cpos + cneg)) / cast(sum(pos) as double)"


@entry(
    "roc_auc",
    f"with {t.CUMULATIVE_SQL} select split, round({AREA}, 6) as roc_auc from cum group by split",
)
def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    cumulative = ranking.cumulative_counts(t.scored(spark, sf_dir), "score", Y, ["split"])
    return _rounded(
        ranking.ranking_metrics(cumulative, ["split"]).select("split", "roc_auc"), "roc_auc"
    )


@entry(
    "average_precision",
    f"with {t.CUMULATIVE_SQL} select split, round({PRECISION}, 6) as average_precision "
    "from cum group by split",
)
def average_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    cumulative = ranking.cumulative_counts(t.scored(spark, sf_dir), "score", Y, ["split"])
    return _rounded(
        ranking.ranking_metrics(cumulative, ["split"]).select("split", "average_precision"),
        "average_precision",
    )


@entry(
    "ranking_by_ranges",
    f"with {t.CUMULATIVE_SQL} select split, round({AREA}, 6) as roc_auc, "
    f"round({PRECISION}, 6) as average_precision from cum group by split",
)
def ranking_by_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same metrics with running totals over many value ranges, as large tables take them."""
    rows = t.scored(spark, sf_dir)
    ranges = measure_ranges(rows, "score", ["split"], one_range_rows=1_000)
    cumulative = ranking.cumulative_counts(rows, "score", Y, ["split"], ranges)
    return _rounded(
        ranking.ranking_metrics(cumulative, ["split"]), "roc_auc", "average_precision"
    )


@entry(
    "roc_curve",
    f"with {t.CUMULATIVE_SQL} select split, cast(cneg as double) / cast(aneg as double) as fpr, "
    "cast(cpos as double) / cast(apos as double) as tpr, score as threshold from cum "
    "union all select distinct split, cast(0 as double), cast(0 as double), "
    "cast('inf' as double) from cum",
)
def roc_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    cumulative = ranking.cumulative_counts(t.scored(spark, sf_dir), "score", Y, ["split"])
    return ranking.roc_curve(cumulative, ["split"])


@entry(
    "pr_curve",
    f"with {t.CUMULATIVE_SQL} select split, cast(cpos as double) / cast(apos as double) as recall, "
    "cast(cpos as double) / cast(cpos + cneg as double) as precision, score as threshold from cum "
    "union all select distinct split, cast(0 as double), cast(1 as double), cast(null as double) "
    "from cum",
)
def pr_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    cumulative = ranking.cumulative_counts(t.scored(spark, sf_dir), "score", Y, ["split"])
    return ranking.pr_curve(cumulative, ["split"])


def _counts_sql(cut: str) -> str:
    return (
        f"count(*) filter (where score >= {cut} and y = 1) as n_tp, "
        f"count(*) filter (where score >= {cut} and y = 0) as n_fp, "
        f"count(*) filter (where score < {cut} and y = 1) as n_fn, "
        f"count(*) filter (where score < {cut} and y = 0) as n_tn"
    )


def _ratio(top: str, bottom: str) -> str:
    return f"coalesce(cast({top} as double) / nullif(cast({bottom} as double), 0), 0)"


def _f_sql(beta: str) -> str:
    w = f"({beta} * {beta})"
    return _ratio(f"(1 + {w}) * n_tp", f"(1 + {w}) * n_tp + {w} * n_fn + n_fp")


OPERATING = {
    "recall": _ratio("n_tp", "n_tp + n_fn"),
    "precision": _ratio("n_tp", "n_tp + n_fp"),
    "f1": _f_sql("cast(1 as double)"),
    "fbeta": _f_sql(BETA),
}


def _operating_sql(digits: int = 6) -> str:
    return ", ".join(f"round({e}, {digits}) as {n}" for n, e in OPERATING.items())


@entry(
    "confusion_matrix",
    f"with {t.SCORED_SQL} select split, {_counts_sql('cast(0.47 as double)')} "
    "from scored group by split",
)
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threshold.confusion_matrix(t.scored(spark, sf_dir), "score", Y, 0.47, ["split"])


FAULTY_SQL = (
    t.SCORED_SQL
    + ", faulty as (select split, l_linenumber, case when l_linenumber = 3 then null when "
    "l_linenumber = 5 then cast('nan' as double) else score end as score from scored)"
)


@entry(
    "score_faults",
    f"with {FAULTY_SQL} select split, count(*) as n_rows, count(*) filter (where score is null) "
    "as n_null, count(*) filter (where isnan(score)) as n_nan from faulty group by split",
)
def score_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows the metrics would refuse, on scores with nulls and NaN planted."""
    line = F.col("l_linenumber")
    planted = F.when(line == 3, F.lit(None).cast("double")).when(line == 5, F.lit(float("nan")))
    rows = t.scored(spark, sf_dir).withColumn(
        "score", planted.otherwise(F.when(~line.isin(3, 5), F.col("score")))
    )
    return threshold.score_faults(rows, "score", ["split"])


@entry(
    "auc_by_order",
    "with graded as (select l_orderkey, l_extendedprice / cast(105000 as double) as score, case "
    "when l_returnflag = 'R' then 1 else 0 end as y from lineitem), per_score as (select "
    "l_orderkey, score, sum(y) as pos, sum(1 - y) as neg from graded group by 1, 2), cum as "
    "(select *, sum(pos) over (partition by l_orderkey order by score desc) as cpos from per_score) "
    "select l_orderkey, round(case when sum(pos) * sum(neg) > 0 then sum(cast(neg as double) * "
    "(cpos - pos) + cast(neg as double) * pos / 2) / (cast(sum(pos) as double) * "
    "cast(sum(neg) as double)) end, 6) as roc_auc from cum group by l_orderkey",
)
def auc_by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ROC-AUC within every order: as many groups as there are orders."""
    lines = t.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        (F.col("l_extendedprice") / 105000.0).alias("score"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("y"),
    )
    cumulative = ranking.cumulative_counts(lines, "score", Y, ["l_orderkey"])
    found = ranking.ranking_metrics(cumulative, ["l_orderkey"]).select("l_orderkey", "roc_auc")
    return _rounded(found, "roc_auc")


@entry(
    "threshold_metrics",
    f"with {t.SCORED_SQL}, c as (select split, {_counts_sql('cast(0.47 as double)')} from scored "
    f"group by split) select split, n_tp, n_fp, n_fn, n_tn, {_operating_sql()} from c",
)
def threshold_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = threshold.threshold_metrics(
        t.scored(spark, sf_dir), "score", Y, 0.47, EVAL.beta, ["split"]
    )
    return _rounded(found, *OPERATING)


@entry(
    "val_metrics",
    f"with {t.CUMULATIVE_SQL}, c as (select {_counts_sql('cast(0.5 as double)')} from scored "
    f"where split = 'validation'), r as (select {AREA} as a, {PRECISION} as p from cum "
    "where split = 'validation') select round(a, 6) as roc_auc, round(p, 6) as average_precision, "
    f"round({OPERATING['f1']}, 6) as f1, round({OPERATING['recall']}, 6) as recall "
    "from r cross join c",
)
def val_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    validation = t.scored(spark, sf_dir).where(F.col("split") == "validation")
    found = evaluation.fixed_cut_metrics(validation, "score", Y, 0.5)
    return _rounded(found, *found.columns)


# The grid as the library states it: 0.01 + i * step, and 0.99 at the end.
SWEEP_SQL = (
    t.SCORED_SQL
    + ", grid as (select case when i = 98 then cast(0.99 as double) else cast(0.01 as double) + "
    "i * ((cast(0.99 as double) - cast(0.01 as double)) / 98) end as threshold "
    "from range(0, 99) r(i)), per_cut as (select split, threshold, "
    + _counts_sql("threshold")
    + " from scored cross join grid group by split, threshold), sweep as (select split, threshold, "
    "n_tp, n_fp, n_fn, n_tn, "
    + ", ".join(f"{e} as {n}" for n, e in OPERATING.items())
    + " from per_cut)"
)


@entry(
    "threshold_sweep",
    f"with {SWEEP_SQL} select split, round(threshold, 6) as threshold, n_tp, n_fp, n_fn, n_tn, "
    + ", ".join(f"round({n}, 6) as {n}" for n in OPERATING)
    + " from sweep",
)
def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = threshold.threshold_sweep(t.scored(spark, sf_dir), "score", Y, EVAL, ["split"])
    return _rounded(found, "threshold", *OPERATING)


def _choice_sql(floor: str) -> str:
    return (
        ", choice as (select * from (select *, row_number() over (partition by split order by "
        f"(recall >= {floor}) desc, case when recall >= {floor} then fbeta else recall end desc, "
        f"case when recall >= {floor} then recall else fbeta end desc, threshold) as rn, "
        f"count(*) filter (where recall >= {floor}) over (partition by split) as n_feasible "
        "from sweep) x where rn = 1)"
    )


HALF = "cast(0.5 as double)"


@entry(
    "select_threshold",
    f"with {SWEEP_SQL}{_choice_sql(HALF)} select split, round(threshold, 6) as threshold, "
    + ", ".join(f"round({n}, 6) as {n}" for n in OPERATING)
    + f", {HALF} as recall_floor, {BETA} as beta, n_feasible, n_feasible > 0 as floor_kept, "
    "case when n_feasible = 0 then 'no cut reaches recall 0.5; the one with most recall was taken' "
    "end as warning from choice",
)
def select_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    sweep = threshold.threshold_sweep(t.scored(spark, sf_dir), "score", Y, EVAL, ["split"])
    chosen = threshold.select_threshold(sweep, EVAL, by=["split"])
    return _rounded(chosen, "threshold", *OPERATING)


@entry(
    "select_threshold_relaxed",
    f"with {SWEEP_SQL}{_choice_sql('cast(2 as double)')} select split, "
    "round(threshold, 6) as threshold, round(recall, 6) as recall, n_feasible, warning is not null "
    "as warned from (select *, 'w' as warning from choice) x",
)
def select_threshold_relaxed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A floor that no cut reaches: most recall wins, and a warning says so."""
    sweep = threshold.threshold_sweep(t.scored(spark, sf_dir), "score", Y, EVAL, ["split"])
    chosen = threshold.select_threshold(sweep, EvalSpec(recall_floor=2.0), by=["split"])
    return chosen.select(
        "split", F.round("threshold", 6).alias("threshold"), F.round("recall", 6).alias("recall"),
        "n_feasible", F.col("warning").isNotNull().alias("warned"),
    )


@entry(
    "evaluation_summary",
    f"with {SWEEP_SQL}{_choice_sql(HALF)}"
    + t.CUMULATIVE_SQL[len(t.SCORED_SQL):]
    + ", frozen as (select threshold as cut from choice where split = 'validation'), "
    f"at_cut as (select split, {_counts_sql('cut')} from scored cross join frozen group by split), "
    f"ranked as (select split, {AREA} as roc_auc, {PRECISION} as average_precision from cum "
    "group by split), facts as (select split, 'roc_auc' as metric, roc_auc as value from ranked "
    "union all select split, 'average_precision', average_precision from ranked "
    + " ".join(f"union all select split, '{n}', {e} from at_cut" for n, e in OPERATING.items())
    + " union all select 'validation', 'threshold', cut from frozen) "
    "select split, metric, round(value, 6) as value from facts",
)
def evaluation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cut chosen on validation, metrics of both splits at it."""
    return _rounded(evaluation.evaluation_summary(t.scored(spark, sf_dir), "score", Y), "value")


LEADERBOARD_SQL = (
    "with long as ("
    + " union all ".join(
        f"select {i} as trial, l_linenumber as fold, {f} as score, "
        "case when l_returnflag = 'R' then 1 else 0 end as y from lineitem"
        for i, f in enumerate(
            (
                "l_quantity / cast(50 as double)",
                "l_extendedprice / cast(105000 as double)",
                "l_discount * cast(10 as double)",
            )
        )
    )
    + "), per_score as (select trial, fold, score, sum(y) as pos, sum(1 - y) as neg from long "
    "group by 1, 2, 3), cum as (select *, sum(pos) over (partition by trial, fold order by score "
    "desc) as cpos, sum(neg) over (partition by trial, fold order by score desc) as cneg "
    f"from per_score), aucs as (select trial, fold, {AREA} as roc_auc from cum group by 1, 2), "
    "board as (select trial, avg(roc_auc) as mean_roc_auc, stddev_pop(roc_auc) as std_roc_auc "
    "from aucs group by trial) "
)


def _trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ROC-AUC of three scoring formulas on every line number, taken as folds."""
    lines = t.table(spark, sf_dir, "lineitem")
    candidates = F.array(
        F.col("l_quantity") / 50.0, F.col("l_extendedprice") / 105000.0, F.col("l_discount") * 10.0
    )
    long = lines.select(
        F.col("l_linenumber").alias("fold"),
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
        F.posexplode(candidates).alias("trial", "score"),
    )
    by = ["trial", "fold"]
    cumulative = ranking.cumulative_counts(long, "score", Y, by)
    return ranking.ranking_metrics(cumulative, by).select("trial", "fold", "roc_auc")


@entry(
    "leaderboard",
    LEADERBOARD_SQL + "select trial, round(mean_roc_auc, 6) as mean_roc_auc, "
    "round(std_roc_auc, 6) as std_roc_auc from board",
)
def leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(
        training.trial_table(_trials(spark, sf_dir)), "mean_roc_auc", "std_roc_auc"
    )


@entry(
    "best_trial",
    LEADERBOARD_SQL + "select trial, round(mean_roc_auc, 6) as mean_roc_auc from board "
    "order by board.mean_roc_auc desc, trial limit 1",
)
def best_trial(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = training.best_trial(_trials(spark, sf_dir)).select("trial", "mean_roc_auc")
    return _rounded(best, "mean_roc_auc")


# --- drift -----------------------------------------------------------------------------------

KS_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "moved"]
KS_SQL = (
    t.DRIFT_SQL
    + ", ks_long as ("
    + " union all ".join(f"select is_cur, '{c}' as col, {c} as v from pair" for c in KS_COLUMNS)
    + "), ks_counts as (select col, v, sum(1 - is_cur) as r, sum(is_cur) as c from ks_long "
    "group by col, v), ks_cdf as (select col, r, c, sum(r) over w as cr, sum(c) over w as cc, "
    "sum(r) over (partition by col) as ar, sum(c) over (partition by col) as ac from ks_counts "
    "window w as (partition by col order by v)), ks as (select col, cast(sum(r) as bigint) as "
    "n_ref, cast(sum(c) as bigint) as n_cur, max(abs(cast(cr as double) / ar - "
    "cast(cc as double) / ac)) as d from ks_cdf group by col)"
)


@entry(
    "drift_ks",
    f"with {KS_SQL} select col as \"column\", n_ref, n_cur, round(d, 9) as statistic from ks",
)
def drift_ks(spark: SparkSession, sf_dir: str) -> DataFrame:
    reference, current = t.drift_pair(spark, sf_dir)
    return _rounded(
        drift.ks_statistics(reference, current, KS_COLUMNS), "statistic", digits=9
    )


CHI_COLUMNS = ["l_returnflag", "l_linestatus", "holey"]
CHI_SQL = (
    ", chi_long as ("
    + " union all ".join(
        f"select is_cur, '{c}' as col, coalesce({c}, '__NA__') as v from pair"
        for c in [*CHI_COLUMNS, "constant"]
    )
    + "), chi_counts as (select col, v, cast(sum(1 - is_cur) as double) as r, cast(sum(is_cur) as "
    "double) as c from chi_long group by col, v), chi_tot as (select *, count(*) over w as k, "
    "sum(r) over w as ar, sum(c) over w as ac from chi_counts window w as (partition by col)), "
    "chi_exp as (select *, (r + c) / (ar + ac) * ar as er, (r + c) / (ar + ac) * ac as ec "
    "from chi_tot), chi_gap as (select *, abs(r - er) - case when k = 2 then least(0.5, "
    "abs(r - er)) else 0 end as gr, abs(c - ec) - case when k = 2 then least(0.5, abs(c - ec)) "
    "else 0 end as gc from chi_exp), chi as (select col, max(k) as k, max(ar) as n_ref, max(ac) "
    "as n_cur, case when max(k) >= 2 then sum(gr * gr / er + gc * gc / ec) end as x "
    "from chi_gap group by col)"
)


@entry(
    "drift_chi2",
    f"with {t.DRIFT_SQL}{CHI_SQL} select col as \"column\", k as n_values, cast(n_ref as bigint) "
    "as n_ref, cast(n_cur as bigint) as n_cur, k - 1 as dof, round(x, 6) as statistic from chi",
)
def drift_chi2(spark: SparkSession, sf_dir: str) -> DataFrame:
    reference, current = t.drift_pair(spark, sf_dir)
    return _rounded(
        drift.chi2_statistics(reference, current, [*CHI_COLUMNS, "constant"]), "statistic"
    )


# p < 0.05 stated as the statistic passing its 5 % point: 1.3581 * sqrt((n + m) / (n * m)) for
# the distributions, 3.841459 and 5.991465 for one and two degrees of freedom.
REPORT_SQL = (
    f"with {KS_SQL}{CHI_SQL} "
    "select col as \"column\", 'numeric' as kind, round(d, 6) as statistic, "
    "d > 1.3581 * sqrt((n_ref + n_cur) / (cast(n_ref as double) * n_cur)) as drift_flag, "
    "cast(null as varchar) as note from ks union all "
    "select col, 'categorical', round(x, 6), coalesce(x > case k when 2 then 3.841459 else "
    "5.991465 end, false), case when k < 2 then 'single category after NA fill' end from chi "
    "union all select 'rarely', 'numeric', null, false, 'too few non-null values' union all "
    "select 'absent_number', 'numeric', null, false, 'column missing in one frame' union all "
    "select 'absent_text', 'categorical', null, false, 'column missing in one frame'"
)


def _report_columns(report: DataFrame) -> DataFrame:
    return _rounded(report.select("column", "kind", "statistic", "drift_flag", "note"), "statistic")


@entry("drift_report", REPORT_SQL)
def drift_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of the pair, with the planted shift flagged and notes where no test applies."""
    reference, current = t.drift_pair(spark, sf_dir)
    return _report_columns(drift.drift_report(reference, current, t.DRIFT_SPEC))


EMPTY_SIDE_SQL = (
    f"with {t.DRIFT_SQL}, kinds as (select count(distinct l_returnflag) as a, "
    "count(distinct l_linestatus) as b, count(distinct coalesce(holey, '__NA__')) as c from pair "
    "where is_cur = 0), note as (select 'empty split for contingency' as e, "
    "'single category after NA fill' as s) "
    + " union all ".join(
        f"select '{c}' as \"column\", 'numeric' as kind, cast(null as double) as statistic, false as "
        "drift_flag, 'too few non-null values' as note"
        for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "moved", "rarely")
    )
    + " union all "
    + " union all ".join(
        f"select '{c}', 'categorical', null, false, case when {k} < 2 then s else e end from kinds "
        "cross join note"
        for c, k in (("l_returnflag", "a"), ("l_linestatus", "b"), ("holey", "c"), ("constant", "1"))
    )
    + " union all select 'absent_number', 'numeric', null, false, 'column missing in one frame' "
    "union all select 'absent_text', 'categorical', null, false, 'column missing in one frame'"
)


@entry("drift_report_empty", EMPTY_SIDE_SQL)
def drift_report_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The earlier lines against a side without rows: every column is in the report."""
    reference, current = t.drift_pair(spark, sf_dir)
    nothing = current.where(F.col("l_quantity") < 0)
    return _report_columns(drift.drift_report(reference, nothing, t.DRIFT_SPEC))


@entry("drift_p_values")
def drift_p_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    reference, current = t.drift_pair(spark, sf_dir)
    return drift.drift_report(reference, current, t.DRIFT_SPEC)


@entry("drift_job", REPORT_SQL)
def drift_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tables written, compared from their paths, the report written and read back."""
    base = workspace.new_path(spark, "drift")
    reference, current = t.drift_pair(spark, sf_dir)
    a = sinks.write_table(reference, f"{base}/reference.parquet")
    b = sinks.write_table(current, f"{base}/current.parquet")
    return _report_columns(drift_plan.drift_job(spark, a, b, t.DRIFT_SPEC, base))


@entry(
    "drift_flagged",
    f"select count(*) filter (where drift_flag) as n_columns_flagged from ({REPORT_SQL}) x",
)
def drift_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    reference, current = t.drift_pair(spark, sf_dir)
    return drift.flagged_columns(drift.drift_report(reference, current, t.DRIFT_SPEC))


@entry(
    "drift_missing_rates",
    f"with {t.DRIFT_SQL} "
    + " union all ".join(
        f"select '{c}' as \"column\", round(avg(case when is_cur = 0 then case when {c} is null "
        f"then cast(1 as double) else 0 end end), 6) as ref_missing, round(avg(case when is_cur = 1 "
        f"then case when {c} is null then cast(1 as double) else 0 end end), 6) as cur_missing "
        "from pair"
        for c in ("holey", "rarely")
    ),
)
def drift_missing_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    reference, current = t.drift_pair(spark, sf_dir)
    found = drift.missing_rates(reference, current, ["holey", "rarely"])
    return _rounded(found, "ref_missing", "cur_missing")


# --- p-values in closed form -------------------------------------------------------------------

HALVES = ModelingSpec("o_orderkey", {}, ("o_orderstatus", "o_orderpriority"), LabelSpec("_label"))
#: With an even number of degrees of freedom 2k, the chance of x or more is e^(-x/2) times the first
#: k terms of the series of e^(x/2).
CHI_P_SQL = (
    "with long as (select mod(o_orderkey, 2) as half, 'o_orderstatus' as col, o_orderstatus as v from orders "
    "union all select mod(o_orderkey, 2), 'o_orderpriority', o_orderpriority from orders), counts as "
    "(select col, v, cast(sum(1 - half) as double) as r, cast(sum(half) as double) as c from long group by "
    "col, v), tot as (select *, count(*) over w as k, sum(r) over w as ar, sum(c) over w as ac from counts "
    "window w as (partition by col)), gaps as (select *, (r + c) * ar / (ar + ac) as er, (r + c) * ac / "
    "(ar + ac) as ec from tot), chi as (select col, max(k) - 1 as dof, sum((r - er) * (r - er) / er + "
    "(c - ec) * (c - ec) / ec) as x from gaps group by col) select col as \"column\", round(x, 6) as statistic, "
    "round((select sum(exp(-x / 2) * pow(x / 2, i) / gamma(i + 1)) from range(0, dof // 2) s(i)), 6) as p_value "
    "from chi where dof % 2 = 0"
)


@entry("chi2_p_values", CHI_P_SQL)
def chi2_p_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p-values of orders with even keys against those with odd keys, where their number is closed."""
    orders = t.table(spark, sf_dir, "orders")
    even, odd = (orders.where(F.col("o_orderkey") % 2 == k) for k in (0, 1))
    report = drift.drift_report(even, odd, HALVES)
    dof = drift.chi2_statistics(even, odd, list(HALVES.categorical)).select("column", "dof")
    closed = report.join(dof, "column").where("dof % 2 = 0")
    return _rounded(closed.select("column", "statistic", "p_value"), "statistic", "p_value")


ACCOUNTS = ModelingSpec("c_custkey", {"c_acctbal": "number"}, (), LabelSpec("_label"))
#: For two samples of n rows whose statistic is h / n, the paths that leave the band are counted by
#: reflection: 2 sum over i of (-1)^(i+1) C(2n, n + ih) / C(2n, n).
KS_P_SQL = (
    "with half as (select mod(c_custkey, 2) as half, c_acctbal as v from customer), counts as (select v, sum(1 - "
    "half) as r, sum(half) as c from half group by v), cdf as (select sum(r) over w as cr, sum(c) over w as cc "
    "from counts window w as (order by v)), facts as (select cast(max(abs(cr - cc)) as bigint) as h, "
    "cast(max(cr) as bigint) as n from cdf), terms as (select i, 2 * (case when i % 2 = 1 then 1 else -1 end) * "
    "exp(2 * lgamma(n + 1) - lgamma(n + i * h + 1) - lgamma(n - i * h + 1)) as term from facts, "
    "range(1, 1000) s(i) where i * h <= n) select 'c_acctbal' as \"column\", round(cast(h as double) / n, 6) as "
    "statistic, round(least(1, (select sum(term) from terms)), 6) as p_value from facts"
)


@entry("ks_p_values", KS_P_SQL)
def ks_p_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The p-value of balances of customers with even keys against as many with odd keys."""
    customers = t.table(spark, sf_dir, "customer")
    even, odd = (customers.where(F.col("c_custkey") % 2 == k) for k in (0, 1))
    report = drift.drift_report(even, odd, ACCOUNTS).select("column", "statistic", "p_value")
    return _rounded(report, "statistic", "p_value")
