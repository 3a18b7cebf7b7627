"""Metrics at a cut, the sweep over a grid of cuts, and the choice of one under a recall floor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.functions.repair import as_column, required_score
from holdfast.spec import EvalSpec, LabelSpec


def confusion_counts(score: Column, y: str | Column, threshold: float | Column) -> dict[str, Column]:
    """Aggregates counting true/false positives and negatives at a cut."""
    cut = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    flagged, positive = required_score(score) >= cut, as_column(y) == 1
    return {
        "n_tp": F.count_if(flagged & positive),
        "n_fp": F.count_if(flagged & ~positive),
        "n_fn": F.count_if(~flagged & positive),
        "n_tn": F.count_if(~flagged & ~positive),
    }


def score_faults(scored: DataFrame, score: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, n_rows, n_null, n_nan): rows whose score the metrics would refuse."""
    value = F.col(score).cast("double")
    return scored.groupBy(*by).agg(
        F.count("*").alias("n_rows"),
        F.count_if(value.isNull()).alias("n_null"),
        F.count_if(F.isnan(value)).alias("n_nan"),
    )


def confusion_matrix(
    scored: DataFrame,
    score: str,
    y: str | Column,
    threshold: float | Column,
    by: Sequence[str] = (),
) -> DataFrame:
    counts = confusion_counts(F.col(score), y, threshold)
    return scored.groupBy(*by).agg(*[c.alias(n) for n, c in counts.items()])


def operating_metrics(beta: float = 1.0) -> dict[str, Column]:
    """Recall, precision, F1 and F-beta over columns n_tp, n_fp, n_fn; 0 where undefined."""
    tp, fp, fn = (F.col(c).cast("double") for c in ("n_tp", "n_fp", "n_fn"))

    def ratio(top: Column, bottom: Column) -> Column:
        return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))

    def f_score(b: float) -> Column:
        w = b * b
        return ratio((1.0 + w) * tp, (1.0 + w) * tp + w * fn + fp)

    return {
        "recall": ratio(tp, tp + fn),
        "precision": ratio(tp, tp + fp),
        "f1": f_score(1.0),
        "fbeta": f_score(beta),
    }


def threshold_metrics(
    scored: DataFrame,
    score: str,
    y: str | Column,
    threshold: float | Column,
    beta: float = 1.0,
    by: Sequence[str] = (),
) -> DataFrame:
    """Confusion counts and the four operating metrics at one cut."""
    counts = confusion_matrix(scored, score, y, threshold, by)
    return counts.select("*", *[m.alias(n) for n, m in operating_metrics(beta).items()])


def threshold_sweep(
    scored: DataFrame, score: str, y: str | Column, spec: EvalSpec = EvalSpec(), by: Sequence[str] = ()
) -> DataFrame:
    """The four metrics at every grid cut, in one pass over the scores.

    A score is placed among the cuts once; the counts per place, added up from above, are the
    confusion counts of every cut.
    """
    grid = spec.thresholds()
    by = list(by)
    placed = Bucketizer(
        splits=[float("-inf"), *grid, float("inf")], inputCol="_score", outputCol="_reached"
    ).transform(
        scored.select(*by, required_score(F.col(score)).alias("_score"), as_column(y).alias("_y"))
    )
    # _reached = number of cuts at or below the score
    per_place = placed.groupBy(*by, F.col("_reached").cast("int").alias("reached")).agg(
        F.sum("_y").alias("pos"), F.sum(1 - F.col("_y")).alias("neg")
    )
    # One row per group from here on: at most grid + 1 places each.
    places = F.collect_list(F.struct("reached", "pos", "neg"))
    per_group = per_place.groupBy(*by).agg(
        places.alias("places"), F.sum("pos").alias("all_pos"), F.sum("neg").alias("all_neg")
    )
    cuts = F.posexplode(F.array(*[F.lit(t) for t in grid])).alias("i", "threshold")
    swept = per_group.select(*by, "places", "all_pos", "all_neg", cuts)

    def from_above(field: str) -> Column:
        return F.aggregate(
            "places",
            F.lit(0).cast("long"),
            lambda acc, p: acc + F.when(p["reached"] > F.col("i"), p[field]).otherwise(0),
        )

    counted = swept.select(
        *by, "i", "threshold", "all_pos", "all_neg",
        from_above("pos").alias("n_tp"), from_above("neg").alias("n_fp"),
    ).select(
        *by, "i", "threshold", "n_tp", "n_fp",
        (F.col("all_pos") - F.col("n_tp")).alias("n_fn"),
        (F.col("all_neg") - F.col("n_fp")).alias("n_tn"),
    )
    return counted.select(
        *by, "threshold", "n_tp", "n_fp", "n_fn", "n_tn",
        *[m.alias(n) for n, m in operating_metrics(spec.beta).items()],
    )


def select_threshold(
    sweep: DataFrame, spec: EvalSpec = EvalSpec(), label: LabelSpec | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """One row: the cut with the best F-beta among those that keep the recall floor.

    Ties go to the higher recall, then to the lowest cut. When no cut keeps the floor, the one
    with most recall (then F-beta, then lowest) is taken and a warning says so.
    """
    floor = spec.floor(label)
    feasible = F.col("recall") >= floor
    order = [
        feasible.desc(),
        F.when(feasible, F.col("fbeta")).otherwise(F.col("recall")).desc(),
        F.when(feasible, F.col("recall")).otherwise(F.col("fbeta")).desc(),
        F.col("threshold").asc(),
    ]
    # The sweep has one row per grid cut, so these windows are short.
    ranked = sweep.select(
        "*",
        F.row_number().over(Window.partitionBy(*by).orderBy(*order)).alias("_rank"),
        F.sum(feasible.cast("long")).over(Window.partitionBy(*by)).alias("n_feasible"),
    )
    warning = f"no cut reaches recall {floor}; the one with most recall was taken"
    return ranked.where(F.col("_rank") == 1).select(
        *by, "threshold", "recall", "precision", "f1", "fbeta",
        F.lit(float(floor)).alias("recall_floor"),
        F.lit(float(spec.beta)).alias("beta"),
        "n_feasible",
        (F.col("n_feasible") > 0).alias("floor_kept"),
        F.when(F.col("n_feasible") == 0, F.lit(warning)).alias("warning"),
    )
