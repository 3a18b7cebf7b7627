import random

import pytest
from pyspark.sql import functions as F

from holdfast.operators import evaluation, ranking, running, threshold
from holdfast.operators.running import ValueRanges, measure_ranges, running_totals
from holdfast.spec import EvalSpec

Y = [0, 0, 1, 1, 1, 0, 1]
P = [0.1, 0.2, 0.9, 0.85, 0.8, 0.3, 0.75]


@pytest.fixture(scope="module")
def small(spark):
    return spark.createDataFrame(list(zip(Y, P)), "y int, score double")


@pytest.fixture(scope="module")
def many(spark):
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        y = int(rng.random() < 0.3)
        # a third of the rows share one score
        score = 0.4 if i % 3 == 0 else round(min(0.999, max(0.0, rng.gauss(0.35 + 0.2 * y, 0.2))), 3)
        rows.append((y, score, "validation" if i % 2 else "test"))
    return spark.createDataFrame(rows, "y int, score double, split string").cache()


def pairs(df):
    return [(r["y"], r["score"]) for r in df.select("y", "score").collect()]


def auc_by_hand(rows):
    pos = [s for y, s in rows if y]
    neg = [s for y, s in rows if not y]
    return sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))


def ap_by_hand(rows):
    total, found = sum(y for y, _ in rows), 0.0
    for cut in sorted({s for _, s in rows}, reverse=True):
        here = sum(y for y, s in rows if s == cut)
        kept = [y for y, s in rows if s >= cut]
        found += here / total * sum(kept) / len(kept)
    return found


def counts_by_hand(rows, cut):
    tp = sum(y for y, s in rows if s >= cut)
    fp = sum(1 - y for y, s in rows if s >= cut)
    positives = sum(y for y, _ in rows)
    return tp, fp, positives - tp, len(rows) - positives - fp


@pytest.mark.parametrize("limit", [1_000_000, 50])
def test_ranking_metrics(many, limit):
    ranges = measure_ranges(many, "score", ["split"], one_range_rows=limit)
    assert bool(ranges.edges) == (limit == 50)
    cumulative = ranking.cumulative_counts(many, "score", "y", ["split"], ranges)
    for r in ranking.ranking_metrics(cumulative, ["split"]).collect():
        rows = pairs(many.where(F.col("split") == r["split"]))
        assert r["roc_auc"] == pytest.approx(auc_by_hand(rows), abs=1e-12)
        assert r["average_precision"] == pytest.approx(ap_by_hand(rows), abs=1e-12)


@pytest.mark.parametrize("broadcast_rows", [0, 1000])
@pytest.mark.parametrize("descending", [True, False])
def test_running_totals_over_ranges(spark, descending, broadcast_rows, monkeypatch):
    monkeypatch.setattr(running, "BROADCAST_ROWS", broadcast_rows)
    rng = random.Random(5)
    counts = [(g, v / 7, rng.randrange(10)) for g in "ab" for v in rng.sample(range(500), 200)]
    df = spark.createDataFrame(counts, "g string, v double, n long")
    ranges = ValueRanges((10.0, 11.0, 40.0, 1000.0), 2)
    got = running_totals(df, "v", ["n"], ranges, ["g"], descending).collect()
    assert len(got) == 400
    for r in got:
        same = [(v, n) for g, v, n in counts if g == r["g"]]
        upto = [n for v, n in same if (v >= r["v"] if descending else v <= r["v"])]
        assert r["cum_n"] == sum(upto) and r["all_n"] == sum(n for _, n in same)


@pytest.mark.parametrize("limit", [1_000_000, 40])
def test_many_groups(spark, limit):
    """More groups than any list on the driver should hold, a few of them large."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") < 24_000, F.col("id") / 2).otherwise(F.col("id") % 3 - 9).cast("long").alias("g"),
        (F.col("id") % 101 / 101.0).alias("score"),
        (F.col("id") % 2).cast("int").alias("y"),
    )
    ranges = measure_ranges(rows, "score", ["g"], one_range_rows=limit)
    assert ranges.groups == 12_003 and bool(ranges.edges) == (limit == 40)
    cumulative = ranking.cumulative_counts(rows, "score", "y", ["g"], ranges)
    found = {r["g"]: r["roc_auc"] for r in ranking.ranking_metrics(cumulative, ["g"]).collect()}
    assert len(found) == 12_003
    for g in (-9, -8, 0, 7):
        assert found[g] == pytest.approx(auc_by_hand(pairs(rows.where(F.col("g") == g))), abs=1e-12)


@pytest.mark.parametrize("fault", [None, float("nan")])
@pytest.mark.parametrize("limit", [1_000_000, 5])
def test_missing_scores_are_refused_at_every_size(spark, fault, limit):
    rows = [(0.1 * i, i % 2) for i in range(12)] + [(fault, 1)]
    df = spark.createDataFrame(rows, "score double, y int")
    ranges = measure_ranges(df, "score", one_range_rows=limit)
    calls = [
        lambda: ranking.cumulative_counts(df, "score", "y", ranges=ranges),
        lambda: threshold.confusion_matrix(df, "score", "y", 0.5),
        lambda: threshold.threshold_metrics(df, "score", "y", 0.5),
        lambda: threshold.threshold_sweep(df, "score", "y"),
    ]
    for call in calls:
        with pytest.raises(Exception, match="null or NaN"):
            call().collect()
    faults = threshold.score_faults(df, "score").first()
    assert tuple(faults) == (13, int(fault is None), int(fault is not None))
    only = spark.createDataFrame([(None, 1)] * 9, "score double, y int")
    assert measure_ranges(only, "score", one_range_rows=limit).edges == ()


def test_one_class_only(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.7)], "y int, score double")
    row = ranking.ranking_metrics(ranking.cumulative_counts(df, "score", "y")).first()
    assert row["roc_auc"] is None and row["average_precision"] == 1.0


def test_curves_end_at_one(many):
    cumulative = ranking.cumulative_counts(many, "score", "y")
    roc = ranking.roc_curve(cumulative).orderBy("threshold").collect()
    assert (roc[0]["fpr"], roc[0]["tpr"]) == (1.0, 1.0)
    assert tuple(roc[-1]) == (0.0, 0.0, float("inf"))
    curve = ranking.pr_curve(cumulative)
    assert [tuple(r) for r in curve.where("threshold is null").collect()] == [(0.0, 1.0, None)]
    pr = curve.where("threshold is not null").orderBy("threshold").first()
    rows = pairs(many)
    assert (pr["recall"], pr["precision"]) == (1.0, sum(y for y, _ in rows) / len(rows))


def test_published_confusion_gives_published_metrics(spark):
    sizes = {(1, 0.9): 236, (0, 0.9): 219, (1, 0.1): 44, (0, 0.1): 558}
    rows = [key for key, n in sizes.items() for _ in range(n)]
    df = spark.createDataFrame(rows, "y int, score double")
    r = threshold.threshold_metrics(df, "score", "y", 0.47000000000000003, 1.25).first()
    assert (r["n_tp"], r["n_fp"], r["n_fn"], r["n_tn"]) == (236, 219, 44, 558)
    assert r["recall"] == pytest.approx(0.8428571428571429, abs=1e-15)
    assert r["precision"] == pytest.approx(0.5186813186813187, abs=1e-15)
    assert r["f1"] == pytest.approx(0.6421768707482993, abs=1e-15)
    assert r["fbeta"] == pytest.approx(0.6775910364145659, abs=1e-15)


def test_sweep_equals_counting_at_every_cut(many):
    spec = EvalSpec()
    rows = pairs(many)
    got = threshold.threshold_sweep(many, "score", "y", spec).collect()
    assert [r["threshold"] for r in sorted(got, key=lambda r: r["threshold"])] == spec.thresholds()
    for r in got:
        assert (r["n_tp"], r["n_fp"], r["n_fn"], r["n_tn"]) == counts_by_hand(rows, r["threshold"])


def choose_by_hand(rows, spec):
    floor, best = spec.floor(), None
    table = []
    for cut in spec.thresholds():
        tp, fp, fn, _ = counts_by_hand(rows, cut)
        w = spec.beta**2
        recall = tp / (tp + fn) if tp + fn else 0.0
        bottom = (1 + w) * tp + w * fn + fp
        table.append((cut, recall, (1 + w) * tp / bottom if bottom else 0.0))
    kept = [t for t in table if t[1] >= floor]
    key = (lambda t: (t[2], t[1], -t[0])) if kept else (lambda t: (t[1], t[2], -t[0]))
    best = max(kept or table, key=key)
    return best[0], len(kept)


@pytest.mark.parametrize("floor", [0.0, 0.5, 0.9, 1.0])
def test_choice(many, floor):
    spec = EvalSpec(recall_floor=floor)
    sweep = threshold.threshold_sweep(many, "score", "y", spec)
    row = threshold.select_threshold(sweep, spec).collect()
    assert len(row) == 1
    assert (row[0]["threshold"], row[0]["n_feasible"]) == choose_by_hand(pairs(many), spec)


def test_choice_on_the_small_case(small):
    spec = EvalSpec(0.5, 1.0, 50)
    row = threshold.select_threshold(threshold.threshold_sweep(small, "score", "y", spec), spec).first()
    assert 0.3 < row["threshold"] <= 0.75 and row["floor_kept"] and row["warning"] is None
    # ties go to the lowest cut
    assert row["threshold"] == min(t for t in spec.thresholds() if t > 0.3)


def test_floor_out_of_reach_and_no_positives(spark, small):
    high = small.withColumn("score", F.col("score") * 0.001)
    row = threshold.select_threshold(threshold.threshold_sweep(high, "score", "y")).first()
    assert (row["threshold"], row["n_feasible"], row["floor_kept"]) == (0.01, 0, False)
    assert "no cut reaches recall" in row["warning"]
    none = spark.createDataFrame([(0, 0.4), (0, 0.6)], "y int, score double")
    row = threshold.select_threshold(threshold.threshold_sweep(none, "score", "y")).first()
    assert (row["threshold"], row["recall"], row["fbeta"]) == (0.01, 0.0, 0.0)


def test_summary_freezes_the_validation_cut(many):
    summary = {
        (r["split"], r["metric"]): r["value"]
        for r in evaluation.evaluation_summary(many, "score", "y").collect()
    }
    rows = pairs(many.where("split = 'validation'"))
    cut, _ = choose_by_hand(rows, EvalSpec())
    assert summary[("validation", "threshold")] == cut
    test_rows = pairs(many.where("split = 'test'"))
    tp, fp, fn, _ = counts_by_hand(test_rows, cut)
    assert summary[("test", "recall")] == pytest.approx(tp / (tp + fn))
    assert summary[("test", "precision")] == pytest.approx(tp / (tp + fp))
    assert summary[("test", "roc_auc")] == pytest.approx(auc_by_hand(test_rows))


def test_test_rows_do_not_move_the_cut(many):
    turned = many.withColumn(
        "y", F.when(F.col("split") == "test", 1 - F.col("y")).otherwise(F.col("y"))
    )
    def cut(df):
        return evaluation.choose_threshold(df, "score", "y", EvalSpec()).first()["threshold"]

    assert cut(many) == cut(turned)


def test_fixed_cut(many):
    r = evaluation.fixed_cut_metrics(many, "score", "y", 0.5).first()
    tp, fp, fn, _ = counts_by_hand(pairs(many), 0.5)
    assert r["recall"] == pytest.approx(tp / (tp + fn))
    assert r["f1"] == pytest.approx(2 * tp / (2 * tp + fp + fn))
