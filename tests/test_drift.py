import itertools
import math

import pytest
from pyspark.sql import functions as F

from holdfast.contracts import SNAPSHOT_SPEC
from holdfast.functions import pvalues
from holdfast.operators import drift
from holdfast.plans import drift as drift_plan
from holdfast.sources import sinks
from holdfast.spec import LabelSpec, ModelingSpec

SPEC = ModelingSpec("id", {"x": "number"}, ("c",), LabelSpec("y"))


# Published statistics and p-values: (D, n1, n2, p) and (chi-square, dof, p).
@pytest.mark.parametrize(
    "d, n1, n2, p",
    [
        (0.001233600379888264, 4929, 1057, 1.0),
        (0.02364608663456273, 4929, 1057, 0.7044963440336708),
        (0.037603218301585445, 4929, 1057, 0.16565561359547232),
        (0.018612491812121913, 4920, 1055, 0.9177144377687299),
    ],
)
def test_published_ks(d, n1, n2, p):
    assert pvalues.ks_p_value(d, n1, n2) == pytest.approx(p, abs=1e-10)
    assert pvalues.ks_p_value(d, n2, n1) == pytest.approx(p, abs=1e-10)


@pytest.mark.parametrize(
    "x, dof, p",
    [
        (0.09687660667855612, 1, 0.7556105209168659),
        (2.1341061388353544, 1, 0.14405441080396547),
        (4.676564092061679, 2, 0.09649326690941823),
        (1.1445458563560291, 2, 0.5642414996978582),
        (0.64554618574968, 3, 0.8859309400695439),
    ],
)
def test_published_chi2(x, dof, p):
    assert pvalues.chi2_p_value(x, dof) == pytest.approx(p, abs=1e-13)


def test_p_value_edges():
    assert pvalues.ks_p_value(0.0, 5, 5) == 1.0
    # all 3 + 3 values apart: 2 of the 20 orders
    assert pvalues.ks_p_value(1.0, 3, 3) == pytest.approx(0.1)
    assert pvalues.ks_p_value(1.0, 20_000, 30_000) == 0.0
    # samples wholly apart: 2 of all orders, at any size
    for n1, n2 in ((7, 7), (12, 5), (60, 41)):
        assert pvalues.ks_p_value(1.0, n1, n2) == pytest.approx(2 / math.comb(n1 + n2, n1), rel=1e-9)
    assert pvalues.ks_p_value(1.0, 3013, 2987) < 1e-300
    assert pvalues.ks_p_value(0.6, 3013, 2987) < 1e-200


def test_exact_ks_equals_trying_every_order():
    n1, n2 = 6, 4
    orders = list(itertools.combinations(range(n1 + n2), n1))

    def gap(first):
        seen, worst = [0, 0], 0
        for at in range(n1 + n2):
            seen[at not in first] += 1
            worst = max(worst, abs(seen[0] * n2 - seen[1] * n1))
        return worst

    gaps = [gap(set(o)) for o in orders]
    for g in sorted(set(gaps)):
        want = sum(x >= g for x in gaps) / len(orders)
        assert pvalues.ks_p_value(g / (n1 * n2), n1, n2) == pytest.approx(want, abs=1e-12)
    assert pvalues.chi2_p_value(0.0, 1) == 1.0
    assert pvalues.chi2_p_value(5000.0, 700) == pytest.approx(0.0, abs=1e-200)
    assert pvalues.chi2_p_value(700.0, 700) == pytest.approx(0.493, abs=1e-3)


@pytest.mark.parametrize("n", [200, 2000, 9000])
@pytest.mark.parametrize("z", [0.5, 0.8, 1.2, 1.6])
def test_limit_meets_the_exact_distribution(n, z):
    d = z / math.sqrt(n)
    assert pvalues.ks_limit(d, n) == pytest.approx(1 - pvalues._one_sample_cdf(n, d), abs=1e-12)
    root = math.sqrt(n)
    corrected = z + 1 / (6 * root) + (z - 1) / (4 * n)
    series = 2 * sum((-1) ** (k - 1) * math.exp(-2 * (k * corrected) ** 2) for k in range(1, 50))
    assert series == pytest.approx(pvalues.ks_limit(d, n), abs=5e-4)


def ks_by_hand(a, b):
    return max(
        abs(sum(x <= v for x in a) / len(a) - sum(x <= v for x in b) / len(b)) for v in a + b
    )


@pytest.mark.parametrize("limit", [1_000_000, 10])
def test_ks_statistic(spark, limit):
    a = [float(i * 37 % 101) for i in range(150)] + [50.0] * 80
    b = [float(i * 11 % 89) for i in range(90)] + [50.0] * 10
    ref = spark.createDataFrame([(v,) for v in a] + [(None,)], "x double")
    cur = spark.createDataFrame([(v,) for v in b] + [(float("nan"),)], "x double")
    row = drift.ks_statistics(ref, cur, ["x"], one_range_rows=limit).first()
    assert (row["n_ref"], row["n_cur"]) == (230, 100)
    assert row["statistic"] == pytest.approx(ks_by_hand(a, b), abs=1e-15)


def report(ref, cur, spec=SPEC, alpha=0.05):
    return {r["column"]: r for r in drift.drift_report(ref, cur, spec, alpha).collect()}


def test_planted_shift_is_flagged(spark, sample):
    base = sample.where("customerID = '5575-GNVDE'").crossJoin(spark.range(500))
    ref = base.withColumn("MonthlyCharges", 20 + F.col("id") / 10).drop("id")
    cur = ref.withColumn("MonthlyCharges", F.col("MonthlyCharges") + 80)
    found = report(ref, cur, SNAPSHOT_SPEC)
    assert len(found) == 19
    assert found["MonthlyCharges"]["drift_flag"] and found["MonthlyCharges"]["statistic"] == 1.0
    assert [c for c, r in found.items() if r["drift_flag"]] == ["MonthlyCharges"]
    assert found["Contract"]["note"] == drift.NOTE_SINGLE
    assert found["Contract"]["statistic"] is None
    n = drift.flagged_columns(drift.drift_report(ref, cur, SNAPSHOT_SPEC)).first()[0]
    assert n == 1


def test_identical_frames_are_not_flagged(customers):
    found = report(customers, customers, SNAPSHOT_SPEC)
    assert not any(r["drift_flag"] for r in found.values())
    assert found["tenure"]["statistic"] == 0.0 and found["tenure"]["p_value"] == 1.0


def test_notes(spark):
    some = spark.createDataFrame([(1.0, "a"), (2.0, "b"), (3.0, None)], "x double, c string")
    blank = spark.createDataFrame([(None, "a"), (1.0, "b")], "x double, c string")
    assert report(some, blank)["x"]["note"] == drift.NOTE_FEW
    assert report(some.drop("x"), some.drop("x"))["x"]["note"] == drift.NOTE_ABSENT
    assert report(some, some.limit(0))["c"]["note"] == drift.NOTE_EMPTY
    nothing = some.withColumn("x", F.lit(None).cast("double"))
    assert report(nothing, nothing)["x"]["note"] == drift.NOTE_FEW


def test_missing_is_a_category_and_yates(spark):
    ref = spark.createDataFrame([("a",)] * 30 + [(None,)] * 10, "c string")
    cur = spark.createDataFrame([("a",)] * 20 + [(None,)] * 20, "c string")
    table = {
        r["value"]: (r["n_ref"], r["n_cur"]) for r in drift.contingency(ref, cur, ["c"]).collect()
    }
    assert table == {"a": (30, 20), "__NA__": (10, 20)}
    row = drift.chi2_statistics(ref, cur, ["c"]).first()
    # expected 25/25/15/15, every gap of 5 drawn in to 4.5
    assert row["dof"] == 1
    assert row["statistic"] == pytest.approx(2 * 4.5**2 / 25 + 2 * 4.5**2 / 15)


def test_missing_rates(spark):
    ref = spark.createDataFrame([(1.0,), (None,)], "x double")
    cur = spark.createDataFrame([(1.0,), (2.0,)], "x double")
    assert tuple(drift.missing_rates(ref, cur, ["x"]).first()) == ("x", 0.5, 0.0)


def test_job_from_paths(spark, customers, tmp_path):
    a = sinks.write_table(customers, str(tmp_path / "a.parquet"))
    b = sinks.write_table(customers.withColumn("tenure", F.col("tenure") + 80), str(tmp_path / "b.parquet"))
    rows = drift_plan.drift_job(spark, a, b, SNAPSHOT_SPEC, str(tmp_path), alpha=0.01).collect()
    assert {r["column"] for r in rows if r["drift_flag"]} == {"tenure"}
    assert {(r["reference"], r["current"], r["alpha"]) for r in rows} == {(a, b, 0.01)}


def test_empty_tables_keep_every_column(customers):
    none = customers.limit(0)
    found = report(none, none, SNAPSHOT_SPEC)
    assert len(found) == 19
    assert found["Contract"]["note"] == drift.NOTE_SINGLE and found["tenure"]["note"] == drift.NOTE_FEW


def test_each_table_is_read_once_per_kind(spark, customers, tmp_path, monkeypatch):
    """The counts are written by one scan of each table; the report reads the counts."""
    a = sinks.write_table(customers, str(tmp_path / "a.parquet"))
    ref, cur = spark.read.parquet(a), spark.read.parquet(a)
    scans, kept = [], drift._written

    def written(counts, name):
        scans.append(counts._jdf.queryExecution().executedPlan().toString().count("FileScan parquet"))
        return kept(counts, name)

    monkeypatch.setattr(drift, "_written", written)
    plan = drift.drift_report(ref, cur, SNAPSHOT_SPEC)._jdf.queryExecution().executedPlan().toString()
    assert scans == [2, 2] and "a.parquet" not in plan
