from __future__ import annotations

import math
import random

import numpy as np
import pytest

from conftest import SMALL
from holdfast.llm import negatives


def expected(rows, anchors=100, positives=5, wanted=10, low=30, high=90):
    usable = [
        (i, label, [math.floor(256 * float(x)) for x in v]) for i, label, v in rows
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for a, (anchor, label, v) in enumerate(usable):
        if anchor % anchors:
            continue
        scores = [
            (max(-(1 << 56), min(1 << 56, sum(x * y for x, y in zip(v, w)))), i, other == label)
            for b, (i, other, w) in enumerate(usable) if b != a
        ]
        scores.sort(key=lambda s: (-s[0], s[1]))
        for best, positive, _ in [s for s in scores if s[2]][:positives]:
            fits = [s for s in scores if not s[2] and low * best <= 100 * s[0] <= high * best][:wanted]
            out += [(anchor, positive, r, i, best, s) for r, (s, i, _) in enumerate(fits, 1)]
    return sorted(out)


def found(spark, rows, **settings):
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    table = table.selectExpr("*", "vec_id as row", "label as number", "1 as slot").repartition(3)
    return sorted(map(tuple, negatives.hard_negatives(table, **settings).collect()))


def vectors(n, seed, width=8, spread=1.0):
    rng = np.random.default_rng(seed)
    return [(i, int(rng.integers(4)), (rng.standard_normal(width) * spread + 0.6).tolist()) for i in range(n)]


@pytest.mark.parametrize("slice_,scores", [(8192, 1 << 20), (3, 100)])
def test_against_brute_force(spark, monkeypatch, slice_, scores):
    """In one slice and in many, with few scores at a time."""
    monkeypatch.setattr(negatives, "SLICE", slice_)
    monkeypatch.setattr(negatives, "SCORES", scores)
    rows = vectors(300, 1)
    got = found(spark, rows, anchors=20)
    assert got == expected(rows, 20) and len(got) > 300


def test_ties_repeats_and_odd_rows(spark):
    rng = random.Random(5)
    rows = [(i, rng.randrange(3), [rng.randrange(3) / 2, rng.randrange(3) / 2]) for i in range(120)]
    rows += [rows[20]] * 3 + [(1000, 0, [1.0]), (1100, 1, []), (1200, 2, [0.5, 0.5, 9.0])]
    rows += [(1300, None, [1.0, 1.0]), (1400, 1, None), (1500, 1, [None, 1.0]), (1600, 1, [math.nan, 1.0])]
    rows += [(1700, 2, [math.inf, 1.0]), (None, 1, [1.0, 1.0]), (-100, 1, [-1.0, -0.5])]
    assert found(spark, rows, anchors=20) == expected(rows, 20)


@pytest.mark.parametrize("size", [1e5, 1e9, 1e15])
def test_large_components(spark, size):
    rows = [(i, lab, [x * size for x in v]) for i, lab, v in vectors(60, 2, 4)]
    assert found(spark, rows, anchors=10) == expected(rows, 10)


def test_fewer_than_asked(spark):
    rows = [(0, 1, [1.0]), (1, 1, [1.0]), (2, 2, [0.5]), (100, 3, [1.0]), (4, 2, [0.95]), (5, 2, [-1.0])]
    assert found(spark, rows) == [(0, 1, 1, 2, 65536, 32768)]
    assert found(spark, []) == []


def test_query(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "label", "embedding").collect()
    moved = [(r[0], (r[1] + 1) % 10 if r[0] % 7 == 0 else r[1], list(r[2])) for r in rows]
    got = negatives.op13_negatives(spark, SMALL)
    assert got.dtypes == [
        ("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"), ("negative_id", "bigint"),
        ("positive_score", "bigint"), ("negative_score", "bigint"),
    ]
    assert sorted(map(tuple, got.collect())) == expected(moved)
