from __future__ import annotations

import math

import numpy as np
import pytest

from conftest import SMALL
from holdfast.llm import lattice


def expected(rows, least=0.9):
    """All pairs, one by one."""
    usable = [
        i for i, (_, v) in enumerate(rows)
        if v and all(x is not None and math.isfinite(x) for x in v) and any(x != 0 for x in v)
    ]
    unit = {}
    for i in usable:
        v = np.array(rows[i][1], np.float64)
        v = v / np.abs(v).max()
        unit[i] = v / np.linalg.norm(v)
    links = {i: set() for i in range(len(rows))}
    for i in usable:
        for j in usable:
            if i != j and len(unit[i]) == len(unit[j]) and (rows[i][1] == rows[j][1] or unit[i] @ unit[j] >= least):
                links[i].add(j)
    return links


def components(rows, links):
    label = {}
    for i in range(len(rows)):
        if i in label:
            continue
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        for j in seen:
            label[j] = min(ids, default=None)
    return label


def table(spark, rows):
    rows = [(v, e, i, "x", 1) for i, (v, e) in enumerate(rows)]
    kind = "vec_id long, embedding array<double>, place long, id string, size int"
    return spark.createDataFrame(rows, kind).repartition(3)


def found(spark, rows, **settings):
    got = lattice.near_vectors(table(spark, rows), **settings)
    return {r["_row"]["place"]: (r["n_links"], r["component_id"]) for r in got.collect()}


def near(rng, base, cosine):
    """A vector at a cosine from a base of length one."""
    other = rng.standard_normal(len(base))
    other -= (other @ base) * base
    other /= np.linalg.norm(other)
    return cosine * base + math.sqrt(1 - cosine * cosine) * other


def clusters(seed, width=24, sizes=(1,) * 40 + (2,) * 30 + (5, 9, 70), least=0.92):
    rng = np.random.default_rng(seed)
    out = []
    for size in sizes:
        base = rng.standard_normal(width)
        base /= np.linalg.norm(base)
        out.append(base)
        out += [near(rng, base, rng.uniform(least, 1.0)) * rng.uniform(0.5, 3) for _ in range(size - 1)]
    order = rng.permutation(len(out))
    return [(int(k), out[i].tolist()) for k, i in enumerate(order)]


def same(rows, got):
    links = expected(rows)
    label = components(rows, links)
    assert got == {i: (len(links[i]), label[i]) for i in range(len(rows))}


MANY = {"tables": 40, "probes": 6}  # so many tables find every pair


def test_against_brute_force(spark):
    rows = clusters(1)
    same(rows, found(spark, rows, **MANY))


@pytest.mark.parametrize("block,core", [(10, 10_000), (10, 8), (100, 8), (8192, 8)])
def test_crowded_cells(spark, monkeypatch, block, core):
    """Cells cut into blocks, with cores that are counted and without: each link counts once."""
    monkeypatch.setattr(lattice, "CORE", core)
    rows = clusters(2, sizes=(1,) * 10 + (3, 60, 50), least=0.97)
    rows += [(i + 1000, v) for i, v in rows[:20]] * 2
    same(rows, found(spark, rows, block=block, scale=2.5, **MANY))


def test_odd_rows(spark):
    v = [0.6, 0.8, 0.0, 0.1]
    rows = [(5, v), (3, v), (3, v), (9, [2 * x for x in v]), (None, v), (None, None), (None, [1.0, -1.0])]
    rows += [(10, None), (11, []), (12, [0.0] * 4), (13, [None, 1.0, 1.0, 1.0]), (14, [math.nan] * 4)]
    rows += [(15, [math.inf, 1.0, 1.0, 1.0]), (16, [1e-320, 0.0, 0.0, 0.0]), (17, [1e300, 0.0, 0.0, 0.0])]
    rows += [(18, [1.0]), (19, [2.0]), (20, [-1.0]), (21, [1.0, 0.0]), (22, v[:3]), (16, [1e-320, 0.0, 0.0, 0.0])]
    same(rows, found(spark, rows, **MANY))
    assert found(spark, rows[:0]) == {}
    kept = lattice.drop_near_vectors(table(spark, rows))
    assert kept.columns == ["vec_id", "embedding", "place", "id", "size"]
    assert [r["vec_id"] for r in kept.where("vec_id in (3, 5, 9)").collect()] == [3, 3]


def test_recall_at_the_least_cosine(spark):
    """Pairs whose cosine is just enough are the hardest; the default settings find over 0.95."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(600):
        base = rng.standard_normal(64)
        base /= np.linalg.norm(base)
        rows += [(2 * i, base.tolist()), (2 * i + 1, near(rng, base, 0.9001).tolist())]
    got = found(spark, rows)
    assert all(n <= 1 for n, _ in got.values())
    assert sum(n for n, _ in got.values()) / len(rows) > 0.95


def test_decoding_is_nearest():
    """No point one root away is nearer, and points decode to themselves."""
    x = np.random.default_rng(4).standard_normal((500, 8)) * 2
    point = lattice.decode(x)
    away = ((x[:, None] - point[:, None] - lattice.roots()) ** 2).sum(-1)
    assert (((x - point) ** 2).sum(-1)[:, None] <= away + 1e-12).all()
    assert (lattice.decode(point) == point).all() and len(lattice.roots()) == 240


def test_query(spark):
    got = lattice.op12_lattice(spark, SMALL)
    assert got.dtypes == [("vec_id", "bigint"), ("n_links", "bigint"), ("component_id", "bigint"), ("kept", "boolean")]
    rows = [(r[0], list(r[1])) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()]
    links = expected(rows)
    label = components(rows, links)
    want = sorted((v, len(links[i]), label[i], v == label[i]) for i, (v, _) in enumerate(rows))
    assert sorted(map(tuple, got.collect())) == want
