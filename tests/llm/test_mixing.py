from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from holdfast.llm import mixing
from holdfast.llm.common import settle

SCHEMA = "doc_id long, text string, source string"


def plain_targets(sizes):
    """Shares by weight; what is above twice the size is shared again, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), 1.5 * sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not over:
            target |= {s: level * weight[s] for s in open_}
            break
        target |= {s: 2.0 * sizes[s] for s in over}
        left -= sum(target[s] for s in over)
        open_ -= over
    return target


def check(rows, report, block):
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    target = plain_targets(sizes)
    size_of = {s: float(n) for s, n in sizes.items()}
    got = defaultdict(int)
    assert len(report) == len(rows)
    by_id = {i: s for i, _, s in rows}
    for r in report:
        source = by_id[r["doc_id"]]
        assert r["source_size"] == size_of[source] and r["target"] == pytest.approx(target[source])
        assert 0 <= r["taken"] <= 2 * r["size"]
        got[source] += r["taken"]
    for source, n in target.items():
        assert abs(got[source] - n) <= block + 1


@pytest.mark.parametrize("seed", range(2))
def test_targets_and_words(spark, monkeypatch, seed):
    monkeypatch.setattr(mixing, "BLOCK", 8)
    monkeypatch.setattr(mixing, "SHARD", 16)
    monkeypatch.setattr(mixing, "RUN", 50)
    draw = random.Random(seed)
    names = ["b", "a", None, "é", "z", "tiny"]
    rows = [(i, " ".join(f"w{i}_{k}" for k in range(draw.randrange(60))), draw.choices(names, [8, 3, 2, 2, 1, 0.3])[0])
            for i in range(300)]
    rows += [(300, None, "a"), (301, "", "none"), (302, " \t", None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    report = mixing.mix_report(docs).collect()
    check(rows, report, 8)
    again = mixing.mix_report(docs.repartition(7).orderBy(F.desc("doc_id"))).collect()
    assert sorted(map(tuple, report)) == sorted(map(tuple, again))
    pieces = mixing.mix(docs).collect()
    taken, used = Counter(), Counter()
    texts = {i: (t or "").split() for i, t, _ in rows}
    for p in pieces:
        own = texts[p["doc_id"]][p["word_from"] : p["word_to"]]
        assert p["text"] == " ".join(own) and own
        taken[p["doc_id"]] += len(own)
        used.update((p["doc_id"], k) for k in range(p["word_from"], p["word_to"]))
    assert all(taken[r["doc_id"]] == r["taken"] for r in report) and max(used.values()) <= 2
    assert len({p["shard"] for p in pieces}) > 10
    blocks = Counter((p["source"], p["slot"]) for p in pieces for _ in range(p["word_to"] - p["word_from"]))
    assert max(blocks.values()) <= 8


def test_permutation_is_one(spark):
    for n in (1, 2, 3, 5, 17, 100, 255, 256, 1000, 4099):
        index = F.col("id")
        found = spark.range(n).select(mixing.permuted(index, F.lit(n), F.lit(7), F.lit(1)).alias("x"))
        values = [r[0] for r in found.collect()]
        assert sorted(values) == list(range(n))
        if n > 50:
            assert values != sorted(values)


def test_sources_are_drawn_for_each_shard(spark, monkeypatch):
    """Shards have their size; the counts of the sources in them vary as independent draws do."""
    monkeypatch.setattr(mixing, "BLOCK", 1)
    monkeypatch.setattr(mixing, "SHARD", 64)
    sources = [(0, 3000, 4100.0), (1, 2000, 1500.0), (2, 900, 800.0), (3, 4000, 2700.0)]
    table = spark.createDataFrame(sources, "rank int, source_size long, target double")
    slots = mixing._slots(table, spark).groupBy("shard", "rank").count().collect()
    counts = {(r["shard"], r["rank"]): r["count"] for r in slots}
    of_shard, of_source = Counter(), Counter()
    for (shard, rank), n in counts.items():
        of_shard[shard] += n
        of_source[rank] += n
    total = sum(of_source.values())
    assert [of_source[r] for r in range(4)] == [4100, 1500, 800, 2700]
    last = max(of_shard)
    assert last == -(-total // 64) - 1 and all(n == 64 for shard, n in of_shard.items() if shard != last)
    chi = sum(
        (counts.get((shard, rank), 0) - of_shard[shard] * n / total) ** 2 / (of_shard[shard] * n / total)
        for shard in of_shard for rank, n in of_source.items()
    )
    free = (len(of_shard) - 1) * 3
    assert abs(chi - free) < 5 * (2 * free) ** 0.5  # too even would be as wrong as too uneven


def test_repeats_and_clashing_columns(spark):
    rows = [(1, "a b c", "s", 9), (1, "a b c", "s", 9), (1, "x", "s", 9), (None, "d e", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    report = mixing.mix_report(docs).collect()
    assert sorted((r["doc_id"] or 0, r["size"], r["taken"] <= 2 * r["size"]) for r in report) == [
        (0, 2, True), (1, 1, True), (1, 3, True), (1, 3, True)]
    assert sum(r["taken"] for r in report) == pytest.approx(13.5, abs=2)
    empty = docs.limit(0)
    assert mixing.mix_report(empty).collect() == [] == mixing.mix(empty).collect()


def test_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "source").collect()
    check([tuple(r) for r in docs], mixing.op5_mixing(spark, SMALL).collect(), mixing.BLOCK)


def test_no_python_in_the_plan(spark):
    import contextlib
    import io

    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        mixing.op5_mixing(spark, SMALL).explain("simple")
    assert "Python" not in shown.getvalue() and "Arrow" not in shown.getvalue()


def plan_of(table):
    return table._jdf.queryExecution().executedPlan().toString()


def broadcast(table):
    """The lines of its plan that stand under a broadcast."""
    lines, found = plan_of(table).splitlines(), set()
    depth = [len(re.match(r"[ :+-]*", line)[0]) for line in lines]
    for k, line in enumerate(lines):
        if "BroadcastExchange" in line:
            below = next((j for j in range(k + 1, len(lines)) if depth[j] <= depth[k]), len(lines))
            found |= set(lines[k:below])
    return found


def test_slots_are_not_broadcast(spark):
    """Two rows that unfold to 12 million slots look small to the planner; they do not go through the driver."""
    kind = "rank int, size long, source_size long, target double, h1 long, h2 long, copy int, start long"
    words = 4_000_000 * mixing.BLOCK
    rows = [(k, words, words, 1.5 * words, k, k, 1, 0) for k in range(2)]
    pieces = mixing.mixed_pieces(settle(spark.createDataFrame(rows, kind), "placed"))
    assert "explode(sequence(first" in plan_of(pieces)
    assert not [x for x in broadcast(pieces) if "explode(sequence(first" in x or "explode(sequence(FLOOR" in x]


def test_mixture_does_not_broadcast_slots(spark, tmp_path):
    """The stage of the pipeline, from a file of few rows."""
    docs = spark.createDataFrame([(i, f"w{i} " * 300, "ab"[i % 2]) for i in range(40)], SCHEMA)
    docs.write.parquet(str(tmp_path / "docs"))
    mix = mixing.mix(spark.read.parquet(str(tmp_path / "docs")))
    assert "explode(sequence(first" in plan_of(mix)
    assert not [x for x in broadcast(mix) if "explode(sequence(first" in x or "explode(sequence(FLOOR" in x]


def test_slots_are_unfolded_in_many_tasks(spark, monkeypatch):
    """Slots are numbered in the tasks that they are dealt to, not in those of the few rows of the sources."""
    monkeypatch.setattr(mixing, "SHARD", 8)
    monkeypatch.setattr(mixing, "SLOTS_PER_TASK", 500)
    rows = [(k, 200_000, 300_000.0) for k in range(3)]
    sources = settle(spark.createDataFrame(rows, "rank int, source_size long, target double").coalesce(1), "targets")
    slots = mixing._slots(sources, spark)
    tasks = slots.groupBy(F.spark_partition_id().alias("task")).count().collect()
    total = sum(r["count"] for r in tasks)
    assert len(tasks) > 8 and max(r["count"] for r in tasks) < total / 3
    assert "Join" not in plan_of(slots)
