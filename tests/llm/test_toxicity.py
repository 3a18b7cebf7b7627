from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from conftest import SMALL
from holdfast.llm import toxicity

LARGER = SMALL.replace("0.001", "0.1")


def plain_features(text):
    data = [ord(x) for x in " " + (text or "").lower() + " "]
    out = set()
    for part, n in enumerate(toxicity.LENGTHS):
        for i in range(len(data) - n + 1):
            gram = 0
            for x in data[i : i + n]:
                gram = (gram * 0xBF58476D1CE4E5B9 + x + 1) % (1 << 64)
            place = gram * 0x9E3779B97F4A7C15 % (1 << 64) >> (64 - toxicity.BITS)
            out.add(place + (part << toxicity.BITS))
    return sorted(out)


def test_characters_not_bytes_make_an_ngram():
    """Four characters of any script are one n-gram of the first length, whatever their bytes."""
    first = [p for p in toxicity.features("漢字") if p < 1 << toxicity.BITS]
    assert len(first) == 1  # blank, two characters, blank


@pytest.mark.parametrize("text", [None, "", "a", "You IDIOT", "Straße é😀\n\tx", "ab" * 300])
def test_features(text, monkeypatch):
    expected = plain_features(text)
    assert toxicity.features(text).tolist() == expected
    monkeypatch.setattr(toxicity, "CHUNK", 5)
    assert toxicity.features(text).tolist() == expected


def test_fit_reaches_the_optimum(monkeypatch):
    """The gradient of the penalised loss vanishes at the fitted weights."""
    monkeypatch.setattr(toxicity, "ROUNDS", 4000)
    monkeypatch.setattr(toxicity, "PENALTY", 1e-2)
    draw = np.random.default_rng(0)
    ratios = draw.normal(size=12)
    places = [np.unique(draw.integers(0, 12, 5)) for _ in range(80)]
    labels = draw.integers(0, 2, 80)
    w, bias = toxicity.fit(places, labels, ratios)
    x = np.zeros((80, 12))
    for i, p in enumerate(places):
        x[i, p] = ratios[p] / np.linalg.norm(ratios[p])
    share = np.where(labels == 1, 0.5 / labels.sum(), 0.5 / (1 - labels).sum())
    slack = share * (1 / (1 + np.exp(-(x @ w + bias))) - labels)
    assert np.abs(x.T @ slack + toxicity.PENALTY * w).max() < 1e-6 and abs(slack.sum()) < 1e-6


def test_counts_over_all_rows(spark):
    """Log-count ratios against a count by hand; held-out rows teach nothing."""
    draw = random.Random(4)
    rows, marks = [], []
    for i in range(300):
        toxic = i % 3 == 0
        held = zlib.crc32(str(i).encode()) % 5 == 0
        word = "vile" if toxic else "kind"
        rows.append((i, f"{word} " + " ".join(draw.choices("abcdef", k=4)) + (" secretclue" if held else "")))
        marks += [(i, 1, int(toxic))] * (2 if i == 7 else 1)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([*marks, (None, 0, 1), (5000, 1, None)], "doc_id long, quality int, toxic int")
    model = toxicity.learn(docs, labels)
    learned = [(t, i % 3 == 0) for i, t in rows if zlib.crc32(str(i).encode()) % 5]
    total = {k: sum(x == k for _, x in learned) for k in (True, False)}
    clue = toxicity.features("vile ")
    for place in clue:
        held = {k: 1 + sum(place in set(toxicity.features(t).tolist()) for t, x in learned if x == k) for k in (True, False)}
        expected = np.log(held[True] / (total[True] + 2)) - np.log(held[False] / (total[False] + 2))
        clear = abs(expected) > toxicity.CLEAR * np.sqrt(1 / held[True] + 1 / held[False])
        assert model.ratios[place] == pytest.approx(expected if clear else 0)
    only_held = set(plain_features("secretclue")) - {p for t, _ in learned for p in plain_features(t)}
    assert only_held and not model.ratios[sorted(only_held)].any()
    scores = {r["_row"]["doc_id"]: r["score"] for r in toxicity.with_toxicity(docs, model).collect()}
    assert all((s >= 0.5) == (i % 3 == 0) for i, s in scores.items())


def test_clear_features_count_however_small_their_ratio(spark):
    """A word in a half of the toxic and a third of the other texts, over many rows."""
    rows = [(i, "sometimes" if i // 2 % 6 < (3 if i % 2 else 2) else "never") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    ratios = toxicity.learn(docs, labels).ratios[toxicity.features("sometimes")]
    assert ((ratios > 0.3) & (ratios < 0.5)).all()


def test_fit_in_blocks(monkeypatch):
    draw = np.random.default_rng(1)
    places = [np.unique(draw.integers(0, 30, draw.integers(0, 9))) for _ in range(50)] + [np.arange(30), np.arange(0)]
    labels, ratios = draw.integers(0, 2, 52), draw.normal(size=30)
    whole, bias = toxicity.fit(places, labels, ratios)
    monkeypatch.setattr(toxicity, "BLOCK", 7)
    parts, same_bias = toxicity.fit(places, labels, ratios)
    assert np.allclose(whole, parts) and bias == pytest.approx(same_bias) and whole.any()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    labels = spark.read.parquet(f"{LARGER}/labels.parquet")
    rows = toxicity.op9_toxicity(spark, LARGER).where("held_out").join(labels, "doc_id").collect()
    assert docs.count() > len(rows) > 500
    toxic = [r["predicted"] for r in rows if r["toxic"]]
    clean = [r["predicted"] for r in rows if not r["toxic"]]
    assert sum(toxic) > 0.85 * len(toxic) and sum(clean) < 0.04 * len(clean)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_long_texts_score_as_their_documents_do(spark):
    """Several MB of documents that each score low score low; of documents that score high, high."""
    docs = spark.read.parquet(f"{LARGER}/documents.parquet").where("text is not null").select("doc_id", "text")
    labels = spark.read.parquet(f"{LARGER}/labels.parquet")
    model = toxicity.learn(docs, labels)
    rows = toxicity.with_toxicity(docs.join(labels, "doc_id"), model).select("_row.text", "_row.toxic", "score").collect()
    clean = [r["text"] for r in sorted(rows) if not r["toxic"] and r["score"] < 0.05]
    toxic = [r["text"] for r in sorted(rows) if r["toxic"] and r["score"] > 0.5]
    text = "\n".join(clean)
    while len(text) < 4_000_000:
        text += "\n" + text
    assert all(model.score(text[:n]) < 0.1 for n in (300_000, 1_000_000, 4_000_000))
    assert model.score("\n".join(toxic)) > 0.5


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, 2.0), (1, None, 2.0), (None, "", 3.0)], "doc_id long, text string, score double")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.learn(docs, none)
    assert [r["score"] for r in toxicity.with_toxicity(docs, model).collect()] == [0.5] * 3
    assert toxicity.with_toxicity(docs.limit(0), model).collect() == []
    assert toxicity.learn(docs.limit(0), none).bias == 0
    labels = spark.createDataFrame([(2, 1, 1), (3, 1, 0), (4, 1, 0), (6, 0, 0)], "doc_id long, quality int, toxic int")
    same = spark.createDataFrame([(i, "text") for i in (2, 3, 4, 6)], "doc_id long, text string")
    scores = {r["score"] for r in toxicity.with_toxicity(same, toxicity.learn(same, labels)).collect()}
    assert len(scores) == 1 and scores.pop() <= 0.5
