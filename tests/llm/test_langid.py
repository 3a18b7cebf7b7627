from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from holdfast.llm import langid


def plain_bits(trained, text):
    """PPM with method C escapes, byte by byte, from dictionaries. trained: texts of one language."""
    seen = defaultdict(Counter)
    for t in trained:
        data = langid.START + t.encode()
        for i in range(langid.ORDER, len(data)):
            for k in range(langid.ORDER + 1):
                seen[data[i - k : i]][data[i]] += 1
    data, bits = langid.START + text.encode(), 0.0
    for i in range(langid.ORDER, len(data)):
        for k in range(langid.ORDER, -1, -1):
            found = seen.get(data[i - k : i])
            if not found:
                continue
            n, d = sum(found.values()), len(found)
            if data[i] in found:
                bits -= math.log2(found[data[i]] / (n + d))
                break
            bits -= math.log2(d / (n + d))
        else:
            bits += 8
    return bits


LEARN = [("en", "the cat and the hat"), ("en", "then that"), ("de", "der Hut und die Katze"), ("fr", "l'été à la plage")]
ASK = ["the", "die Katze", "été", "zzz 123", "a", "", "né the\n\nund", "x" * 50]


def trained():
    rows = []
    for i, (lang, text) in enumerate(LEARN):
        rows.append((next(j for j in range(100 * i, 100 * i + 99) if zlib.crc32(str(j).encode()) % 5), text, lang))
    return rows


def test_exact_code_lengths(spark, monkeypatch):
    docs = spark.createDataFrame(trained(), "doc_id long, text string, lang string")
    model = langid.learn(docs)
    assert model.langs == ["de", "en", "fr"]
    expected = [[plain_bits([t for g, t in LEARN if g == lang], a) for lang in model.langs] for a in ASK]
    assert np.allclose(model.bits(ASK), expected, rtol=1e-5)
    monkeypatch.setattr(langid, "CHUNK", 3)  # every text is long, in pieces
    assert np.allclose(model.bits(ASK), expected, rtol=1e-5)


def test_lookup():
    draw = np.random.default_rng(1)
    keys = np.unique(draw.integers(0, 1 << 40, 5000))
    ask = np.r_[keys[::3], draw.integers(0, 1 << 40, 1000)]
    rows = langid.Lookup.of(keys).rows(ask)
    place = {k: i for i, k in enumerate(keys.tolist())}
    assert rows.tolist() == [place.get(k, -1) for k in ask.tolist()]


def test_edges(spark):
    rows = [(*r, 1, "x") for r in trained()]
    rows += [(7, None, "en", 2, "y"), (8, "", None, 3, None), (None, "the cat", "en", 4, "z"), (9, "42 !!", "de", 5, "w"),
             (9, "42 !!", "de", 5, "w"), (10, "the " * 400_000, None, 6, "v")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int, _row string")
    got = {(r["_row"]["doc_id"], r["_row"]["_row"]): (r["lang_pred"], r["score"]) for r in langid.predict(docs).collect()}
    assert got[(7, "y")] == got[(8, None)] == got[(9, "w")] == ("und", 0.0)
    assert got[(None, "z")][0] == got[(10, "v")][0] == "en"
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns and kept.where("doc_id in (7, 8, 9)").count() == 0
    ids = spark.createDataFrame([(None,), (5,), (12,)], "doc_id long")
    assert [r[0] for r in ids.select(langid.held_out(F.col("doc_id"))).collect()] == [
        True, zlib.crc32(b"5") % 5 == 0, zlib.crc32(b"12") % 5 == 0]


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert langid.predict(empty).collect() == []
    unknown = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert [tuple(r)[1:] for r in langid.predict(unknown).collect()] == [("und", 0.0)]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = langid.predict(docs).select("_row.*", "lang_pred").where(langid.held_out(F.col("doc_id")))
    right = found.where("lang is not null and lang_pred <> 'und'").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")))
    assert right.first()[0] > 0.95


def learned_from(start=0):
    """Ids that are not held out."""
    return (i for i in range(start, 10**9) if zlib.crc32(str(i).encode()) % 5)


def test_sample_is_bounded(spark, monkeypatch):
    """By bytes, for texts shorter and longer than a piece, for copies and for repeated rows."""
    monkeypatch.setattr(langid, "LEARN_BYTES", 2000)
    monkeypatch.setattr(langid, "PIECE", 100)
    ids = learned_from()
    rows = [(next(ids), f"word{i} " * 3, "en") for i in range(1000)] + [(next(ids), "mot " * 10_000, "fr")]
    rows += [(next(ids), "dasselbe Wort " * 20, "de") for _ in range(300)] + [(next(ids), "palabra " * 30, "es")] * 400
    sample = langid._sample(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    sizes = {r["lang"]: r["n"] for r in sample.groupBy("lang").agg(F.sum(F.octet_length("part") - langid.ORDER).alias("n")).collect()}
    assert sizes.keys() == {"en", "fr", "de", "es"} and all(2000 <= n < 2100 for n in sizes.values()), sizes


@pytest.mark.parametrize("size", [10**k for k in range(3, 16)])
def test_share_at_any_size(size):
    """Expected candidates are twice what is learned, from a kilobyte to 1000 terabytes."""
    below = langid.draw_below(size, 5)
    share = (below + 1) / 2**63
    assert abs(share * size - min(size, 2 * langid.LEARN_BYTES)) < 1e-3 * size * share
    assert langid.draw_below(10**30, 12345) == 12345


def test_large_documents_are_learned_from(spark):
    """Languages that are one document of 3 MB, or one of which there are many copies."""
    ids = learned_from()
    rows = [(next(ids), "the quick brown fox and the lazy dog " * 90_000, "en")]
    rows += [(next(ids), "der schnelle braune Fuchs und der faule Hund " * 40, "de") for _ in range(2000)]
    rows += [(next(ids), "le vif renard brun et le chien paresseux", "fr")]
    model = langid.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.langs == ["de", "en", "fr"]
    bits = model.bits(["brown fox and the lazy dog", "braune Fuchs und der faule", "renard brun et le chien"])
    assert bits.argmin(axis=1).tolist() == [1, 0, 2]


def test_pieces_teach_what_the_whole_text_teaches(spark, monkeypatch):
    docs = spark.createDataFrame(trained(), "doc_id long, text string, lang string")
    whole = langid.learn(docs).bits(ASK)
    monkeypatch.setattr(langid, "PIECE", 3)
    assert np.allclose(langid.learn(docs).bits(ASK), whole, rtol=1e-6)
