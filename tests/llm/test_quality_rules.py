from __future__ import annotations

import random
import re

import pytest

from conftest import SMALL
from holdfast.llm import quality


def plain(text):
    """The contract's figures, straight from its words."""
    text = text or ""
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, n_dup = [], 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            n_dup += line in seen
            seen.append(line)
    windows = [tuple(found[i : i + 8]) for i in range(len(found) - 7)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
    n = len(found)
    return (n, sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), n_dup, len(covered),
            n < 20 or 100 * len(covered) > 30 * n)


def figures(row):
    return tuple(row[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))


def test_odd_texts():
    draw = random.Random(0)
    texts = [None, "", " \n\t\n", "a\x1cb\x85c d\x0be", "one\n\none\n \n \none", "é😀 #<>", "x " * 30, "a b c d e f g h " * 4]
    texts += [" ".join(draw.choices("ab", k=draw.randrange(60))) for _ in range(60)]
    texts += ["\n".join(draw.choices(["l m", "", " ", "q"], k=12)) for _ in range(20)]
    for text in texts:
        assert figures(quality.measure(text)) == plain(text), text


def test_query(spark):
    got = quality.op2_quality(spark, SMALL)
    assert got.columns == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = got.collect()
    assert len(rows) == len(docs)
    for r in rows:
        if len(docs[r["doc_id"]] or "") < 8000:
            assert figures(r) == plain(docs[r["doc_id"]])
        assert not (r["kept"] and r["base_failed"])


PROSE = "The cat sat on the mat, and nobody minded it at all; so it slept there for hours."


@pytest.mark.parametrize("line, fault", [
    (PROSE, None), ("Is.", None), ("A heading", None), ("Really? Yes! No.", None), ("He said: a / b.", None),
    ("### buy *** $$$ now %%%", "punctuation"), ("BUY!! NOW!! CHEAP!! PILLS!!", "punctuation"),
    ("Home | News | About | Contact", "navigation"), ("Home > Shop > Shoes", "navigation"),
    ("(c) 2020. All Rights Reserved.", "boilerplate"), ("Please enable JavaScript.", "boilerplate"),
    (" ".join(["word"] * 50), "punctuation"),
])
def test_lines(line, fault):
    assert quality.line_fault(line) == fault


def test_documents_that_lose_too_much_go(spark):
    other = ["A dog barked far away, then closer, and the night was over.", "Owls know nothing of this, or so they say."]
    good = "\n".join([PROSE, *other[:2], "Home | News | About", ""])
    junk = "Home | News | About | Contact | Help and more of it | Shop | Sale"
    bad = "\n".join([PROSE] + [f"{junk} | {i}" for i in range(9)])
    docs = spark.createDataFrame([(1, good, 5), (2, bad, 6), (3, None, 7), (1, good, 5)], "doc_id long, text string, quality int")
    kept = quality.clean_documents(docs)
    assert kept.columns == docs.columns
    clean = "\n".join([PROSE, *other[:2], ""])
    assert [tuple(r) for r in kept.collect()] == [(1, clean, 5)] * 2
    assert quality.clean_documents(docs.limit(0)).collect() == []


def test_labelled_quality(spark):
    """Nearly every good document that the base rules pass stays; nearly every other bad one goes."""
    verdict = quality.op2_quality(spark, SMALL.replace("0.001", "0.01"))
    labels = spark.read.parquet(SMALL.replace("0.001", "0.01") + "/labels.parquet")
    rows = verdict.where("not base_failed").join(labels, "doc_id").collect()
    good, bad = [r["kept"] for r in rows if r["quality"]], [r["kept"] for r in rows if not r["quality"]]
    assert sum(good) > 0.98 * len(good) and sum(bad) < 0.1 * len(bad)


PHRASES = ["You can read more in the report.", "Pour en savoir plus, voir le rapport.", "Hier klicken, und es geht los.", "Puede leer más en el informe."]


@pytest.mark.parametrize("phrase", PHRASES)
def test_a_phrase_in_a_long_line_is_no_boilerplate(phrase):
    """A clean text on one line keeps its line when one of its sentences holds a phrase."""
    sentences = [f"The station master wrote down train number {i} and went home early." for i in range(200)]
    text = " ".join([*sentences[:90], phrase, *sentences[90:]])
    assert quality.clean(text)[0] == text
    assert quality.clean("\n".join([*sentences, phrase.split(",")[0]]))[2] > 0


@pytest.mark.parametrize("line", [
    "Copyright 2020. All rights reserved. Privacy policy", "Politique de confidentialité - Conditions d'utilisation",
    "Alle Rechte vorbehalten. Datenschutzerklärung.", "Todos los derechos reservados. Política de cookies.", "» Weiterlesen",
])
def test_boilerplate_lines_of_all_languages_go(line):
    assert quality.line_fault(line) in ("boilerplate", "navigation")
