from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import pytest

from holdfast.llm import resampling

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def runs(text, longest):
    small = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    words = WORD.findall(small)
    return words, [b" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]


def expected(docs, target, longest, buckets, percent, least):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(crc32(f) % buckets for f in runs(text, longest)[1])
    for text in target:
        t.update(crc32(f) % buckets for f in runs(text, longest)[1])
    big_s, big_t = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets))))

    rows = []
    for doc_id, text in docs:
        words, found = runs(text, longest)
        weight = sum(gain(crc32(f) % buckets) for f in found)
        name = "" if doc_id is None else doc_id
        h = int(hashlib.sha256(f"2024:{name}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(found), weight, score, None, len(words)])
    able = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0]))
    for rank, row in enumerate(able[: percent * len(able) // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=repr)


TEXTS = [
    "The cat SAT on the mat, the cat sat." * 3, "", None, "word", "Ünïcode ÄÖ naïve café 漢字かな 漢字 " * 5, "a" * 5000 + " b",
    "\t\n --- !!! ", "one two three four five six seven eight nine ten " * 40, "x-y_z a.b.c 12:30 [tail]" * 9,
    "question what is the answer to the question " * 6,
]
DOCS = [(i, TEXTS[i % len(TEXTS)] and TEXTS[i % len(TEXTS)] + f" {i % 17}" * (i % 4)) for i in range(120)]
DOCS += [(7, "the same row again and again " * 5)] * 3 + [(None, "no id at all " * 10), (200, None)]
TARGET = ["what is the answer", "The question: what is seven", None, "", "eight nine ten"]


def tables(spark, docs, target):
    rows = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, weight int, score string")
    return rows.repartition(5), spark.createDataFrame([(t, 3) for t in target], "text string, rank int")


@pytest.mark.parametrize("longest,head", [(1, 1 << 16), (1, 4), (2, 1 << 16), (2, 8), (3, 50)])
def test_against_brute_force(spark, monkeypatch, longest, head):
    """With a head that holds everything, and with one that leaves most features to the tail."""
    monkeypatch.setattr(resampling, "HEAD", head)
    got = resampling.resample(*tables(spark, DOCS, TARGET), percent=30, longest=longest, buckets=97)
    assert sorted(map(tuple, got.collect()), key=repr) == expected(DOCS, TARGET, longest, 97, 30, 20)


def test_head_is_exact_and_bounded(spark):
    texts = spark.createDataFrame([("a b a c " * 10,), ("a " * 50 + "d",), ("f" * 100 + " ",)] * 2, "text string")
    assert dict(resampling.learn_head(texts, 2)).keys() >= {b"a", b"b", b"a b", b"d"}
    assert b"f" * 100 not in resampling.learn_head(texts)
    resampling.HEAD, before = 3, resampling.HEAD
    try:
        assert dict(resampling.learn_head(texts)) == {b"a": crc32(b"a")}
    finally:
        resampling.HEAD = before


@pytest.mark.parametrize("longest", [1, 2, 4])
@pytest.mark.parametrize("chunk", [1, 7, 50])
def test_pieces_of_long_texts(longest, chunk):
    text = " ".join(f"w{i % 13}-é{i}" for i in range(200))
    head = resampling.Head()
    got = []
    for words, old in resampling.pieces(text, longest, chunk):
        got += head.codes(words, old, longest).tolist()
    assert sorted(got) == sorted(crc32(f) for f in runs(text, longest)[1])


def test_draw_prefers_the_target(spark):
    docs = [(i, ("red green blue " if i % 4 == 0 else "up down left right ") * 10) for i in range(400)]
    ranks = resampling.resample(*tables(spark, docs, ["red green", "blue"]), percent=10).where("rank is not null")
    assert [r["doc_id"] % 4 for r in ranks.collect()] == [0] * 40
    kept = resampling.drawn(*tables(spark, docs, ["red green", "blue"]), percent=10)
    assert kept.count() == 40 and kept.columns == ["doc_id", "text", "weight", "score"]


def test_empty_tables(spark):
    docs, target = tables(spark, DOCS[:3], [])
    assert resampling.resample(docs, target.limit(0)).count() == 3
    assert resampling.resample(docs.limit(0), target).collect() == []
