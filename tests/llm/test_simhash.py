from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from holdfast.llm import simhash

SCHEMA = "doc_id long, text string"


def plain_fingerprint(text):
    import re

    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not found:
        return 0
    shingles = [" ".join(found[i : i + 3]) for i in range(max(1, len(found) - 2))]
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_components(codes, distance):
    """Smallest position reachable, by brute force over all pairs."""
    label = list(range(len(codes)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(codes)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= distance:
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return [root(i) for i in range(len(codes))]


def check(spark, rows):
    got = simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    codes = [plain_fingerprint(t) for _, t in rows]
    groups = plain_components(codes, 3)
    least = {}
    for (i, _), g in zip(rows, groups):
        least[g] = min((x for x in (least.get(g), i) if x is not None), default=None)
    expected = sorted(((i, c, least[g]) for (i, _), c, g in zip(rows, codes, groups)), key=repr)
    found = sorted(((r[0], r[2] % (1 << 64), r[3]) for r in got), key=repr)
    assert found == expected


def test_fingerprint_edges():
    for text in (None, "", " \t\n", "one", "one two", "One TWO three", "É é A\x0bb", "a b c " * 700):
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_fingerprint_in_chunks(monkeypatch):
    text = " ".join(random.Random(1).choices("abcdefgh", k=1000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "CHUNK", 7)
    assert simhash.fingerprint(text) == whole == plain_fingerprint(text)


@pytest.mark.parametrize("seed", range(4))
def test_index_finds_every_close_pair(seed):
    draw = np.random.default_rng(seed)
    base = draw.integers(0, 1 << 63, 20, dtype=np.uint64)
    flips = [1 << int(k) for k in draw.integers(0, 64, 900)]
    codes = np.unique(np.array([int(base[i % 20]) ^ flips[3 * i] ^ flips[3 * i + 1] ^ flips[3 * i + 2]
                                for i in range(300)], np.uint64))
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    codes = codes[np.argsort(rank)]
    group = np.sort(draw.integers(0, 3, len(codes)))
    a, b = simhash.close_pairs(codes, group, 3)
    expected = {(i, j) for j in range(len(codes)) for i in range(j)
                if group[i] == group[j] and (int(codes[i]) ^ int(codes[j])).bit_count() <= 3}
    assert set(zip(a.tolist(), b.tolist())) == expected and len(a) == len(expected)


def test_components_match_brute_force(spark):
    draw = random.Random(5)
    base = [" ".join(draw.choices("abcdefghijklmnop", k=60)) for _ in range(25)]
    rows = []
    for i in range(200):
        text = draw.choice(base).split()
        if draw.random() < 0.6:
            text[draw.randrange(60)] = "x"
        rows.append((1000 - i, " ".join(text)))
    check(spark, rows)


def test_nulls_ties_repeats(spark):
    check(spark, [(3, None), (None, ""), (2, " "), (7, "a"), (7, "a"), (9, "A"), (None, "lonely one")])


def test_empty_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, fingerprint string, mask int, _row int")
    assert simhash.near_duplicates(empty).collect() == []
    kept = simhash.drop_near_duplicates(empty)
    assert kept.columns == empty.columns and kept.collect() == []


@pytest.mark.parametrize("limit", [16, 64])
def test_hot_groups_are_split_not_cut(spark, monkeypatch, limit):
    """A chain of codes that share most bits: more than one index may hold."""
    monkeypatch.setattr(simhash, "GROUP", limit)
    draw = random.Random(2)
    codes = [0]
    while len(codes) < 120:
        code = codes[-1] if draw.random() < 0.8 else draw.getrandbits(64)
        for _ in range(3):
            code ^= 1 << draw.randrange(40)
        codes.append(code)
    codes = sorted(set(codes))
    table = spark.createDataFrame([(simhash._signed(c),) for c in codes], "fingerprint long")
    links = simhash.close_links(table)
    labels = {r["v"]: r["root"] for r in simhash.connected_components(links).collect()}
    groups = plain_components(codes, 3)
    ours = [labels.get(simhash._signed(c), simhash._signed(c)) for c in codes]
    assert len(set(zip(ours, groups))) == len(set(groups)) == len(set(ours))


def test_long_chain_is_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1000), (7, 5)], "a long, b long")
    got = simhash.connected_components(links).agg(F.count("*"), F.max("root"), F.countDistinct("v")).first()
    assert tuple(got) == (301, 0, 301)


def test_one_of_each_group_stays(spark):
    rows = [(5, "a b c d", "x"), (2, "a b c d", "y"), (2, "a b c d", "y"), (None, "q r s", None),
            (None, "q r s", None), (8, None, None), (9, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _id string")
    kept = sorted(simhash.drop_near_duplicates(docs).collect(), key=repr)
    assert kept == sorted([(2, "a b c d", "y"), (8, None, None), (None, "q r s", None)], key=repr)
