from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from conftest import SMALL
from holdfast.llm import substrings


def plain(rows):
    """(id, words, removed, kept) per row, window by window."""
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    key = lambda i: float("-inf") if i is None else i
    first = {}
    for (i, _), own in zip(rows, split):
        for s in range(len(own) - 19):
            w, here = tuple(own[s : s + 20]), (key(i), s)
            first[w] = min(first.get(w, here), here)
    out = []
    for (i, _), own in zip(rows, split):
        gone = set()
        for s in range(len(own) - 19):
            if first[tuple(own[s : s + 20])] < (key(i), s):
                gone.update(range(s, s + 20))
        kept = " ".join(w for k, w in enumerate(own) if k not in gone)
        out.append((i, len(own), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def ours(docs):
    found = substrings.remove_repeats(docs).select("_row.doc_id", "n_words", "n_removed", "kept").collect()
    return sorted(((r[0], r[1], r[2], hashlib.sha256(r[3].encode()).hexdigest()) for r in found), key=repr)


def sample(seed, n=60, vocabulary=3000):
    draw = random.Random(seed)
    shared = [[f"p{draw.randrange(vocabulary)}" for _ in range(draw.randrange(15, 60))] for _ in range(6)]
    rows = []
    for i in draw.sample(range(1000), n):
        text = [f"w{draw.randrange(vocabulary)}" for _ in range(draw.randrange(0, 120))]
        for _ in range(draw.randrange(3)):
            at = draw.randrange(len(text) + 1)
            text[at:at] = draw.choice(shared)
        rows.append((i, draw.choice(["  ", "\n", " "]).join(text)))
    rows += [(2000 + k, rows[k][1]) for k in range(8)]
    rows += [(3000, " ".join(["again"] * 70)), (3001, " ".join(["again"] * 25)), (3002, "a b " * 40), (3003, "é 😀 " * 12)]
    return rows


@pytest.mark.parametrize("seed, broadcast, chunk, bits", [(1, 1 << 20, 1 << 17, 30), (2, 0, 25, 12), (3, 0, 1, 5)])
def test_as_window_by_window(spark, monkeypatch, seed, broadcast, chunk, bits):
    """Small and large tables are joined in other ways, a full map names more windows: all the same."""
    monkeypatch.setattr(substrings, "MAP_BITS", bits)
    monkeypatch.setattr(substrings, "BROADCAST", broadcast)
    monkeypatch.setattr(substrings, "CHUNK", chunk)
    rows = sample(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    if chunk < 1 << 17:  # tasks have their own copy of the module: run the pieces here
        for _, text in rows:
            pieces = list(substrings._chunks([text]))
            starts = sorted(f + s for _, b, _, f in ((0, p[1], 0, p[3]) for p in pieces) for k, f in enumerate(f)
                            for s in range(b[k + 1] - b[k] - 19))
            assert starts == list(range(max(0, len((text or "").split()) - 19)))
    assert ours(docs) == plain(rows)


def test_no_repeated_window_has_a_low_estimate():
    """Every window that occurs twice has an anchor whose sketch count is two or more, for any chunk."""
    rows = sample(7, vocabulary=40)
    for chunk in (1 << 17, 30):
        substrings.CHUNK, before = chunk, substrings.CHUNK
        try:
            counts, anchors = {}, {}
            for held, bounds, text, first in substrings._chunks([t for _, t in rows]):
                value, whole, once = substrings._anchors(substrings._hashes(held)[0], bounds)
                for c in substrings._cells(once).tolist():
                    counts[c] = counts.get(c, 0) + 1
                for at in np.flatnonzero(whole):
                    anchors.setdefault(tuple(held[at : at + 20]), []).append(int(substrings._cells(value[at : at + 1])[0]))
            for cells in anchors.values():
                assert len(set(cells)) == 1
                if len(cells) > 1:
                    assert counts[cells[0]] > 1
        finally:
            substrings.CHUNK = before


def test_polynomial_and_sliding():
    draw = np.random.default_rng(0)
    values = draw.integers(0, 1 << 63, 50, dtype=np.uint64)
    for width in (1, 2, 3, 8, 13, 20):
        for i, got in enumerate(substrings._slide(values, width, True)):
            assert got == values[i : i + width].min()
        seen = substrings._runs(np.r_[values, values], width, 0x9E3779B97F4A7C15)
        assert (seen[:30] == seen[50:80]).all() and len(np.unique(seen[:30])) == 30
        turned = np.r_[values[1::-1], values[2:]]
        if width > 1:
            assert substrings._runs(turned, width, 0x9E3779B97F4A7C15)[0] != seen[0]


def test_odd_rows(spark):
    passage = " ".join(f"q{k}" for k in range(25))
    rows = [(5, passage), (5, passage), (5, "x " + passage), (None, passage + " y"), (None, None), (7, ""), (8, None), (9, passage)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, row int, o int")
    assert ours(docs) == plain(rows)
    assert ours(docs.limit(0)) == []


def test_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = substrings.op3_substrings(spark, SMALL)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    rows = got.collect()
    assert sorted(map(tuple, rows), key=repr) == plain([tuple(r) for r in docs])
    assert sum(r["n_removed"] for r in rows) > 0


def test_map_has_every_cell(spark, monkeypatch):
    cells = np.unique(np.random.default_rng(3).integers(0, 1 << substrings.WIDTH, 3000))
    table = spark.createDataFrame([(int(c),) for c in cells], "cell long")
    for most in (30, 22, 9):
        monkeypatch.setattr(substrings, "MAP_BITS", most)
        known, bits = substrings._cell_map(table)
        place = cells >> (substrings.WIDTH - bits)
        assert bits <= most and len(known) == (1 << bits) // 8
        assert (known[place >> 3] >> (place & 7) & 1).all()
        assert np.unpackbits(known).sum() == len(np.unique(place))
