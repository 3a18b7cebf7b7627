from __future__ import annotations

import random
import time
import tracemalloc

import numpy as np
import pytest

from conftest import SMALL
from holdfast.llm import decontaminate as op


def plain_align(passage, item):
    """The textbook matrix, cell by cell."""
    rows = [[0] * (len(passage) + 1) for _ in range(len(item) + 1)]
    for i, b in enumerate(item, 1):
        for j, a in enumerate(passage, 1):
            rows[i][j] = max(0, rows[i - 1][j - 1] + (op.MATCH if a == b else op.MISMATCH),
                             rows[i - 1][j] + op.GAP, rows[i][j - 1] + op.GAP)
    return max(map(max, rows))


@pytest.mark.parametrize("seed", range(20))
def test_align(seed):
    draw = np.random.default_rng(seed)
    passage, item = draw.integers(0, 4, draw.integers(0, 40)), draw.integers(0, 4, draw.integers(1, 15))
    score, begin, end = op.align(passage, item)
    assert score == plain_align(passage.tolist(), item.tolist())
    assert plain_align(passage[begin:end].tolist(), item.tolist()) == score


def sentence(draw, n):
    return [f"w{draw.randrange(5000)}" for _ in range(n)]


def test_copies_and_edits_are_found_and_clean_texts_left(spark):
    draw = random.Random(3)
    items = [sentence(draw, draw.randrange(15, 50)) for _ in range(40)] + [["the", "the", "the", "of"]]
    docs, expected = [], set()
    for i in range(400):
        text = sentence(draw, draw.randrange(0, 300))
        if i % 4 == 0:
            k = draw.randrange(40)
            copy = list(items[k])
            if i % 8 == 0:  # every fifth word another, one left out, one put in
                copy = [w if p % 5 else "edited" for p, w in enumerate(copy)]
                del copy[7]
                copy.insert(3, "new")
            at = draw.randrange(len(text) + 1)
            text[at:at] = [w.upper() + "," for w in copy]
            expected.add((i, k))
        docs.append((i, " ".join(text)))
    docs.append((400, None))
    docs.append((401, " ".join(["the"] * 50)))
    expected.add((401, 40))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)] + [(None, None), (99, "a b")], "item_id long, text string")
    found = op.with_leaks(table, bench).select("_row.doc_id", "leaks").collect()
    assert {(r["doc_id"], x["item_id"]) for r in found for x in r["leaks"]} == expected
    assert len(found) == len(docs)


def test_brute_force_on_documents(spark):
    """Every pair of document and item, aligned without seeds."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()
    items = op.Items.of([tuple(r) for r in bench])
    expected = set()
    for doc_id, text in docs:
        numbers, _ = items.numbered([text])
        for item_id, words in zip(items.ids, items.words):
            if op.align(numbers, words)[0] >= op.LEAST * op.MATCH * len(words):
                expected.add((doc_id, item_id))
    got = {(r["doc_id"], r["item_id"]) for r in op.op8_decontaminate(spark, SMALL).collect()}
    assert got == expected and got


def test_several_passes_over_a_large_benchmark(spark, monkeypatch):
    whole = sorted(map(tuple, op.op8_decontaminate(spark, SMALL).collect()))
    monkeypatch.setattr(op, "BOUND", 500)
    assert sorted(map(tuple, op.op8_decontaminate(spark, SMALL).collect())) == whole


def test_long_text_in_windows(monkeypatch):
    draw = random.Random(1)
    item = sentence(draw, 30)
    items = op.Items.of([(1, " ".join(item))])
    monkeypatch.setattr(op, "WINDOW", 50)
    text = []
    for _ in range(200):
        text += item[:12] + sentence(draw, 5)
    text += item + sentence(draw, 9)
    (leak,), = items.leaks([" ".join(text)])
    assert leak["score"] == 1 and leak["word_from"] == 200 * 17


def test_passages_of_long_items(spark):
    """Words of a 500-word item, unaltered or edited, wherever they stand, also when many texts have them."""
    draw = random.Random(5)
    item = sentence(draw, 500)
    part = {1: item[100:300], 2: item[:13], 3: item[-13:], 4: item[40:52], 5: item[7:10] + sentence(draw, 9) + item[90:93],
            6: [w if p % 6 else "edited" for p, w in enumerate(item[200:260])]}
    part |= {i: item[300:320] for i in range(10, 40)}
    texts = [(i, " ".join(sentence(draw, 80) + p + sentence(draw, 50))) for i, p in part.items()]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    found = {r["doc_id"]: r["leaks"] for r in op.with_leaks(docs, bench).select("_row.doc_id", "leaks").collect()}
    assert {i for i, leaks in found.items() if leaks} == set(part) - {4, 5}
    (leak,) = found[1]
    assert leak["score"] == 1 and (leak["word_from"], leak["word_to"]) == (80, 280)
    assert {r["doc_id"] for r in op.drop_leaks(docs, bench).collect()} == {4, 5}


def test_shared_prompt_and_long_item():
    """4,000 items that begin alike, texts that repeat the beginning, and an item of 20,000 words: in
    bounded memory, and with the items that are there still found."""
    draw = random.Random(8)
    prompt = "answer the following question with one of the words".split()
    items = [(k, " ".join(prompt + sentence(draw, 12))) for k in range(4000)]
    long_item = sentence(draw, 20_000)
    part = op.Items.of([*items, (9999, " ".join(long_item))])
    counts = dict.fromkeys(part.keys(np.array([part.numbers[w.encode()] for w in prompt])).tolist(), 5000)
    part.mark_rare(counts)
    repeated = " ".join(prompt * 300)
    texts = [repeated + " " + items[k][1] for k in (7, 70, 700)] + [repeated] * 9
    edited = [w if p % 7 else "other" for p, w in enumerate(items[77][1].split())]
    texts += [" ".join(sentence(draw, 50) + edited), " ".join(long_item), " ".join(long_item[5000:5200])]
    tracemalloc.start()
    start = time.monotonic()
    leaks = part.leaks(texts)
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert [{x["item_id"] for x in found} for found in leaks] == [{7}, {70}, {700}, *[set()] * 9, {77}, {9999}, {9999}]
    assert most < 400e6 and time.monotonic() - start < 120


def test_recall_of_edited_copies():
    """Of copies with a share of words changed, left out or put in, those that score enough are found."""
    draw = random.Random(9)
    items = [sentence(draw, draw.randrange(14, 60)) for _ in range(300)]
    part = op.Items.of([(k, " ".join(w)) for k, w in enumerate(items)])
    part.mark_rare({})
    due = met = 0
    for k, item in enumerate(items):
        for rate in (0.05, 0.1, 0.2, 0.3):
            copy = []
            for word in item:
                kind = draw.random() / rate
                copy += [] if kind < 1 / 3 else ["edited"] if kind < 2 / 3 else [word, "more"] if kind < 1 else [word]
            text = sentence(draw, 60) + copy + sentence(draw, 60)
            numbers, _ = part.numbered([" ".join(text)])
            if op.align(numbers, part.words[k])[0] >= op.LEAST * op.MATCH * len(item):
                due += 1
                met += any(x["item_id"] == k for x in part.leaks([" ".join(text)])[0])
    assert due > 900 and met / due > 0.98


def test_scripts_without_blanks():
    items = [(1, "日本語の文章をここに書いておきます"), (2, "ประเทศไทยมีอากาศร้อนตลอดทั้งปี"), (3, "seven plain english words stand right here")]
    part = op.Items.of(items)
    part.mark_rare({})
    texts = ["前の文。" + items[0][1] + "、続く", "ก่อน " + items[1][1] + " หลัง", "日本語の文", "a “seven” plain english words stand right here’s"]
    assert [{x["item_id"] for x in found} for found in part.leaks(texts)] == [{1}, {2}, set(), {3}]


def test_unaltered_run_beside_a_better_alignment():
    """An alignment that is long but thin does not hide words that stand there unaltered."""
    item = np.arange(1000)
    thin = np.stack([np.arange(400), np.full(400, -1), np.full(400, -1)][:2], 1).ravel()
    passage = np.r_[thin, np.full(900, -1), item[600:613]]
    assert op.longest_run(passage, item) == (1700, 1713)
    (leak,) = op.found(passage, item, True)
    assert leak[0] >= op.MATCH * op.LONG


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, 2), (None, "", 3)], "doc_id long, text string, leaks int")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [len(r["leaks"]) for r in op.with_leaks(docs, none).collect()] == [0, 0]
    bench = spark.createDataFrame([(5, "one two three four")], "item_id long, text string")
    assert op.drop_leaks(docs, bench).columns == docs.columns and op.drop_leaks(docs, bench).count() == 2
    assert op.drop_leaks(docs.limit(0), bench).collect() == []
