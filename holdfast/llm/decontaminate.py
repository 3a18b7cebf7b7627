"""Benchmark passages in training text: rare n-gram seeds, then Smith-Waterman alignment."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm.common import packed, settle
from holdfast.llm.entries import entry, table

#: Words of a seed.
SEED = 3
#: Share of the seeds of each STRETCH of an item that count as rare: all but those the corpus has most
#: often. A passage of a long item has rare seeds like a whole short one.
RARE = 0.9
STRETCH = 40
#: Seeds near each other, one of them rare, that call for an alignment; items under SHORT words need
#: a rare one only. A copy that has over a tenth of an item's seeds, and two, is never missed.
HITS, SHORT = 2, 12
#: Words of an item that are a leak however long the item is, if they stand in a text unaltered or
#: their alignment scores as many matches.
LONG = 13
#: Alignment scores, per word.
MATCH, MISMATCH, GAP = 2, -1, -1
#: Least score to report, as a share of the item's score against itself; where the alignment scores
#: LONG matches, as a share of the score that the shorter of aligned words and item could have.
LEAST = 0.5
#: Words of benchmark text that one broadcast may hold; more goes in several passes.
BOUND = 1 << 20
#: Words of a document that are aligned at once.
WINDOW = 4096
#: A seed that more items have does not call for an alignment, if half of the item's seeds are its own.
SHARED = 32
#: Pairs of hits and items that are held at once; a text's own pairs may be more.
PAIRS = 1 << 20
#: ASCII punctuation, which does not count.
_MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum())


#: Scripts that set no blanks between words: Thai, Lao, Myanmar and Khmer; kana; Han. A character
#: of these is a word. All stand beyond the first bytes E0 to EF of UTF-8, with much else.
_UNSPACED = re.compile(
    "[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]"
)
_FAR = re.compile(rb"[\xe0-\xf4]")


def plain_words(text: str | None) -> list[bytes]:
    """Words in lower case without ASCII punctuation: what both sides are compared by. Of scripts
    without blanks, every character is a word."""
    if not text:
        return []
    data = text.lower().encode()
    if _FAR.search(data):
        data = _UNSPACED.sub(r" \g<0> ", data.decode()).encode()
    return data.translate(None, _MARKS).split()


@dataclass
class Items:
    """Benchmark items as word numbers, and where each seed stands in them."""

    ids: list[int | None]
    numbers: dict[bytes, int]
    words: list[np.ndarray]
    seeds: np.ndarray  # keys, sorted
    first: np.ndarray  # per seed, where its places begin
    item: np.ndarray  # items that have the seed, by seed
    is_rare: np.ndarray  # whether the seed is rare for that item
    stretch: np.ndarray  # which stretch of the item has the seed first, over all items
    long_keys: np.ndarray  # of runs of LONG words, sorted
    long_item: np.ndarray  # an item that has the run

    @classmethod
    def of(cls, rows: list[tuple[int | None, str | None]]) -> Items:
        numbers: dict[bytes, int] = {}
        texts = [[numbers.setdefault(w, len(numbers)) for w in plain_words(t)] for _, t in rows]
        words = [np.array(t, np.int64) for t in texts]
        items = cls([i for i, _ in rows], numbers, words, *[np.empty(0, np.int64)] * 7)
        runs = [np.unique(run_keys(w)) for w in words]
        items.long_keys = np.concatenate([np.empty(0, np.uint64), *runs])
        order = np.argsort(items.long_keys, kind="stable")
        items.long_keys = items.long_keys[order]
        items.long_item = np.repeat(np.arange(len(runs)), [len(r) for r in runs])[order]
        found = [np.unique(items.keys(w), return_index=True) for w in words]
        keys = [k for k, _ in found]
        key = np.concatenate([np.empty(0, np.int64), *keys])
        order = np.argsort(key, kind="stable")
        before = np.cumsum([0, *(1 + len(w) // STRETCH for w in words)])
        stretches = [at // STRETCH + b for (_, at), b in zip(found, before, strict=False)]
        items.stretch = np.concatenate([np.empty(0, np.int64), *stretches])[order]
        items.item = np.repeat(np.arange(len(keys)), [len(k) for k in keys])[order]
        items.seeds, items.first = np.unique(key[order], return_index=True)
        items.is_rare = np.ones(len(key), bool)
        return items

    def keys(self, words: np.ndarray) -> np.ndarray:
        """The number of each run of SEED words; -1 where a word is in no item."""
        size, n = len(self.numbers) + 1, max(0, len(words) - SEED + 1)
        key, known = np.zeros(n, np.int64), np.ones(n, bool)
        for k in range(SEED):
            part = words[k : k + n]
            key = key * size + part
            known &= part >= 0
        return np.where(known, key, -1)

    def mark_rare(self, counts: dict[int, int]) -> None:
        """Mark, of each stretch of each item, the share RARE of its seeds that the corpus has least
        often; of these only the item's own, shared by few, if they are half of its seeds or more."""
        often = np.array([counts.get(int(k), 0) for k in self.seeds], np.int64)
        many = np.diff(np.r_[self.first, len(self.item)])
        often = np.repeat(often, many)
        order = np.lexsort((often, self.stretch))
        held = np.bincount(self.stretch)
        inside = np.arange(len(order)) - np.repeat(np.cumsum(held) - held, held)
        self.is_rare = np.zeros(len(order), bool)
        self.is_rare[order] = inside < np.ceil(RARE * np.repeat(held, held))
        sizes = np.bincount(self.item, minlength=len(self.words))
        own = self.is_rare & (np.repeat(many, many) <= SHARED)
        most_own = 2 * np.bincount(self.item[own], minlength=len(self.words)) >= sizes
        self.is_rare = np.where(most_own[self.item], own, self.is_rare)

    def numbered(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The word numbers of all texts (-1: in no item), and where each text begins."""
        get = self.numbers.get
        found = [plain_words(t) for t in texts]
        starts = np.cumsum([0, *map(len, found)])
        flat = (w for words in found for w in words)
        return np.fromiter(map(get, flat, repeat(-1)), np.int64, starts[-1]), starts

    def hits(self, numbers: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position, seed, text) of each seed in the texts."""
        keys = self.keys(numbers)
        at = np.flatnonzero(keys >= 0)
        text = np.searchsorted(starts, at, side="right") - 1
        whole = at + SEED <= starts[text + 1]
        at, text = at[whole], text[whole]
        if not len(at) or not len(self.seeds):
            return at[:0], at[:0], at[:0]
        seed = np.minimum(np.searchsorted(self.seeds, keys[at]), len(self.seeds) - 1)
        same = self.seeds[seed] == keys[at]
        return at[same], seed[same], text[same]

    def count(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Seeds in the texts and how often each occurs."""
        _, seed, _ = self.hits(*self.numbered(texts))
        found, counts = np.unique(seed, return_counts=True)
        return self.seeds[found], counts

    def leaks(self, texts: list[str | None]) -> list[list[dict]]:
        """For each text, the items it holds: best alignment of each that scores enough.

        Hits of rare seeds meet the items they are rare for, and runs of LONG words those that have
        them: so many texts at a time as give PAIRS of such pairs.
        """
        numbers, starts = self.numbered(texts)
        at, seed, text = self.hits(numbers, starts)
        out: list[list[dict]] = [[] for _ in texts]
        rare = np.flatnonzero(self.is_rare)
        of_seed = np.repeat(np.arange(len(self.seeds)), np.diff(np.r_[self.first, len(self.item)]))[rare]
        begins, ends = (np.searchsorted(of_seed, seed, side) for side in ("left", "right"))
        run_at, run_key = self.runs(numbers, starts)
        run_text = np.searchsorted(starts, run_at, side="right") - 1
        run_begins, run_ends = (np.searchsorted(self.long_keys, run_key, side) for side in ("left", "right"))
        weight = np.bincount(text, ends - begins, len(texts)) + np.bincount(run_text, run_ends - run_begins, len(texts))
        total = np.cumsum(weight)
        low = 0
        while low < len(texts):
            done = total[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(total, done + PAIRS, side="right")))
            part = slice(*np.searchsorted(text, [low, high]))
            run_part = slice(*np.searchsorted(run_text, [low, high]))
            place, item = _spread(at[part], begins[part], ends[part], self.item[rare])
            run_place, run_item = _spread(run_at[run_part], run_begins[run_part], run_ends[run_part], self.long_item)
            is_run = np.repeat([False, True], [len(place), len(run_place)])
            place, item = np.r_[place, run_place], np.r_[item, run_item]
            self._align(out, numbers, starts, at, seed, place, item, is_run)
            low = high
        return out

    def runs(self, numbers: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, key) of the runs of LONG words in the texts that may be some item's."""
        key = run_keys(numbers)
        if not len(key) or not len(self.long_keys):
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        near = np.minimum(np.searchsorted(self.long_keys, key), len(self.long_keys) - 1)
        at = np.flatnonzero(self.long_keys[near] == key)
        at = at[at + LONG <= starts[np.searchsorted(starts, at, side="right")]]
        return at, key[at]

    def _align(self, out, numbers, starts, at, seed, place, item, is_run) -> None:
        """Align what stands around the places where an item was met, and note what scores enough."""
        text = np.searchsorted(starts, place, side="right") - 1
        order = np.lexsort((place, item, text))
        here, item, place, is_run = text[order], item[order], place[order], is_run[order]
        sizes = np.array([len(w) for w in self.words] or [0])
        new = np.r_[True, (here[1:] != here[:-1]) | (item[1:] != item[:-1]) | (np.diff(place) > 2 * sizes[item[1:]])]
        cuts = np.r_[np.flatnonzero(new[: len(place)]), len(place)]
        own: dict[int, np.ndarray] = {}
        best: dict[tuple[int, int], tuple[int, float, int, int]] = {}
        for a, b in zip(cuts, cuts[1:], strict=False):
            t, i = int(here[a]), int(item[a])
            size = int(sizes[i])
            low = max(starts[t], place[a] - 2 * size)
            high = min(starts[t + 1], place[b - 1] + SEED + 2 * size)
            run = bool(is_run[a:b].any())
            if not run and size >= SHORT:
                # any other of the item's seeds nearby will do
                if i not in own:
                    own[i] = np.unique(self.keys(self.words[i]))
                near = slice(*np.searchsorted(at, [low, high]))
                if np.isin(np.unique(self.seeds[seed[near]]), own[i]).sum() < HITS:
                    continue
            for start in range(low, max(low + 1, high - 4 * size), WINDOW):
                passage = numbers[start : min(high, start + WINDOW + 4 * size)]
                for score, share, begin, end in found(passage, self.words[i], run):
                    if score > best.get((t, i), (0, 0.0, 0, 0))[0]:
                        best[t, i] = score, share, int(start + begin - starts[t]), int(start + end - starts[t])
        for (t, i), (_, share, begin, end) in best.items():
            out[t].append({"item_id": self.ids[i], "score": share, "word_from": begin, "word_to": end})


def _spread(at: np.ndarray, begins: np.ndarray, ends: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, item) for each position and the items that stand between its begin and end."""
    many = ends - begins
    inside = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    return np.repeat(at, many), items[np.repeat(begins, many) + inside]


def run_keys(words: np.ndarray) -> np.ndarray:
    """A hash of each run of LONG words; what hashes alike is compared word by word later on."""
    n = max(0, len(words) - LONG + 1)
    key = np.zeros(n, np.uint64)
    for k in range(LONG):
        key = (key + words[k : k + n].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key


def found(passage: np.ndarray, item: np.ndarray, run: bool) -> list[tuple[int, float, int, int]]:
    """(score, share, first word, end) of what is to be reported of an item in a passage: none or one.

    The best alignment, if it scores enough of the whole item, the share then being that; or enough of
    the shorter of aligned words and item. Else, if there can be one (run), the longest unaltered run.
    """
    score, begin, end = align(passage, item)
    if score >= LEAST * MATCH * len(item):
        return [(score, score / (MATCH * len(item)), begin, end)]
    share = score / (MATCH * max(1, min(end - begin, len(item))))
    if score >= MATCH * LONG and share >= LEAST:
        return [(score, share, begin, end)]
    begin, end = longest_run(passage, item) if run else (0, 0)
    return [(MATCH * (end - begin), 1.0, begin, end)] if end - begin >= LONG else []


def longest_run(passage: np.ndarray, item: np.ndarray) -> tuple[int, int]:
    """Where in the passage the longest run of words stands that the item has too, unaltered."""
    length, best, end = np.zeros(len(passage) + 1, np.int64), 0, 0
    for word in item:
        length[1:] = np.where(passage == word, length[:-1] + 1, 0)
        at = int(length.argmax())
        if length[at] > best:
            best, end = int(length[at]), at
    return end - best, end


def _rows(passage: np.ndarray, item: np.ndarray, local: bool) -> Iterator[np.ndarray]:
    """The score matrix a row at a time, one row held: gaps along the row are a running maximum.

    local: an alignment may begin anywhere. Otherwise it begins where both begin.
    """
    n = len(passage)
    step = np.arange(n + 1, dtype=np.int32) * -GAP
    row = np.zeros(n + 1, np.int32) if local else -step
    yield row
    for word in item:
        new = row + GAP
        new[1:] = np.maximum(new[1:], row[:-1] + np.where(passage == word, MATCH, MISMATCH).astype(np.int32))
        if local:
            np.maximum(new, 0, out=new)
        new += step
        np.maximum.accumulate(new, out=new)
        new -= step
        row = new
        yield row


def align(passage: np.ndarray, item: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment of two word sequences: (score, first word of the passage, end).

    Two passes that hold a row each: the first finds the score and where it is reached first; the
    second goes back from there and finds the nearest begin that gives it.
    """
    score, end, upto = 0, 0, 0
    for i, row in enumerate(_rows(passage, item, True)):
        at = int(row.argmax())
        if row[at] > score:
            score, end, upto = int(row[at]), at, i
    if not score:
        return 0, 0, 0
    span = end
    # a matched word scores MATCH, every other word of the passage costs a GAP at least
    reach = min(end, upto + (MATCH * upto - score) // -GAP)
    for row in _rows(passage[end - reach : end][::-1], item[:upto][::-1], False):
        there = np.flatnonzero(row == score)
        if len(there):
            span = min(span, int(there[0]))
    return score, end - span, end


def _items(benchmark: DataFrame) -> DataFrame:
    rows = benchmark.select(benchmark["item_id"].cast("long"), benchmark["text"].cast("string"))
    return rows.toDF("item_id", "text").where("text is not null")


def _parts(benchmark: DataFrame) -> int:
    """How many lists the items go out in: as many as keep each near BOUND words."""
    # a character of a script without blanks is a word of three bytes
    size = F.greatest(F.size(F.split("text", r"\s+")), F.octet_length("text") - F.length("text"))
    words = _items(benchmark).agg(F.sum(size)).first()[0] or 0
    return math.ceil(words / BOUND)


def _list(benchmark: DataFrame, part: int, parts: int) -> list[tuple[int | None, str | None]]:
    """One list of items, of at most about BOUND words; a single longer item stands in one, too."""
    own = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    rows = _items(benchmark).where(own == part).collect()
    return sorted(((r[0], r[1]) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def _counted(spark: SparkSession, texts: DataFrame, benchmark: DataFrame, part: int, parts: int):
    """The broadcast of one list of items, their rare seeds marked."""
    items = Items.of(_list(benchmark, part, parts))
    plain = spark.sparkContext.broadcast(items)
    counts = texts.mapInArrow(_counter(plain), "seed long, n long")
    items.mark_rare({r["seed"]: r["n"] for r in counts.groupBy("seed").agg(F.sum("n").alias("n")).collect()})
    plain.unpersist()
    return spark.sparkContext.broadcast(items)


_LEAKS = "array<struct<item_id:bigint,score:double,word_from:bigint,word_to:bigint>>"
_ARROW_LEAKS = pa.list_(
    pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("word_from", pa.int64()), ("word_to", pa.int64())])
)


def _counter(shipped):
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seed, n = shipped.value.count(batch["text"].to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(seed), pa.array(n)], names=["seed", "n"])

    return counted


def _finder(shipped):
    @F.arrow_udf(_LEAKS)
    def leaks(texts: pa.Array) -> pa.Array:
        return pa.array(shipped.value.leaks(texts.to_pylist()), _ARROW_LEAKS)

    return leaks.asNondeterministic()  # else a filter on the result would find it a second time


def with_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """All columns in ``_row``, with ``leaks``: (item_id, score, word_from, word_to) per item found.

    Two passes over the documents. The first counts, over all of them, the runs of SEED words that
    benchmark items have; that tells which seeds of an item are rare. The second joins passages to
    items by their seeds and aligns them. word_from and word_to number words without punctuation.

    The benchmark goes to the tasks in lists of at most BOUND words, one after the other if there are
    more, and what each list finds is written before the next goes out; what the driver gets is a list
    and a count for each of its seeds. Null and empty texts have no leaks; items under SEED
    words are never reported. Repeated rows, items and ids give a result each.

    Reported is an item whose best alignment scores LEAST of the item, and, however long the item, a
    passage of it: LONG unaltered words, or an alignment of as high a score that is dense (LEAST of the
    shorter of aligned words and item, which then is the score given). A passage without LONG unaltered
    words is aligned if it has seeds that are rare, as for whole items.
    """
    spark = docs.sparkSession
    texts = docs.select(docs["text"].cast("string").alias("text")).where("text is not null")
    rows = packed(docs)
    parts = _parts(benchmark)
    if parts == 1:
        shipped = _counted(spark, texts, benchmark, 0, 1)
        return rows.select("_row", _finder(shipped)(F.col("_row.text").cast("string")).alias("leaks"))
    both = lambda text: [F.xxhash64(text).alias("_h1"), F.xxhash64(F.lit(1), text).alias("_h2")]
    none = F.array().cast(_LEAKS)
    found = None
    for part in range(parts):
        shipped = _counted(spark, texts, benchmark, part, parts)
        leaks = texts.select(*both(F.col("text")), _finder(shipped)("text").alias("leaks"))
        leaks = settle(leaks.where(F.size("leaks") > 0).dropDuplicates(["_h1", "_h2"]), "leaks")
        found = leaks if found is None else found.unionAll(leaks)
        shipped.unpersist()
    if found is None:
        return rows.select("_row", none.alias("leaks"))
    found = found.groupBy("_h1", "_h2").agg(F.flatten(F.collect_list("leaks")).alias("leaks"))
    keyed = rows.select("_row", *both(F.col("_row.text").cast("string")))
    joined = keyed.join(found, ["_h1", "_h2"], "left")
    leaks = F.when(F.col("_row.text").isNotNull(), F.col("leaks"))
    return joined.select("_row", F.coalesce(leaks, none).alias("leaks"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that hold no benchmark item or long passage of one. All columns are kept."""
    return with_leaks(docs, benchmark).where(F.size("leaks") == 0).select("_row.*")


@entry("op8_decontaminate")
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = with_leaks(docs, table(spark, sf_dir, "benchmark"))
    found = found.select(F.col("_row.doc_id").alias("doc_id"), F.explode("leaks").alias("leak"))
    return found.select("doc_id", "leak.*")
