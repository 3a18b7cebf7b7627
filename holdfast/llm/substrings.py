"""Removal of repeated passages: a count-min sketch of windows, then exact groups of what it names."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from holdfast.llm.common import packed, settle, words
from holdfast.llm.entries import entry, table

#: Words of a window, and of the gram that stands for a window in the sketch.
WINDOW = 20
GRAM = 8
#: Width of the sketch in bits: cells are kept sparsely, so a wide sketch costs no more.
WIDTH = 48
#: Words that are hashed at once.
CHUNK = 1 << 17
#: Most bits of the map that tells tasks which cells count twice or more: 128 MB. Beyond it, cells
#: share bits, and more windows are grouped than need be; the result is the same.
MAP_BITS = 30
#: Cells of one part of the map.
PART_BITS = 20
#: Rows that a broadcast table may have; a larger one is joined by shuffle.
BROADCAST = 1 << 20
#: A null id stands before all others.
FIRST = -(1 << 63)
_SPREAD = WINDOW - GRAM + 1


def _slide(values: np.ndarray, width: int, least: bool) -> np.ndarray:
    """Minimum (or maximum) over each run of so many values."""
    take, span = (np.minimum if least else np.maximum), 1
    while 2 * span <= width:
        values = take(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return take(values[: len(values) - rest], values[rest:]) if rest else values


def _runs(values: np.ndarray, width: int, factor: int) -> np.ndarray:
    """A polynomial of each run of so many values, modulo 2^64."""
    out, have = np.zeros(len(values) - width + 1, np.uint64), 0
    power, block, span = factor, values, 1
    while True:
        if width & span:
            # what is ahead is multiplied on, in the order of the run
            part = block[have : have + len(out)]
            out = out * np.uint64(power) + part if have else part.copy()
            have += span
        if span * 2 > width:
            return out
        block = block[:-span] * np.uint64(power) + block[span:]
        power = power * power % (1 << 64)
        span *= 2


def _chunks(texts: list[str | None]) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]]:
    """(words, bounds, text, first): windows of the texts, CHUNK words at a time.

    Part k of the words goes from bounds[k] to bounds[k + 1], belongs to text[k] and begins at its
    word first[k]. Texts under WINDOW words have no part; parts of a longer one overlap by what a
    window needs, so every window is in one part.
    """
    held: list[bytes] = []
    bounds, text, first = [0], [], []
    for i, one in enumerate(texts):
        own = words(one)
        for at in range(0, max(0, len(own) - WINDOW + 1), CHUNK):
            part = own[at : at + CHUNK + WINDOW - 1]
            held += part
            bounds.append(len(held))
            text.append(i)
            first.append(at)
            if len(held) >= CHUNK:
                yield held, np.array(bounds), np.array(text), np.array(first)
                held, bounds, text, first = [], [0], [], []
    if held:
        yield held, np.array(bounds), np.array(text), np.array(first)


def _hashes(held: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each word."""
    both = np.frombuffer(b"".join(map(xxh3_128_digest, held)), ">u8").astype(np.uint64)
    return np.ascontiguousarray(both[::2]), np.ascontiguousarray(both[1::2])


def _anchors(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(value of each window's anchor, whether the window is whole, values of anchors, each once).

    The anchor of a window is its gram with the least hash. Equal windows have equal anchors at the
    same place within, so a window that occurs twice has an anchor that occurs twice.
    """
    grams = _runs(hashes, GRAM, 0x9E3779B97F4A7C15) | np.uint64(1)
    least = _slide(grams, _SPREAD, least=True)
    whole = np.ones(len(least), bool)
    for end in bounds[1:-1]:
        whole[max(0, end - WINDOW + 1) : end] = False
    asked = np.where(whole, least, np.uint64(0))
    edge = np.zeros(_SPREAD - 1, np.uint64)
    most = _slide(np.concatenate([edge, asked, edge]), _SPREAD, least=False)
    return least, whole, grams[most == grams]


def _cells(values: np.ndarray) -> np.ndarray:
    mixed = values * np.uint64(0xD6E8FEB86659FD93)
    return (mixed >> np.uint64(64 - WIDTH)).astype(np.int64)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition's sketch, sparsely: cells with their counts."""
    for batch in batches:
        for held, bounds, _, _ in _chunks(batch["text"].to_pylist()):
            cell, n = np.unique(_cells(_anchors(_hashes(held)[0], bounds)[2]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(n)], names=["cell", "n"])


def _map_parts(bits: int):
    """(part, bits) for each part of the map that cells of a partition are in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 1 << min(bits, PART_BITS)
        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            place = batch["cell"].to_numpy() >> (WIDTH - bits)
            for part in np.unique(place // size):
                held = parts.setdefault(int(part), np.zeros(size, bool))
                held[place[place // size == part] % size] = True
        for part, held in parts.items():
            packed_bits = np.packbits(held, bitorder="little").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([packed_bits])], names=["part", "bits"])

    return run


def _cell_map(cells: DataFrame) -> tuple[np.ndarray, int]:
    """A bit for each value of a cell's first bits: set if a cell that begins so is in the table.

    About sixteen bits a cell, at most 2 ** MAP_BITS. Tasks make the parts, the driver joins them.
    """
    bits = min(MAP_BITS, max(10, (16 * cells.count()).bit_length()))
    size = 1 << min(bits, PART_BITS)
    part = F.shiftright("cell", WIDTH - bits + min(bits, PART_BITS))
    made = cells.repartition(part).mapInArrow(_map_parts(bits), "part long, bits binary")
    whole = np.zeros((1 << bits) // 8, np.uint8)
    for row in made.toLocalIterator():
        whole[row["part"] * size // 8 : (row["part"] + 1) * size // 8] |= np.frombuffer(row["bits"], np.uint8)
    return whole, bits


def _window_rows(shipped, bits: int):
    """(d1, d2, o, row, start) for each window whose anchor's cell is in the map: a 128-bit hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shipped.value
        for batch in batches:
            row, order = batch["row"].to_numpy(), batch["o"].to_numpy()
            for held, bounds, text, first in _chunks(batch["text"].to_pylist()):
                one, two = _hashes(held)
                value, whole, _ = _anchors(one, bounds)
                place = _cells(value) >> (WIDTH - bits)
                at = np.flatnonzero(whole & (known[place >> 3] >> (place & 7) & 1).astype(bool))
                d1 = _runs(one, WINDOW, 0xBF58476D1CE4E5B9)[at]
                d2 = _runs(two, WINDOW, 0x94D049BB133111EB)[at]
                part = np.searchsorted(bounds, at, side="right") - 1
                owner, start = text[part], at - bounds[part] + first[part]
                columns = [d1.view(np.int64), d2.view(np.int64), order[owner], row[owner], start]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns], names=["d1", "d2", "o", "row", "start"]
                )

    return run


def _is_small(side: DataFrame) -> bool:
    return side.offset(BROADCAST).isEmpty()


def _copies(rows: DataFrame) -> DataFrame:
    """(o, t1, t2): rows whose whole text a smaller id has too."""
    keys = settle(rows.select("o", "t1", "t2"), "texts")
    firsts = keys.groupBy("t1", "t2").agg(F.min("o").alias("least"), F.count("*").alias("n")).where("n > 1")
    return settle(keys.join(firsts, ["t1", "t2"]).where("o > least").select("o", "t1", "t2").distinct(), "copies")


def repeated_runs(base: DataFrame) -> DataFrame:
    """(o, row, runs): words (start, end) covered by windows that also start earlier.

    base: (o, row, text). Windows are 20 consecutive words. Partitions sketch how often anchors of
    windows occur and the sketches are added up. A map of the cells that count twice goes to all
    tasks, its size bounded, and windows whose anchor it has are grouped by a hash of all their words,
    128 bits wide. An estimate is never too low, so no repeated window is lost; one that is too high
    costs a group of one.
    """
    cells = base.select("text").mapInArrow(_sketch, "cell long, n long")
    cells = cells.groupBy("cell").agg(F.sum("n").alias("n")).where("n > 1").select("cell")
    known, bits = _cell_map(settle(cells, "cells"))
    shipped = base.sparkSession.sparkContext.broadcast(known)
    windows = base.select("o", "row", "text").mapInArrow(
        _window_rows(shipped, bits), "d1 long, d2 long, o long, row long, start long"
    )
    here = F.struct("o", "start")
    firsts = windows.groupBy("d1", "d2").agg(F.min(here).alias("least"), F.count("*").alias("n"))
    # Written first, so that a window found very often can be split among tasks in the join.
    firsts = settle(firsts.where("n > 1").drop("n"), "firsts")
    again = windows.join(firsts, ["d1", "d2"]).where(here > F.col("least"))
    starts = again.groupBy("o", "row").agg(F.sort_array(F.collect_set("start")).alias("starts"))
    return settle(starts.select("o", "row", _covered("starts").alias("runs")), "runs")


def _covered(starts: str) -> Column:
    """Sorted window starts as runs (start, end) of the words they cover."""
    run = "struct<start:bigint,end:bigint>"
    none = F.from_json(F.lit('{"runs":[],"open":null}'), f"struct<runs:array<{run}>,open:{run}>")

    def step(state: Column, start: Column) -> Column:
        end = start + WINDOW
        joins = start <= state["open"]["end"]
        begin = F.when(joins, state["open"]["start"]).otherwise(start)
        done = F.when(joins | state["open"].isNull(), state["runs"]).otherwise(
            F.array_append(state["runs"], state["open"])
        )
        return F.struct(done.alias("runs"), F.struct(begin.alias("start"), end.alias("end")).alias("open"))

    return F.aggregate(starts, none, step, lambda state: F.array_append(state["runs"], state["open"]))


_CUT = pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])


def _cut(texts: pa.Array, runs: pa.Array, is_copy: pa.Array) -> pa.Array:
    out = []
    for text, run, copy in zip(texts, runs, is_copy, strict=True):
        own = words(text.as_py())
        kept = own
        if copy.as_py() and len(own) >= WINDOW:
            kept = []
        elif run.is_valid:
            kept, at = [], 0
            for r in run.as_py():
                kept += own[at : r["start"]]
                at = r["end"]
            kept += own[at:]
        out.append({"n_words": len(own), "n_removed": len(own) - len(kept), "kept": b" ".join(kept).decode()})
    return pa.array(out, _CUT)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """All columns in ``_row``, with n_words, n_removed and kept: the words left, joined by a space.

    A word goes if a window over it, 20 words of one document, also starts earlier: in a smaller
    doc_id, or earlier in the same document. Windows are judged on the input. Null and short texts
    keep all they have. A null id is the smallest. Rows with equal id and text are one document;
    rows with equal id and other texts are told apart, and the earlier start among them stays.
    """
    rows = packed(docs).withColumn("text", F.col("_row.text").cast("string"))
    rows = rows.withColumn("o", F.coalesce(F.col("_row.doc_id").cast("long"), F.lit(FIRST)))
    rows = rows.withColumns({
        "t1": F.xxhash64("text"),
        "t2": F.xxhash64(F.lit(2), "text"),
        "row": F.xxhash64("o", "text"),
    })
    # A whole copy goes in any case, and its windows start earlier elsewhere, so they need no look.
    # That only saves work: copies beyond the bound of a broadcast are looked at like all others.
    base = rows.where("text is not null").select("o", "row", "text", "t1", "t2")
    copies = _copies(base)
    if _is_small(copies):
        base = base.join(F.broadcast(copies), ["o", "t1", "t2"], "left_anti")
    else:
        copies = copies.limit(0)
    runs = repeated_runs(base.select("o", "row", "text"))
    rows = rows.join(F.broadcast(runs) if _is_small(runs) else runs, ["o", "row"], "left")
    rows = rows.join(F.broadcast(copies.withColumn("is_copy", F.lit(True))), ["o", "t1", "t2"], "left")
    cutter = F.arrow_udf(_cut, "struct<n_words:bigint,n_removed:bigint,kept:string>")
    cut = rows.select("_row", cutter("text", "runs", F.coalesce("is_copy", F.lit(False))).alias("cut"))
    return cut.select("_row", "cut.n_words", "cut.n_removed", "cut.kept")


SQL = r"""
with texts as materialized (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
),
windows as materialized (
  select doc_id, s, array_to_string(list_slice(w, s, s + 19), ' ') as seq
  from texts, unnest(range(1, len(w) - 18)) r(s)
),
ranked as (
  select doc_id, s, row_number() over (partition by seq order by doc_id, s) as place from windows
),
gone as (
  select distinct doc_id, s + k as p from ranked, range(0, 20) r(k) where place > 1
),
words as (
  select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as p from texts
),
kept as (
  select doc_id, count(*) as n, string_agg(word, ' ' order by p) as text
  from words anti join gone using (doc_id, p) group by doc_id
)
select t.doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed,
  sha256(coalesce(text, '')) as kept_sha256
from texts t left join kept k on k.doc_id = t.doc_id
"""


@entry("op3_substrings", SQL)
def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        F.col("_row.doc_id").alias("doc_id"),
        "n_words",
        "n_removed",
        F.sha2("kept", 256).alias("kept_sha256"),
    )
