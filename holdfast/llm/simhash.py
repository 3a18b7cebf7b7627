"""Near-duplicate documents by SimHash fingerprints, joined through Gray-order hierarchical indexes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_digest

from holdfast.llm.common import by_batch, connected_components, packed, settle
from holdfast.llm.entries import entry, table

SHINGLE = 3
SEED = 42
DISTANCE = 3
#: Fingerprints that one index may hold. Larger groups are cut by more bits, never short.
GROUP = 2048
#: Children of a node of the index.
FANOUT = 8
#: Hashes whose bits are counted at once.
CHUNK = 1 << 16


def fingerprint(text: str | None) -> int:
    """The 64-bit SimHash of a text, unsigned: words lower-cased in A-Z, three to a shingle.

    A bit is set if more than half of the shingles' hashes have it. Fewer than three words are one
    shingle; no word (or null) gives 0.
    """
    found = text.encode().lower().split() if text else []
    if not found:
        return 0
    count = max(1, len(found) - SHINGLE + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, count, CHUNK):
        part = found[at : at + CHUNK + SHINGLE - 1]
        if len(part) < SHINGLE:
            shingles = [b" ".join(part)]
        else:
            shingles = map(b" ".join, zip(part, part[1:], part[2:], strict=False))
        digests = b"".join([xxh64_digest(s, SEED) for s in shingles])
        bits = np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > count).tobytes(), "big")


def _prints(batch: pa.RecordBatch) -> pa.RecordBatch:
    prints = np.fromiter((fingerprint(t) for t in batch["text"].to_pylist()), np.uint64, len(batch))
    columns = [batch["doc_id"], batch["text_hash"], pa.array(prints.view(np.int64))]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_hash", "fingerprint"])


def with_fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, fingerprint) per row; the fingerprint's 64 bits in a long."""
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.xxhash64(docs["text"]).alias("text_hash"),
        docs["text"].cast("string").alias("text"),
    )
    return by_batch(rows, _prints, "doc_id long, text_hash long, fingerprint long")


def gray_rank(code: Column) -> Column:
    """Where a 64-bit code stands in the Gray sequence: each bit is the parity of those above it."""
    for shift in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, shift))
    return code


def _parts(mask: int, parts: int) -> list[int]:
    """The bits outside a mask, dealt into so many runs of nearly equal length."""
    free = [k for k in range(64) if not mask >> k & 1]
    cuts = [len(free) * i // parts for i in range(parts + 1)]
    runs = (sum(1 << k for k in free[a:b]) for a, b in zip(cuts, cuts[1:], strict=False))
    return [run for run in runs if run]


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def _keyed(codes: DataFrame, masks: dict[int, list[int]]) -> DataFrame:
    """Rows (mask, value, fingerprint): each code under every mask that refines its present one."""
    finer = [(_signed(m), _signed(f)) for m, all_finer in masks.items() for f in all_finer]
    steps = codes.sparkSession.createDataFrame(finer, "mask long, finer long")
    keyed = codes.join(F.broadcast(steps), "mask").withColumn("mask", F.col("finer"))
    value = F.col("fingerprint").bitwiseAND(F.col("mask"))
    return keyed.select("mask", value.alias("value"), "fingerprint")


def _index(codes: np.ndarray, group: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """Levels of the index, leaves first: (mask, pattern, first child, end of children, group).

    A node's mask has the bits in which all leaves below agree; its pattern, those bits' values.
    """
    n = len(codes)
    zero = np.zeros(n, np.int64)
    levels = [(np.full(n, ~np.uint64(0)), codes, zero, zero, group)]
    while True:
        mask, pattern, _, _, group = levels[-1]
        starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        if len(starts) == len(group) and len(levels) > 1:
            return levels
        sizes = np.diff(np.r_[starts, len(group)])
        inside = np.arange(len(group)) - np.repeat(starts, sizes)
        first = np.flatnonzero(inside % FANOUT == 0)
        end = np.r_[first[1:], len(group)]
        both = np.bitwise_and.reduceat(pattern, first), np.bitwise_or.reduceat(pattern, first)
        agreed = np.bitwise_and.reduceat(mask, first) & ~(both[0] ^ both[1])
        levels.append((agreed, both[0] & agreed, first, end, group[first]))


def close_pairs(codes: np.ndarray, group: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j), i < j, of codes of one group that differ in at most so many bits.

    Codes are sorted by group and Gray rank, so neighbours share patterns. The search goes down
    pairs of nodes: the bits that both nodes fix and their parents did not are compared, differences
    add up, and a pair beyond the distance is dropped with everything below it.
    """
    levels = _index(codes, group)
    top = len(levels) - 1
    a = b = np.arange(len(levels[top][0]))
    known = np.zeros(len(a), np.uint64)
    differ = np.zeros(len(a), np.int64)
    for level in range(top, -1, -1):
        mask, pattern, first, end, _ = levels[level]
        both = mask[a] & mask[b]
        differ = differ + np.bitwise_count((pattern[a] ^ pattern[b]) & both & ~known)
        keep = differ <= distance
        a, b, differ, both = a[keep], b[keep], differ[keep], both[keep]
        if level == 0:
            return a, b
        wide_a, wide_b = end[a] - first[a], end[b] - first[b]
        count = wide_a * wide_b
        pair = np.repeat(np.arange(len(a)), count)
        inside = np.arange(len(pair)) - np.repeat(np.cumsum(count) - count, count)
        child_a = first[a][pair] + inside // wide_b[pair]
        child_b = first[b][pair] + inside % wide_b[pair]
        ahead = child_a < child_b if level == 1 else child_a <= child_b
        a, b, pair = child_a[ahead], child_b[ahead], pair[ahead]
        known, differ = both[pair], differ[pair]
    return a, b


def _joined(codes: np.ndarray, group: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A star for each local component: (smallest position, other position)."""
    a, b = close_pairs(codes, group, distance)
    label = np.arange(len(codes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if np.array_equal(new, label):
            other = np.flatnonzero(label != np.arange(len(codes)))
            return label[other], other
        label = new


def _star_rows(distance: int):
    """Links of a partition sorted by (mask, value, Gray rank): whole groups, a few at a time."""

    def linked(keys: np.ndarray, codes: np.ndarray) -> pa.RecordBatch:
        group = np.cumsum(np.r_[0, (keys[1:] != keys[:-1]).any(axis=1)])
        a, b = _joined(codes.view(np.uint64), group, distance)
        return pa.RecordBatch.from_arrays([pa.array(codes[a]), pa.array(codes[b])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, codes = np.empty((0, 2), np.int64), np.empty(0, np.int64)
        for batch in batches:
            new = np.stack([batch["mask"].to_numpy(), batch["value"].to_numpy()], axis=1)
            keys = np.concatenate([keys, new])
            codes = np.concatenate([codes, batch["fingerprint"].to_numpy()])
            starts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            at = 0
            while len(starts) and starts[-1] > at:
                # whole groups up to GROUP rows, at least one
                fit = starts[(starts > at) & (starts <= at + GROUP)]
                to = fit[-1] if len(fit) else starts[starts > at][0]
                yield linked(keys[at:to], codes[at:to])
                at = to
            keys, codes = keys[at:], codes[at:]
        if len(codes):
            yield linked(keys, codes)

    return run


def close_links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of fingerprints within a distance.

    Two codes that differ in at most d bits agree in one of any d + 1 runs of bits. Codes meet under
    each of the d + 1 runs; groups beyond ``GROUP`` are split again by runs of the bits left, until
    each fits one index. A group gives a star per local component rather than its pairs. What is
    broadcast is the table of runs: four rows, and four more for each run that holds a hot group.

    prints: a column ``fingerprint``. Repeats do not matter; an empty table gives no links.
    """
    codes = prints.select("fingerprint").where("fingerprint is not null").distinct()
    codes = settle(codes.withColumn("mask", F.lit(0).cast("long")), "codes")
    masks, found = {0: _parts(0, distance + 1)}, None
    while masks:
        keyed = _keyed(codes, masks)
        sizes = keyed.groupBy("mask", "value").count().where(F.col("count") > GROUP)
        hot = settle(sizes.select("mask", "value"), "hot")
        hot_masks = [r["mask"] & ((1 << 64) - 1) for r in hot.select("mask").distinct().collect()]
        fits = keyed.join(hot, ["mask", "value"], "left_anti") if hot_masks else keyed
        dealt = fits.repartition("mask", "value").withColumn("rank", gray_rank(F.col("fingerprint")))
        dealt = dealt.sortWithinPartitions("mask", "value", "rank")
        stars = dealt.mapInArrow(_star_rows(distance), "a long, b long")
        found = stars if found is None else found.unionAll(stars)
        if hot_masks:
            codes = settle(keyed.join(hot, ["mask", "value"], "left_semi"), "codes")
        masks = {m: [m | p for p in _parts(m, distance + 1)] for m in hot_masks}
    return found


def near_duplicates(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, text_hash, fingerprint, component_id) per row of documents.

    component_id is the smallest doc_id reachable over links of at most ``distance`` bits, the row's
    own included; null only where no linked row has an id. Null and empty texts have fingerprint 0
    and link like any other. Repeated rows and ids give a row each. Only doc_id and text are read.
    """
    prints = settle(with_fingerprints(docs), "fingerprints")
    by_print = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first"))
    labels = connected_components(close_links(prints, distance))
    labels = labels.withColumnRenamed("v", "fingerprint")
    known = settle(by_print.join(labels, "fingerprint", "left"), "known")
    roots = known.where("root is not null").groupBy("root").agg(F.min("first").alias("least"))
    alone = known.where("root is null").select("fingerprint", F.col("first").alias("component_id"))
    known = known.join(roots, "root").select("fingerprint", F.col("least").alias("component_id"))
    known = known.unionAll(alone)
    return prints.join(known, "fingerprint").select(
        "doc_id", "text_hash", "fingerprint", "component_id"
    )


def drop_near_duplicates(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """One document of each group: the row with the smallest doc_id (a null id comes last).

    All columns are kept. Of rows with equal id and text one stays.
    """
    groups = near_duplicates(docs, distance)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    # A group of null ids only has no component_id: its rows meet by fingerprint then.
    meet = F.when(F.col("component_id").isNull(), F.col("fingerprint"))
    stays = groups.groupBy("component_id", meet.alias("_m")).agg(F.min(order).alias("s"))
    stays = settle(
        stays.select(F.col("s.doc_id").alias("_id"), F.col("s.text_hash").alias("_hash")), "stays"
    )
    rows = packed(docs).select(
        "_row", F.col("_row.doc_id").alias("_k"), F.xxhash64("_row.text").alias("_h")
    )
    kept = rows.join(stays, F.col("_k").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_hash")))
    return kept.dropDuplicates(["_id", "_hash"]).select("_row.*")


@entry("op1_simhash")
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_duplicates(table(spark, sf_dir, "documents"))
    text = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return groups.select("doc_id", text.alias("fingerprint"), "component_id")
