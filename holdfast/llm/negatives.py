"""Hard negatives: rows of other labels whose score lies in a window below that of each positive."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from holdfast.llm.common import numbered, settle
from holdfast.llm.entries import entry, table
from holdfast.workspace import new_path

#: Anchors are the rows whose id this divides.
ANCHORS = 100
POSITIVES = 5
NEGATIVES = 10
#: A negative's score lies between these percentages of the positive's.
LOW, HIGH = 30, 90
#: Bytes of anchors that go out at once; there is a pass over the rows for each such slice.
SLICE_BYTES = 16 << 20
#: Anchors in a slice at most: bounds what a task keeps, wherever vectors are short.
SLICE = 8192
#: Scores that a task holds at once.
SCORES = 1 << 20
#: Scores saturate here, so that a hundred of one fits a long.
MOST = 1 << 56
_LEAST = -(1 << 62)
RESULT = (
    "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
)


def _whole(vector: Column, scale: int) -> Column:
    """Components as whole numbers: floor(scale * x) in doubles."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def _usable(rows: DataFrame, scale: int) -> DataFrame:
    """(vec_id, label, vector) of the rows that take part."""
    found = rows.select(
        rows["vec_id"].cast("long").alias("vec_id"),
        rows["label"].cast("string").alias("label"),
        rows["embedding"].alias("vector"),
    )
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    found = found.where("label is not null and vector is not null").where(~bad)
    return found.withColumn("vector", _whole(F.col("vector"), scale))


def _stacked(vectors: pa.Array, width: int) -> np.ndarray:
    """A row for each vector, short ones filled up with zeros, long ones cut to the width."""
    sizes = np.diff(vectors.offsets.to_numpy())
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    place = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out = np.zeros((len(sizes), width), np.int64)
    inside = place < width
    out[row[inside], place[inside]] = values[inside]
    return out


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of a with all of b, in longs that saturate at MOST.

    In doubles where every sum is exact, else in longs, else in Python's whole numbers.
    """
    top = [int(max(abs(int(x.min(initial=0))), int(x.max(initial=0)))) for x in (a, b)]
    bound = top[0] * top[1] * max(1, a.shape[1])
    if bound < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if bound < 1 << 62:
        return np.clip(a @ b.T, -MOST, MOST)
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, -MOST, MOST).astype(np.int64)


class Best:
    """The best k rows of each slot: by score, then by the smaller id. Memory is slots times k."""

    def __init__(self, slots: int, k: int) -> None:
        self.score = np.full((slots, k), _LEAST, np.int64)
        self.id = np.full((slots, k), np.iinfo(np.int64).max, np.int64)

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Offers, sorted by slot or not. Those that cannot enter are dropped first."""
        k = self.score.shape[1]
        last = self.score[slot, -1]
        enters = (score > last) | ((score == last) & (ids < self.id[slot, -1]))
        slot, score, ids = slot[enters], score[enters], ids[enters]
        if not len(slot):
            return
        met = np.unique(slot)
        slot = np.concatenate([np.repeat(met, k), slot])
        score = np.concatenate([self.score[met].ravel(), score])
        ids = np.concatenate([self.id[met].ravel(), ids])
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        first = np.searchsorted(slot, met)
        place = np.arange(len(slot)) - np.repeat(first, np.diff(np.r_[first, len(slot)]))
        keep = place < k
        self.score[slot[keep], place[keep]] = score[keep]
        self.id[slot[keep], place[keep]] = ids[keep]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        slot, place = np.nonzero(self.score > _LEAST)
        return slot, self.score[slot, place], self.id[slot, place]


class Anchors:
    """A slice of the anchors as arrays, with the upper ends of their slots once those are known."""

    def __init__(self, found: pa.Table) -> None:
        vectors = found["vector"].combine_chunks()
        self.number = found["number"].to_numpy()
        self.id = found["vec_id"].to_numpy()
        self.row = found["row"].to_numpy()
        self.label = np.array(found["label"].to_pylist(), object)
        width = int(np.diff(vectors.offsets.to_numpy()).max(initial=0))
        self.vector = _stacked(vectors, width)
        self.upper = np.zeros((len(self.id), 0), np.int64)

    def __len__(self) -> int:
        return len(self.id)


def _best_rows(shared, k: int, positive: bool):
    """Of each task's rows, the best k for each slot of each anchor of a slice.

    Positives have one slot an anchor. Negatives have a slot for each positive: it ends at the
    positive's upper limit and begins above the next one's, so a row falls into one slot only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = shared.value
        slots = 1 if positive else anchors.upper.shape[1]
        best = Best(len(anchors) * slots, k)
        code = {label: i for i, label in enumerate(dict.fromkeys(anchors.label))}
        own = np.array([code[x] for x in anchors.label], np.int64)
        for batch in batches:
            labels = batch["label"].dictionary_encode()
            known = np.array([code.get(x, -1) for x in labels.dictionary.to_pylist()], np.int64)
            label = known[labels.indices.to_numpy()]
            ids, rows = batch["vec_id"].to_numpy(), batch["row"].to_numpy()
            vectors = _stacked(batch["vector"], anchors.vector.shape[1])
            step = max(1, SCORES // len(anchors))
            for at in range(0, len(ids), step):
                part = slice(at, at + step)
                scores = inner(anchors.vector, vectors[part])
                same = own[:, None] == label[None, part]
                if positive:
                    fits = same & (anchors.row[:, None] != rows[None, part])
                    slot = np.zeros(scores.shape, np.int64)
                else:
                    # slot j: at most upper j, above upper j + 1
                    slot = (scores[:, None, :] <= anchors.upper[:, :, None]).sum(axis=1) - 1
                    fits = ~same & (slot >= 0)
                a, r = np.nonzero(fits)
                best.add(a * slots + slot[a, r], scores[a, r], ids[part][r])
        slot, score, found = best.rows()
        columns = [anchors.number[slot // slots], slot % slots, score, found]
        yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["number", "slot", "score", "id"])

    return run


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The best k of each slot over all tasks: (number, slot, best), best first.

    The window keeps k rows of a slot on either side of its shuffle, so only such lists are gathered.
    """
    place = F.row_number().over(Window.partitionBy("number", "slot").orderBy(F.desc("score"), "id"))
    top = found.withColumn("place", place).where(F.col("place") <= k)
    one = F.struct((-F.col("score")).alias("less"), F.col("id"))
    return top.groupBy("number", "slot").agg(F.array_sort(F.collect_list(one)).alias("best"))


def _slices(anchors: DataFrame) -> Iterator[Anchors]:
    """The numbered anchors, so many at a time as fit SLICE_BYTES."""
    shape = anchors.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("width")).first()
    size = max(1, min(SLICE, SLICE_BYTES // (8 * max(1, shape["width"] or 1))))
    for first in range(0, shape["n"], size):
        inside = (F.col("number") > first) & (F.col("number") <= first + size)
        yield Anchors(anchors.where(inside).toArrow())


def hard_negatives(
    rows: DataFrame,
    anchors: int = ANCHORS,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: int = 256,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) per hard negative.

    rows: vec_id, label, embedding; other columns are not read. Rows with a null label or vector, or
    a null or non-finite component, take no part; a null id is neither an anchor nor offered. A
    component x counts as floor(scale * x); a vector shorter than its anchor counts as if filled up
    with zeros, what is longer is not looked at. Scores are exact inner products; they saturate at
    2^56. Higher scores come first, ties by the smaller id. Anchors are the rows whose id ``anchors``
    divides; repeated rows are anchors, positives and negatives of their own, and come out as often.
    An anchor's positives are its first other rows of its label; for each, the first rows of other
    labels come out whose score lies between the two percentages of the positive's. Anchors without
    positives, windows without rows and empty tables give no row.

    Anchors go out in slices of bounded size, with two passes over the rows for each: one for the
    positives, one for the negatives. Positives' upper limits cut the scores into slots that do not
    overlap; tasks keep the best of each slot, and merging slots downwards from each limit answers
    all windows, however they overlap. A slice's results are written before the next begins.
    """
    spark = rows.sparkSession
    usable = _usable(rows, scale).where("vec_id is not null")
    usable = settle(usable.withColumn("row", F.monotonically_increasing_id()), "rows")
    asked = usable.where(F.col("vec_id") % anchors == 0)
    asked = settle(numbered(asked, [F.col("vec_id").asc(), F.col("row").asc()], "anchors"), "anchors")
    kind = "number long, slot long, score long, id long"
    path, part = new_path(spark, "negatives"), -1
    for part, some in enumerate(_slices(asked)):
        shared = spark.sparkContext.broadcast(some)
        best = _merged(usable.mapInArrow(_best_rows(shared, positives, True), kind), positives)
        best = settle(best.drop("slot").withColumnRenamed("best", "positives"), "positives")
        some.upper = _limits(some, best.toArrow(), positives, high)  # a slice's positives: bounded
        shared.unpersist()
        shared = spark.sparkContext.broadcast(some)
        slots = _merged(usable.mapInArrow(_best_rows(shared, negatives, False), kind), negatives)
        slots = slots.groupBy("number").agg(F.map_from_entries(F.collect_list(F.struct("slot", "best"))).alias("slots"))
        ids = asked.select("number", F.col("vec_id").alias("anchor_id"))
        answer = best.join(slots, "number").join(ids, "number")
        _windows(answer, positives, negatives, low).write.parquet(f"{path}/part={part}")
        shared.unpersist()
    if part < 0:
        return spark.createDataFrame([], RESULT)
    return spark.read.schema(RESULT).parquet(path).select(*[c.split()[0] for c in RESULT.split(", ")])


def _limits(part: Anchors, best: pa.Table, positives: int, high: int) -> np.ndarray:
    """The upper limit of each positive of each anchor, descending; the least where there is none."""
    at = {n: i for i, n in enumerate(part.number.tolist())}
    upper = np.full((len(part), positives), _LEAST, np.int64)
    for number, found in zip(best["number"].to_pylist(), best["positives"].to_pylist(), strict=True):
        for j, one in enumerate(found):
            upper[at[number], j] = -one["less"] * high // 100
    return upper


def _windows(answer: DataFrame, positives: int, negatives: int, low: int) -> DataFrame:
    """A row for each anchor, positive and negative, from the slots of each anchor.

    Slots come best first, so those from j on, one after the other, are the rows under limit j in
    order: the first of them are the window's, as far as they reach its lower end.
    """
    none = F.array().cast("array<struct<less:bigint,id:bigint>>")
    at = lambda k: F.coalesce(F.element_at("slots", F.lit(k).cast("long")), none)
    suffix, merged = none, []
    for j in range(positives - 1, -1, -1):
        suffix = F.slice(F.concat(at(j), suffix), 1, negatives)
        merged.append(suffix)
    answer = answer.withColumn("under", F.array(*merged[::-1]))
    one = answer.select("anchor_id", "under", F.posexplode("positives").alias("j", "positive"))
    # positives with equal scores share a limit: their rows fall into the last of their slots
    window = F.filter(
        F.get("under", F.col("j")), lambda n: -F.col("positive.less") * low <= -n["less"] * 100
    )
    return one.select("anchor_id", "positive", F.posexplode(window).alias("place", "negative")).select(
        "anchor_id",
        F.col("positive.id").alias("positive_id"),
        (F.col("place") + 1).cast("int").alias("rank"),
        F.col("negative.id").alias("negative_id"),
        (-F.col("positive.less")).alias("positive_score"),
        (-F.col("negative.less")).alias("negative_score"),
    )


SQL = """
with rows as materialized (
  select vec_id::bigint as vec_id,
    case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
scores as materialized (
  select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as same,
    list_inner_product(a.v, b.v)::bigint as score
  from rows a, rows b
  where a.vec_id % 100 = 0 and a.vec_id <> b.vec_id
),
positives as (
  select anchor_id, id as positive_id, score as positive_score from scores where same
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5
)
select anchor_id, positive_id,
  (row_number() over (partition by anchor_id, positive_id order by score desc, id))::int as rank,
  id as negative_id, positive_score, score as negative_score
from positives join scores using (anchor_id)
where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
qualify row_number() over (partition by anchor_id, positive_id order by score desc, id) <= 10
"""


@entry("op13_negatives", SQL)
def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved))
