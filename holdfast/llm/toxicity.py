"""Toxicity: a linear classifier of character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm.common import packed, settle
from holdfast.llm.entries import entry, table
from holdfast.llm.langid import held_out

#: Lengths of the n-grams, in characters of lower-cased text; each has its own part of the table.
LENGTHS = (4, 5, 6)
#: Places of a part of the table, as a power of two.
BITS = 22
#: Labelled parts of texts to learn the weights from, about. The log-count ratios come from all.
LEARN_ROWS = 16_000
#: Standard errors that a log-count ratio must be away from zero for its feature to count.
CLEAR = 3.0
#: Rounds of descent, penalty on the weights, and counts that every feature starts with.
ROUNDS, PENALTY, PRIOR = 300, 1e-4, 1.0
#: Features, over all rows, that a round of descent looks at together.
BLOCK = 1 << 20
#: Labels that are sent to every task; more meet their texts by a shuffle.
BROADCAST = 1 << 20
#: Characters of a part of a text. Longer texts are seen in equal parts, each as a text of its own.
CHUNK = 1 << 14
#: Counted places in a batch on their way out of a task.
BATCH = 1 << 17
SIZE = len(LENGTHS) << BITS


def _lowered(text: str) -> np.ndarray:
    """The code points of a text in lower case, with a blank before and after it."""
    return np.frombuffer((" " + text.lower() + " ").encode("utf-32-le"), np.uint32)


def _parts(text: str | None) -> list[np.ndarray]:
    """The fewest equal parts of at most CHUNK characters, each with the start of the next: every
    n-gram begins in one of them. A blank before and after the text marks its ends."""
    data = _lowered(text or "")
    many = -(-len(data) // CHUNK)
    size = -(-len(data) // many)
    return [data[at : at + size + max(LENGTHS) - 1] for at in range(0, len(data), size)]


def _places(part: np.ndarray) -> np.ndarray:
    """The place of every n-gram as it comes, repeated ones too: a hash of its characters."""
    data = part.astype(np.uint64) + np.uint64(1)
    gram, found = data, []
    for length in range(2, max(LENGTHS) + 1):
        gram = gram[:-1] * np.uint64(0xBF58476D1CE4E5B9) + data[length - 1 :]
        if length in LENGTHS:
            place = (gram * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BITS)).astype(np.int32)
            found.append(place + np.int32(LENGTHS.index(length) << BITS))
    return np.concatenate(found)


def _once(places: np.ndarray) -> np.ndarray:
    places = np.sort(places)
    return places[np.r_[True, places[1:] != places[:-1]][: len(places)]]


def features(text: str | None) -> np.ndarray:
    """Places of the n-grams a text has, each once, in order. Presence counts, not frequency.

    White space counts as it stands; a blank before and after the text marks its ends. Two n-grams
    that share a place count as one feature. Null and empty texts have the blanks' features only.
    """
    return _once(np.concatenate([_places(part) for part in _parts(text)]))


def _chance(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


@dataclass
class Classifier:
    """The places that count, in order; of each its log-count ratio and its weight; the bias.

    A part of a text is the vector of its features' ratios, scaled to length one.
    """

    places: np.ndarray
    own: np.ndarray
    weights: np.ndarray
    bias: float

    @classmethod
    def constant(cls, bias: float) -> Classifier:
        return cls(np.empty(0, np.int32), np.empty(0), np.empty(0), bias)

    @property
    def ratios(self) -> np.ndarray:
        """Log-count ratios over the whole table; 0 where a feature does not count."""
        out = np.zeros(SIZE)
        out[self.places] = self.own
        return out

    @cached_property
    def _counts(self) -> np.ndarray:
        out = np.zeros(SIZE, bool)
        out[self.places] = True
        return out

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_counts"}

    def found(self, part: np.ndarray) -> np.ndarray:
        """Which of the places a part has, as numbers from 0, each once, in order."""
        places = _places(part)
        return np.searchsorted(self.places, _once(places[self._counts[places]]))

    def score(self, text: str | None) -> float:
        """0 to 1; higher is likelier toxic. A text of several parts has their mean margin."""
        total, parts = 0.0, _parts(text)
        for part in parts:
            found = self.found(part)
            ratios = self.own[found]
            length = float(np.sqrt(ratios @ ratios))
            total += float(ratios @ self.weights[found]) / length if length else 0.0
        return float(_chance(self.bias + total / len(parts)))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many of a partition's parts of texts each place is, by label; -1 counts the parts."""
    held, total = np.zeros((2, SIZE), np.int32), np.zeros(2, np.int64)
    for batch in batches:
        for text, label in zip(batch["text"].to_pylist(), batch["label"].to_pylist(), strict=True):
            for part in _parts(text):
                total[label] += 1
                held[label][_once(_places(part))] += 1
    if not total.any():
        return
    names = ["place", "clean", "toxic"]
    first = [pa.array([x], pa.int32()) for x in (-1, *total)]
    yield pa.RecordBatch.from_arrays(first, names=names)
    place = np.flatnonzero(held[0] | held[1]).astype(np.int32)
    for at in range(0, len(place), BATCH):
        some = place[at : at + BATCH]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (some, held[0][some], held[1][some])], names=names)


def fit(places: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression on scaled log-count ratios, classes weighted alike.

    Nesterov descent over all rows each round; the step is one over a bound of the curvature. The
    scaled ratios are never held for all rows: a round goes through the features in blocks, and what
    stays is four bytes a feature.
    """
    sizes = np.array([len(p) for p in places], np.int64)
    column = np.concatenate(places).astype(np.int32)
    ends = np.r_[0, np.cumsum(sizes)]
    cuts = np.unique(np.r_[np.searchsorted(ends, np.arange(0, ends[-1], BLOCK)), len(places)])
    blocks = [(a, b, column[ends[a] : ends[b]]) for a, b in zip(cuts, cuts[1:], strict=False)]

    def by_row(per_place: np.ndarray) -> np.ndarray:
        total = np.zeros(len(places))
        for a, b, block in blocks:
            held = a + np.flatnonzero(sizes[a:b])
            if len(held):
                total[held] = np.add.reduceat(per_place[block], ends[held] - ends[a])
        return total

    def by_place(per_row: np.ndarray) -> np.ndarray:
        total = np.zeros(len(ratios))
        for a, b, block in blocks:
            total += np.bincount(block, np.repeat(per_row[a:b], sizes[a:b]), len(ratios))
        return total

    length = np.maximum(np.sqrt(by_row(ratios * ratios)), 1e-12)
    share = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum()))
    w, bias = np.zeros(len(ratios)), 0.0
    ahead, ahead_bias, t = w, bias, 1.0
    for _ in range(ROUNDS):
        margin = by_row(ratios * ahead) / length + ahead_bias
        slack = share * (_chance(margin) - labels)
        slope = ratios * by_place(slack / length) + PENALTY * ahead
        new, new_bias = ahead - 2 * slope, ahead_bias - 2 * slack.sum()
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t_new * (new - w)
        ahead_bias = new_bias + (t - 1) / t_new * (new_bias - bias)
        w, bias, t = new, new_bias, t_new
    return w, float(bias)


def _trainer(spark: SparkSession, model: Classifier, share: float):
    shipped = spark.sparkContext.broadcast(model)

    def featurized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, held = [], []
            columns = (batch[c].to_pylist() for c in ("doc_id", "text", "label"))
            for doc_id, text, label in zip(*columns, strict=True):
                for i, part in enumerate(_parts(text)):
                    draw = hashlib.blake2b(part.tobytes(), digest_size=8, key=f"{doc_id} {i}".encode()).digest()
                    if int.from_bytes(draw, "big") < share * 2.0**64:
                        labels.append(label)
                        held.append(shipped.value.found(part).astype(np.int32))
            arrays = [pa.array(labels, pa.int64()), pa.array(held, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["label", "places"])

    def trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, targets = [], []
        for batch in batches:
            targets.append(batch["label"].to_numpy())
            places += [p.values.to_numpy() for p in batch["places"]]
        if places:
            weights, bias = fit(places, np.concatenate(targets), shipped.value.own)
            place = np.flatnonzero(weights)
            columns = [pa.array(np.r_[-1, place]), pa.array(np.r_[bias, weights[place]])]
            yield pa.RecordBatch.from_arrays(columns, names=["place", "weight"])

    return featurized, trained


def learn(docs: DataFrame, labels: DataFrame) -> Classifier:
    """The classifier from labelled documents that are not held out.

    Texts longer than CHUNK are seen in parts, each with the text's label. The log-count ratio of a
    place compares how often toxic and other parts have it, over all labelled rows; ratios that could
    be chance do not count. Tasks count, Spark adds the counts up, and the driver gets the places that
    count. The weights are fitted to about LEARN_ROWS of the parts, drawn one by one by a hash of
    doc_id and part, in a task of its own. With rows of one label only, or none, every text scores
    0.5; with nothing that tells the labels apart, every text scores the share of toxic parts.
    """
    marks = labels.select(
        labels["doc_id"].cast("long").alias("doc_id"), labels["toxic"].cast("long").alias("label")
    ).where("doc_id is not null and label in (0, 1)")
    marks = settle(marks.dropDuplicates(["doc_id", "label"]), "marks")
    if marks.offset(BROADCAST).isEmpty():
        marks = F.broadcast(marks)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    rows = rows.where(~held_out(rows["doc_id"])).join(marks, "doc_id").select("doc_id", "text", "label")
    counted = rows.mapInArrow(_count, "place int, clean int, toxic int")
    counted = settle(counted.groupBy("place").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "places")
    total = counted.where("place < 0").first()
    if total is None or not total["clean"] or not total["toxic"]:
        return Classifier.constant(0.0)
    log = lambda k: F.log((F.col(k) + PRIOR) / (total[k] + 2 * PRIOR))
    error = F.sqrt(1 / (F.col("clean") + PRIOR) + 1 / (F.col("toxic") + PRIOR))
    clear = counted.where("place >= 0").select("place", (log("toxic") - log("clean")).alias("ratio"), error.alias("error"))
    clear = clear.where(F.abs("ratio") > CLEAR * F.col("error")).select("place", "ratio").toArrow()
    place, ratio = (clear[c].to_numpy() for c in ("place", "ratio"))
    if not len(place):
        return Classifier.constant(float(np.log(total["toxic"] / total["clean"])))
    order = np.argsort(place)
    model = Classifier(place[order], ratio[order], np.zeros(len(place)), 0.0)
    share = LEARN_ROWS / (total["clean"] + total["toxic"])
    featurized, trained = _trainer(docs.sparkSession, model, share)
    sample = rows.mapInArrow(featurized, "label long, places array<int>")
    one = sample.repartition(1).sortWithinPartitions("label", F.xxhash64("places"))
    found = one.mapInArrow(trained, "place long, weight double").toArrow()
    place, weight = found["place"].to_numpy(), found["weight"].to_numpy()
    model.weights[place[place >= 0]] = weight[place >= 0]
    model.bias = float(weight[place < 0].sum())
    return model


def with_toxicity(docs: DataFrame, model: Classifier) -> DataFrame:
    """All columns in ``_row``, with ``score`` from 0 to 1. Only the text is looked at.

    Null and empty texts get the score of a text without features that count; long ones that of the
    mean margin of their parts. Repeated rows and ids give a row each, an empty table none; other
    columns, also one named ``score``, stay in ``_row``.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array([shipped.value.score(t.as_py()) for t in texts], pa.float64())

    return packed(docs).withColumn("score", scored(F.col("_row.text").cast("string")))


@entry("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = with_toxicity(docs, learn(docs, table(spark, sf_dir, "labels")))
    return found.select(
        F.col("_row.doc_id").alias("doc_id"),
        held_out(F.col("_row.doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
