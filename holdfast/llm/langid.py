"""Language identification by prediction by partial matching over bytes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from holdfast.llm.common import packed, settle
from holdfast.llm.entries import entry, table

#: Longest context, in bytes. A gram is a context and the byte after it; 5 bytes fit a long.
ORDER = 4
#: Bytes of text to learn from, for each language. The statistics grow no further with the corpus.
LEARN_BYTES = 1 << 20
#: Texts are drawn in pieces of so many bytes, the last one shorter.
PIECE = 1 << 13
#: Text that stands before every document, so that its first bytes have a context.
START = b"\n" * ORDER
#: Bytes scored at once.
CHUNK = 1 << 20
UNDETERMINED = "und"
HELD_OUT_FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text leaves 0 modulo 5; a null id counts as empty text, so it is held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % HELD_OUT_FOLDS == 0


def _grams(data: np.ndarray, length: int) -> np.ndarray:
    """The grams of a length that end at each byte after the start marker, as numbers."""
    code = np.zeros(len(data) - ORDER, np.int64)
    for back in range(length - 1, -1, -1):
        code = code << 8 | data[ORDER - back : len(data) - back]
    return code


def _bytes_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts with a start marker before each, and where each marker begins."""
    return _joined([START + t.encode() for t in texts])


def _joined(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All parts, after one more start marker, and where each begins behind that. A part's first
    ORDER bytes are context only."""
    starts = np.cumsum([0] + [len(p) for p in parts])
    return np.frombuffer(START + b"".join(parts), np.uint8).astype(np.int64), starts


def _cut(piece: int):
    """The drawn pieces of each text, with the bytes before them as context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, draws, parts = [], [], []
            for lang, text, picks in zip(*(batch[c].to_pylist() for c in ("lang", "text", "picks")), strict=True):
                data = START + text.encode()
                for pick in picks:
                    at = pick["k"] * piece
                    langs.append(lang)
                    draws.append(pick["draw"])
                    parts.append(data[at : at + ORDER + piece])
            columns = [pa.array(langs, pa.string()), pa.array(draws, pa.int64()), pa.array(parts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "draw", "part"])

    return run


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Grams of full length per language, counted within a batch."""
    for batch in batches:
        langs = np.array(batch["lang"].to_pylist(), object)
        parts = np.array([*batch["part"].to_pylist(), None], object)[:-1]
        for lang in dict.fromkeys(langs):
            data, starts = _joined(list(parts[langs == lang]))
            codes = _grams(data, ORDER + 1)
            inside = np.ones(len(codes), bool)
            for k in range(ORDER):
                inside[starts[:-1] + k] = False
            found, counts = np.unique(codes[inside], return_counts=True)
            columns = [pa.array([lang] * len(found)), pa.array(found), pa.array(counts)]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "gram", "n"])


@dataclass
class Lookup:
    """A fixed table from numbers to rows, by open addressing; asked for whole arrays at once."""

    keys: np.ndarray
    slots: np.ndarray
    shift: np.uint64

    @classmethod
    def of(cls, keys: np.ndarray) -> Lookup:
        size = max(16, 1 << int(4 * len(keys)).bit_length())
        shift = np.uint64(64 - (size.bit_length() - 1))
        slots = np.full(size, -1, np.int32)
        rows = np.arange(len(keys), dtype=np.int32)
        at = cls._home(keys, shift)
        while len(rows):
            free = slots[at] < 0
            slots[at[free]] = rows[free]  # of several, the last one stays
            left = slots[at] != rows
            rows, at = rows[left], (at[left] + 1) % size
        return cls(keys, slots, shift)

    @staticmethod
    def _home(keys: np.ndarray, shift: np.uint64) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> shift).astype(np.int64)

    def rows(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key, -1 for none."""
        at = self._home(keys, self.shift)
        found = self.slots[at]
        ask = np.flatnonzero(found >= 0)
        ask = ask[self.keys[found[ask]] != keys[ask]]
        while len(ask):
            at[ask] = (at[ask] + 1) % len(self.slots)
            found[ask] = self.slots[at[ask]]
            ask = ask[found[ask] >= 0]
            ask = ask[self.keys[found[ask]] != keys[ask]]
        return found


@dataclass
class Model:
    """Frozen statistics: per order, what a gram costs in bits in each language.

    costs[k] has, for a gram of order k that some language has seen, its code length in every
    language, escapes included. escapes[k] has, for a context of order k, what it costs in each
    language to say that the next byte was never seen there; nothing for languages that never saw
    the context. A gram that is in no costs[k] pays escapes[k] and is asked for at order k - 1.
    """

    langs: list[str]
    grams: list[Lookup]
    costs: list[np.ndarray]
    contexts: list[Lookup]
    escapes: list[np.ndarray]

    def bits(self, texts: list[str]) -> np.ndarray:
        """Code length of each text in each language."""
        total = np.zeros((len(texts), len(self.langs)))
        if not self.langs:
            return total
        group, size = [], 0
        for i, text in enumerate(texts):
            if len(text) > CHUNK:
                total[i] = self._long(text.encode())
                continue
            group.append(i)
            size += len(text)
            if size > CHUNK:
                total[group] = self._many([texts[j] for j in group])
                group, size = [], 0
        if group:
            total[group] = self._many([texts[j] for j in group])
        return total

    def _many(self, texts: list[str]) -> np.ndarray:
        data, starts = _bytes_of(texts)
        cost = self._each(data)
        for k in range(ORDER):
            cost[starts[:-1] + k] = 0
        return np.add.reduceat(cost, starts[:-1], axis=0, dtype=np.float64)

    def _long(self, text: bytes) -> np.ndarray:
        total = np.zeros(len(self.langs))
        text = START + text
        for at in range(ORDER, len(text), CHUNK):
            part = np.frombuffer(text[at - ORDER : at + CHUNK], np.uint8).astype(np.int64)
            total += self._each(part).sum(axis=0, dtype=np.float64)
        return total

    def _each(self, data: np.ndarray) -> np.ndarray:
        """Bits of each byte after the first ORDER ones, in each language."""
        full = _grams(data, ORDER + 1)
        rows = self.grams[ORDER].rows(full)
        cost = self.costs[ORDER][rows]
        open_ = np.flatnonzero(rows < 0)
        paid = np.zeros((len(open_), len(self.langs)), np.float32)
        for order in range(ORDER, -1, -1):
            gram = full[open_] & ((1 << 8 * (order + 1)) - 1)
            if order < ORDER:
                rows = self.grams[order].rows(gram)
                seen = rows >= 0
                cost[open_[seen]] = paid[seen] + self.costs[order][rows[seen]]
                open_, paid, gram = open_[~seen], paid[~seen], gram[~seen]
            if not len(open_):
                return cost
            context = self.contexts[order].rows(gram >> 8)
            known = context >= 0
            paid[known] += self.escapes[order][context[known]]
        cost[open_] = paid + 8  # all bytes alike
        return cost


def _model(langs: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray) -> Model:
    """The context trees of counted full-length grams, as tables of code lengths.

    Escapes follow method C: a context seen n times with d different next bytes gives byte s the
    share c(s) / (n + d), and the escape d / (n + d).
    """
    size = len(langs)
    costs, escapes, grams, contexts = [], [], [], []
    lower = None
    for order in range(ORDER + 1):
        code = gram & ((1 << 8 * (order + 1)) - 1)
        keys, row = np.unique(code, return_inverse=True)
        count = np.zeros((len(keys), size))
        np.add.at(count, (row, lang), n)
        context_keys, context = np.unique(keys >> 8, return_inverse=True)
        total = np.zeros((len(context_keys), size))
        kinds = np.zeros((len(context_keys), size))
        np.add.at(total, context, count)
        np.add.at(kinds, context, count > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            escape = np.where(kinds > 0, np.log2((total + kinds) / kinds), 0.0)
            own = np.log2((total + kinds)[context] / count)
        if lower is None:
            below = np.full((len(keys), size), 8.0)
        else:
            below = lower[1][np.searchsorted(lower[0], keys & ((1 << 8 * order) - 1))]
        cost = np.where(count > 0, own, escape[context] + below)
        lower = keys, cost
        grams.append(Lookup.of(keys))
        contexts.append(Lookup.of(context_keys))
        # a last row for "none": taken by row -1, then overwritten
        costs.append(np.vstack([cost, np.zeros((1, size))]).astype(np.float32))
        escapes.append(escape.astype(np.float32))
    return Model(langs, grams, costs, contexts, escapes)


def draw_below(size: int, least: int) -> int:
    """Pieces whose 63-bit draw is up to this are candidates: twice LEARN_BYTES of a language that
    has ``size`` bytes, or all of it; whatever the size, the piece with the least draw."""
    if size <= 2 * LEARN_BYTES:
        return (1 << 63) - 1
    return max(least, (LEARN_BYTES << 64) // size)


def _sample(docs: DataFrame) -> DataFrame:
    """(lang, part): pieces of text to learn from, LEARN_BYTES of each language or all it has.

    A piece's draw is a hash of doc_id, text and place, so it does not matter how long a text is, and
    copies are drawn one by one. The pieces with the least draws are taken until there is enough.
    """
    rows = docs.select(
        docs["text"].cast("string").alias("text"),
        docs["lang"].cast("string").alias("lang"),
        F.xxhash64(docs["doc_id"], docs["text"].cast("string")).alias("own"),
        F.octet_length(docs["text"].cast("string")).alias("bytes"),
        held_out(docs["doc_id"]).alias("out"),
    ).where(~F.col("out") & F.col("lang").isNotNull() & (F.col("bytes") > 0))
    one = lambda k: F.struct(
        F.shiftrightunsigned(F.xxhash64("own", k), 1).alias("draw"), k.cast("long").alias("k")
    )
    last = F.floor((F.col("bytes") - 1) / PIECE)
    rows = rows.withColumn("picks", F.transform(F.sequence(F.lit(0).cast("long"), last), one))
    sizes = rows.groupBy("lang").agg(
        F.sum("bytes").alias("bytes"), F.min(F.array_min("picks")["draw"]).alias("least")
    )
    bounds = [(r["lang"], draw_below(r["bytes"], r["least"])) for r in sizes.collect()]
    bounds = docs.sparkSession.createDataFrame(bounds, "lang string, below long")
    near = rows.join(F.broadcast(bounds), "lang").withColumn(
        "picks", F.filter("picks", lambda p: p["draw"] <= F.col("below"))
    )
    near = near.where(F.size("picks") > 0).select("lang", "text", "picks")
    parts = settle(near.mapInArrow(_cut(PIECE), "lang string, draw long, part binary"), "pieces")
    before = Window.partitionBy("lang").orderBy("draw").rowsBetween(Window.unboundedPreceding, -1)
    taken = F.coalesce(F.sum(F.octet_length("part") - ORDER).over(before), F.lit(0))
    return parts.withColumn("taken", taken).where(F.col("taken") < LEARN_BYTES).select("lang", "part")


def learn(docs: DataFrame) -> Model:
    """Context trees per language from the rows that are not held out and have text and lang.

    A language gives all its text, or LEARN_BYTES of it (over by a piece at most) drawn in pieces
    over all its documents. All counting is Spark's; the driver gets the distinct grams of that
    bounded sample. Empty texts teach nothing; an empty table gives a model without languages.
    """
    counted = _sample(docs).mapInArrow(_count_grams, "lang string, gram long, n long")
    counted = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    named = counted["lang"].to_pylist()
    langs = sorted(set(named))
    if not langs:
        return Model([], [], [], [], [])
    code = {x: i for i, x in enumerate(langs)}
    lang = np.array([code[x] for x in named], np.int64)
    return _model(langs, lang, counted["gram"].to_numpy(), counted["n"].to_numpy())


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def predict(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """All columns in ``_row``, with ``lang_pred`` and ``score``.

    The language whose frozen context tree codes the text in fewest bits; the score is its share of
    2^-bits over all languages. Ties go to the first language by code point. A text that is null or
    has no letter is ``und`` with score 0, and so is any text when there was nothing to learn from.
    Long texts are scored whole, in pieces. Repeated rows and ids give a row each; other columns, also
    such named like the new ones, stay in ``_row``.
    """
    model = learn(docs) if model is None else model
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    rows = packed(docs)

    def best(texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        model = shipped.value
        sure = [i for i, t in enumerate(texts) if t and model.langs and has_letter(t)]
        langs, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        if sure:
            bits = model.bits([texts[i] for i in sure])
            least = bits.argmin(axis=1)
            scores[sure] = 1 / np.exp2(bits.min(axis=1, keepdims=True) - bits).sum(axis=1)
            for i, k in zip(sure, least, strict=True):
                langs[i] = model.langs[k]
        return langs, scores

    @F.pandas_udf("lang_pred string, score double")
    def predicted(texts):
        import pandas as pd

        langs, scores = best([t if isinstance(t, str) else None for t in texts])
        return pd.DataFrame({"lang_pred": langs, "score": scores})

    found = rows.withColumn("_p", predicted(F.col("_row.text").cast("string")))
    return found.select("_row", "_p.lang_pred", "_p.score")


def keep_identified(docs: DataFrame, least_score: float = 0.5) -> DataFrame:
    """Documents with a language: neither ``und`` nor below the score. All columns are kept."""
    found = predict(docs)
    sure = (F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least_score)
    return found.where(sure).select("_row.*")


@entry("op10_langid")
def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return predict(docs).select(
        F.col("_row.doc_id").alias("doc_id"),
        held_out(F.col("_row.doc_id")).alias("held_out"),
        "lang_pred",
        "score",
    )
