"""Importance resampling: documents drawn towards a target distribution of hashed word features."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm.common import by_batch, numbered, settle
from holdfast.llm.entries import entry, table

#: Words in a feature, at most.
LONGEST = 1
BUCKETS = 10_000
SEED = 2024
#: Documents with fewer words are never drawn.
LEAST_WORDS = 20
#: Of the documents that may be drawn, so many in a hundred are.
PERCENT = 10
#: A word or pair is frequent if it makes up over 1 / HEAD of all: there are fewer than HEAD of them.
HEAD = 1 << 16
#: Longer words and pairs are not kept in the head, however frequent: HEAD * HEAD_BYTES bounds it.
HEAD_BYTES = 64
#: Bytes of a text whose words are listed at once.
CHUNK = 1 << 20
#: Distinct words and pairs that a task counts before it hands them on.
COUNTED = 1 << 19

#: Everything but digits, letters and bytes beyond ASCII becomes a blank; A-Z become small.
_SMALL = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def pieces(text: str | None, longest: int = LONGEST, chunk: int = CHUNK) -> Iterator[tuple[list[bytes], int]]:
    """(words, old): the words of a text, cut between words into lists of about ``chunk`` bytes.

    The first ``old`` words of a list are the last ones of the list before: runs that end in them
    were counted there.
    """
    if not text:
        return
    data, at, before = text.encode().translate(_SMALL), 0, []
    while at < len(data):
        to = data.find(b" ", at + chunk)
        to = len(data) if to < 0 else to
        found = data[at:to].split()
        yield before + found, len(before)
        listed = before + found
        before = listed[max(0, len(listed) - longest + 1) :]
        at = to


class Head(dict):
    """CRC states of frequent words and pairs; what is not among them takes its CRC directly."""

    def __missing__(self, feature: bytes) -> int:
        return crc32(feature)

    def codes(self, words: list[bytes], old: int, longest: int) -> np.ndarray:
        """The CRC of every run of up to ``longest`` words that ends after the first ``old`` words.

        A run's state is that of the run without its last word, carried on over a blank and that
        word, unless it is a frequent pair.
        """
        state = list(map(self.__getitem__, words))
        found = [np.array(state[old:], np.int64)]
        for length in range(2, longest + 1):
            last = words[length - 1 :]
            if length == 2:
                pairs = map(b" ".join, zip(words, last, strict=False))
                known = map(self.get, pairs)
            else:
                known = [None] * len(last)
            state = [
                crc32(b" " + word, s) if pair is None else pair
                for word, s, pair in zip(last, state, known, strict=False)
            ]
            found.append(np.array(state[max(0, old - length + 1) :], np.int64))
        return np.concatenate(found)


def _frequent(longest: int):
    """Words, and pairs where runs are longer than one word, with their counts within a task."""

    def listed(counts: dict[bytes, int]) -> pa.RecordBatch:
        columns = [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["feature", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        counts: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch["text"]:
                for words, old in pieces(text.as_py(), max(2, longest)):
                    counts.update(words[old:])
                    if longest > 1:
                        counts.update(map(b" ".join, zip(words, words[1:], strict=False)))
                    if len(counts) > COUNTED:
                        yield listed(counts)
                        counts.clear()
        if counts:
            yield listed(counts)

    return run


def learn_head(texts: DataFrame, longest: int = LONGEST) -> Head:
    """CRC states of the words and pairs that make up over 1 / HEAD of all words or pairs.

    Counts are exact: tasks add up their own, Spark adds up those. Fewer than HEAD words and HEAD
    pairs can be so frequent, and none longer than HEAD_BYTES is kept, so what the driver gets has a
    proven bound (8 MB of words, as much of pairs). texts: (text).
    """
    counts = texts.select("text").mapInArrow(_frequent(longest), "feature binary, n long")
    is_pair = F.contains(F.col("feature"), F.lit(b" "))
    counts = counts.groupBy("feature").agg(F.sum("n").alias("n")).withColumn("pair", is_pair)
    counts = settle(counts, "counts")
    totals = counts.groupBy("pair").agg(F.sum("n").alias("all"))
    frequent = counts.join(F.broadcast(totals), "pair").where(
        (F.col("n") * HEAD > F.col("all")) & (F.octet_length("feature") <= HEAD_BYTES)
    )
    return Head((w, crc32(w)) for w in map(bytes, frequent.select("feature").toArrow()["feature"].to_pylist()))


@dataclass(frozen=True)
class _Features:
    """What tasks need to find the buckets of a text's features."""

    head: Head
    longest: int
    buckets: int

    def of(self, text: str | None) -> Iterator[tuple[np.ndarray, int]]:
        """(buckets of the features, number of words) of each piece of a text."""
        for words, old in pieces(text, self.longest):
            yield self.head.codes(words, old, self.longest) % self.buckets, len(words) - old


def bucket_totals(texts: DataFrame, features) -> DataFrame:
    """(target, bucket, n): the features in each bucket, of the corpus and of the target.

    texts: (target, text). features: a broadcast ``_Features``. A task gives one row for each bucket
    it has met.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, totals = features.value, {}
        for batch in batches:
            for target, text in zip(batch["target"].to_pylist(), batch["text"], strict=True):
                if target not in totals:
                    totals[target] = np.zeros(of.buckets, np.int64)
                for found, _ in of.of(text.as_py()):
                    totals[target] += np.bincount(found, minlength=of.buckets)
        for target, n in totals.items():
            met = np.flatnonzero(n)
            columns = [pa.array([target] * len(met)), pa.array(met), pa.array(n[met])]
            yield pa.RecordBatch.from_arrays(columns, names=["target", "bucket", "n"])

    found = texts.mapInArrow(run, "target boolean, bucket long, n long")
    return found.groupBy("target", "bucket").agg(F.sum("n").alias("n"))


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What a feature of each bucket adds to a weight: 1000 times the log of the target's smoothed
    share over the corpus's, rounded down."""
    size = len(corpus)
    s, t = corpus.astype(np.float64), target.astype(np.float64)
    ratio = (t + 1) * (s.sum() + size) / ((s + 1) * (t.sum() + size))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def with_weights(docs: DataFrame, target: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_words, n_features, weight) per row of docs, all long.

    A feature is a run of up to ``longest`` words of the text in small ASCII letters, repeats
    counted; its bucket is the CRC-32 of its bytes modulo ``buckets``. The weight adds up the gains of
    a document's features over the bucket totals of all of docs and all of target. Null and empty
    texts have no features and weight 0; repeated rows and ids count and stay; very long texts are
    read piece by piece; an empty docs or target counts nothing. Other columns are not read.

    docs: doc_id, text. target: text.
    """
    spark = docs.sparkSession
    text = lambda t: t["text"].cast("string").alias("text")
    corpus = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text(docs))
    both = docs.select(F.lit(False).alias("target"), text(docs)).unionAll(
        target.select(F.lit(True).alias("target"), text(target))
    )
    of = spark.sparkContext.broadcast(_Features(learn_head(both, longest), longest, buckets))
    sums = np.zeros((2, buckets), np.int64)
    for row in bucket_totals(both, of).collect():  # two rows for each bucket at most
        sums[int(row["target"]), row["bucket"]] = row["n"]
    gain = spark.sparkContext.broadcast(gains(sums[0], sums[1]))

    def weigh(batch: pa.RecordBatch) -> pa.RecordBatch:
        features, worth = of.value, gain.value
        out = np.zeros((len(batch), 3), np.int64)
        for i, text in enumerate(batch["text"]):
            for found, words in features.of(text.as_py()):
                out[i] += words, len(found), worth[found].sum()
        columns = [batch["doc_id"], *map(pa.array, out.T.copy())]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "weight"])

    return by_batch(corpus, weigh, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, fixed by the id; a null id counts as empty text."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) per row of docs: a draw without replacement whose
    chances follow the importance weights.

    score is the weight with Gumbel noise; of the N rows with at least ``least_words`` words the
    floor(percent * N / 100) highest scores are drawn, ties to the smaller doc_id (null last). rank
    counts from 1 in that order and is null for rows not drawn. Nulls, empty and long texts and
    repeats as in ``with_weights``; of rows equal in score and id any order may come out.
    """
    weighed = with_weights(docs, target, longest, buckets)
    scored = weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    # equal rows are told apart by where they are written, so that no range holds them all
    scored = settle(scored.withColumn("_tie", F.monotonically_increasing_id()), "scored")
    able = scored.where(F.col("n_words") >= least_words)
    quota = percent * able.count() // 100
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("_tie").asc()]
    ranked = numbered(able, order, "ranked")
    rank = F.when(F.col("number") <= quota, F.col("number"))
    columns = ["doc_id", "n_features", "weight", "score"]
    rest = scored.where(F.col("n_words") < least_words)
    return ranked.select(*columns, rank.alias("rank")).unionAll(
        rest.select(*columns, F.lit(None).cast("long").alias("rank"))
    )


def drawn(docs: DataFrame, target: DataFrame, **settings) -> DataFrame:
    """The documents that ``resample`` draws, all columns kept. doc_id must tell rows apart: rows that
    share an id with a drawn row stay too."""
    ranks = resample(docs, target, **settings).where("rank is not null").select("doc_id").distinct()
    ids = ranks.toDF("_drawn")
    same = docs["doc_id"].cast("long").eqNullSafe(ids["_drawn"])
    return docs.join(ids, same, "left_semi")


#: CRC-32 in SQL: a table by eight steps of the reflected polynomial, then a byte at a time.
SQL = """
with recursive
steps(i, k, c) as (
  select i, 0, i::ubigint from range(256) r(i)
  union all
  select i, k + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384::ubigint) else c >> 1 end
  from steps where k < 8
),
crc as materialized (select list(c order by i) as t from steps where k = 8),
texts as (
  select false as target, doc_id, text from documents
  union all
  select true, null, text from benchmark
),
features as materialized (
  select target, doc_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) as word
  from texts
),
words as (select distinct word, hex(encode(word)) as h from features),
buckets as materialized (
  select word, (xor(list_reduce(
    list_prepend(4294967295::ubigint, list_transform(range(1, length(h), 2),
      lambda i: ('0x' || substr(h, i::int, 2))::ubigint)),
    lambda s, b: xor(s >> 8, t[(xor(s, b) & 255)::int + 1])
  ), 4294967295::ubigint) % 10000)::bigint as bucket
  from words, crc
),
counts as (
  select bucket, count(*) filter (not target) as s, count(*) filter (target) as t
  from features join buckets using (word) group by bucket
),
gains as materialized (
  select bucket, floor(1000 * ln((t + 1)::double * (sum(s) over () + 10000)::double
    / ((s + 1)::double * (sum(t) over () + 10000)::double)))::bigint as gain
  from counts
),
weights as (
  select doc_id, count(*) as n, sum(gain) as weight
  from features join buckets using (word) join gains using (bucket)
  where not target group by doc_id
),
scored as (
  select d.doc_id, coalesce(n, 0)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
    (coalesce(weight, 0) + floor(-1000 * ln(-ln((
      ('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::bigint + 0.5::double) / 4294967296::double))))::bigint
      as score
  from documents d left join weights w on w.doc_id = d.doc_id
),
ranked as (
  select doc_id, row_number() over (order by score desc, doc_id) as place, count(*) over () as all_able
  from scored where n_features >= 20
)
select s.doc_id, n_features, weight, score,
  case when place <= 10 * all_able // 100 then place end as rank
from scored s left join ranked r on r.doc_id = s.doc_id
"""


@entry("op11_resampling", SQL)
def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
