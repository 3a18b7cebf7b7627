"""Mixing sources to target weights: fixed-length blocks of words, dealt to output shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from holdfast.llm.common import settle, word_array
from holdfast.llm.entries import entry, table

#: Words of a block.
BLOCK = 128
#: Blocks of an output shard; the last one has what is left.
SHARD = 8192
#: Weights of the sources in code point order, over and over; null comes last.
WEIGHTS = (3, 1, 2)
#: Size of the mix as a share of all words, and how often a source may be used up.
SHARE = 1.5
MOST = 2
SEED = 42
#: Slots that one task draws and permutes, about.
SLOTS_PER_TASK = 1 << 20
#: Rows that one running sum goes over, about; and slots that one row unfolds to.
RUN = 4096
#: Rounds of the index permutation, and steps back into its range.
ROUNDS = 6
STEPS = 16


def source_targets(sizes: DataFrame, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, rank, source_size, weight, target) from (source, size): one row per source.

    Sources share ``share`` times all words by weight. A target stops at ``most`` times its source's
    size; what is over goes to the others by weight until none is above. Sources sorted by the level
    at which they stop are full up to some place, and the level there is that of all the rest.
    """
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    rank = (F.row_number().over(order) - 1).alias("rank")
    ranked = total.select("source", "source_size", rank)
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    ranked = ranked.withColumn("weight", F.get(weights, F.col("rank") % len(WEIGHTS)))
    ranked = ranked.withColumn("full", F.lit(float(most)) * F.col("source_size"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_level = Window.orderBy(F.col("full") / F.col("weight"), "rank")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    wanted = F.lit(share) * F.sum("source_size").over(everything)
    left = wanted - F.coalesce(F.sum("full").over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    levels = ranked.withColumn("level", left / weight_left)
    is_full = F.col("full") <= F.col("level") * F.col("weight")
    level = F.max(F.when(~is_full, F.col("level"))).over(everything)
    levels = levels.withColumn("common", level).withColumn("is_full", is_full)
    target = F.when(F.col("is_full"), F.col("full")).otherwise(F.col("common") * F.col("weight"))
    return levels.select("source", "rank", "source_size", "weight", target.alias("target"))


def permuted(index: Column, size: Column, *keys: Column) -> Column:
    """A pseudorandom permutation of 0 .. size - 1, different for other keys.

    The index is a pair of digits in a rectangle just larger than the size; each round adds a hash
    of one digit to the other, so nothing meets. An index that leaves the range goes on until it is
    back: fewer than sqrt(size) places lie outside, so STEPS of them in a row do not occur below 256
    places and with a chance under 1e-19 above.
    """
    wide = F.greatest(F.ceil(F.sqrt(size.cast("double"))), F.lit(1)).cast("long")
    high = F.ceil(size / wide).cast("long")
    rounds = F.sequence(F.lit(1), F.lit(ROUNDS))

    def one_round(pair: Column, number: Column) -> Column:
        left = (pair["l"] + F.pmod(F.xxhash64(pair["r"], number, *keys), wide)) % wide
        right = (pair["r"] + F.pmod(F.xxhash64(left, number, F.lit("r"), *keys), high)) % high
        return F.struct(left.alias("l"), right.alias("r"))

    def once(x: Column) -> Column:
        begin = F.struct(F.floor(x / high).cast("long").alias("l"), (x % high).alias("r"))
        return F.aggregate(rounds, begin, one_round, lambda p: p["l"] * high + p["r"])

    return F.aggregate(
        F.sequence(F.lit(2), F.lit(STEPS)),
        once(index),
        lambda x, _: F.when(x < size, x).otherwise(once(x)),
    )


def _placed(docs: DataFrame) -> DataFrame:
    """Every row's place among its source's words: (h1, h2, copy) names the row, start its first word.

    Words of a source stand in the order of the rows' hashes. Running sums go over buckets of rows,
    then over the buckets, so a large source is not one task's work.
    """
    sizes = settle(_sized(docs).drop("text"), "sizes")
    sources = settle(source_targets(sizes), "sources")
    buckets = sizes.count() // RUN + 1
    rows = sizes.join(
        sources.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))
    ).withColumn("bucket", F.pmod("h1", F.lit(buckets)))
    inside = Window.partitionBy("rank", "bucket").orderBy("h1", "h2")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("inside", F.sum("size").over(upto) - F.col("size")).withColumn(
        "copy", F.row_number().over(Window.partitionBy("rank", "bucket", "h1", "h2").orderBy("inside"))
    )
    sums = sizes.join(sources.select(F.col("source").alias("_source"), "rank"),
                      F.col("source").eqNullSafe(F.col("_source")))
    sums = sums.groupBy("rank", F.pmod("h1", F.lit(buckets)).alias("bucket")).agg(F.sum("size").alias("s"))
    before = Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("rank", "bucket", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("base"))
    placed = rows.join(sums, ["rank", "bucket"]).withColumn("start", F.col("base") + F.col("inside"))
    return settle(
        placed.select("doc_id", "source", "rank", "size", "source_size", "target", "h1", "h2", "copy", "start"),
        "placed",
    )


def _sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, text, size, h1, h2): the hashes name a row, whatever its order or file."""
    text, source = docs["text"].cast("string"), docs["source"].cast("string")
    doc_id = docs["doc_id"].cast("long")
    key = (doc_id, source, text)
    return docs.select(
        doc_id.alias("doc_id"),
        source.alias("source"),
        text.alias("text"),
        F.size(word_array(text)).cast("long").alias("size"),
        F.xxhash64(F.lit(1), *key).alias("h1"),
        F.xxhash64(F.lit(2), *key).alias("h2"),
    )


def _slots(sources: DataFrame, spark: SparkSession) -> DataFrame:
    """(rank, block, shard, slot, most): the blocks that the mix takes, each with its place.

    A source's target is so many whole passes over its blocks and a part of another, so it has that
    many slots. The slots of all sources, one after the other, are dealt to shards of SHARD slots by a
    pseudorandom permutation: a shard's counts of the sources are a multinomial draw, given that the
    sources get their targets in all. The slots of a source are numbered through the shards; a slot's
    number gives a pass and, by that pass's permutation, a block. So no block is
    taken more often than passes are begun. The very last slot of a source takes the words that are
    still wanting (most).
    """
    passes = F.floor(F.col("target") / F.col("source_size")).cast("long")
    want = F.round(F.col("target") - passes * F.col("source_size")).cast("long")
    plan = sources.where("source_size > 0").select(
        "rank",
        F.ceil(F.col("source_size") / BLOCK).cast("long").alias("blocks"),
        passes.alias("passes"),
        want.alias("want"),
    )
    part = F.ceil(F.col("want") / BLOCK).cast("long")
    plan = plan.withColumn("slots", F.col("passes") * F.col("blocks") + part).withColumn(
        "last", F.when(F.col("want") > 0, F.col("want") - BLOCK * (part - 1)).otherwise(BLOCK)
    )
    total = plan.agg(F.sum("slots")).first()[0] or 0
    ahead = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)  # a row for each source
    plan = plan.withColumn("ahead", F.coalesce(F.sum("slots").over(ahead), F.lit(0)))
    runs = plan.withColumn("run", F.explode(F.sequence(F.lit(0), F.floor(F.col("slots") / RUN).cast("long"))))
    tasks = max(spark.sparkContext.defaultParallelism, total // SLOTS_PER_TASK)
    runs = runs.repartition(tasks, "rank", "run")
    first, last = F.col("run") * RUN, F.least((F.col("run") + 1) * RUN, F.col("slots")) - 1
    # what a source's slots need goes along: a join with it may be planned in the tasks of its few rows
    source = ["rank", "blocks", "slots", "last"]
    draws = runs.where(first <= last).select(*source, "ahead", F.explode(F.sequence(first, last)).alias("k"))
    place = permuted(F.col("ahead") + F.col("k"), F.lit(total), F.lit(SEED), F.lit("shards"))
    shard = F.floor(place / SHARD).cast("long")
    counts = draws.groupBy(*source, shard.alias("shard")).agg(F.count("*").alias("count"))
    upto = Window.partitionBy("rank").orderBy("shard")
    before = F.sum("count").over(upto.rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.withColumn("first", F.coalesce(before, F.lit(0)))
    # few rows that unfold to very many: dealt out by number, or they would be joined into one task
    counts = counts.repartition(tasks, "rank", "shard")
    number = F.explode(F.sequence(F.col("first"), F.col("first") + F.col("count") - 1)).alias("k")
    slots = counts.select(*source, "shard", number)
    pass_no = F.floor(F.col("k") / F.col("blocks")).cast("long")
    block = permuted(F.col("k") % F.col("blocks"), F.col("blocks"), F.lit(SEED), F.col("rank"), pass_no)
    most = F.when(F.col("k") == F.col("slots") - 1, F.col("last")).otherwise(BLOCK)
    return slots.select("rank", block.alias("block"), "shard", F.col("k").alias("slot"), most.alias("most"))


def mixed_pieces(placed: DataFrame) -> DataFrame:
    """What the mix takes of each row: (h1, h2, copy, shard, rank, slot, block, word_from, word_to).

    Blocks of a source are cut from its rows one after the other; rows meet the slots that take
    their blocks by (source, block), keys that are all alike in size.
    """
    spark = placed.sparkSession
    sources = settle(placed.select("rank", "source_size", "target").distinct(), "targets")
    end = F.col("start") + F.col("size")
    blocks = F.sequence(F.floor(F.col("start") / BLOCK), F.floor((end - 1) / BLOCK))
    cut = placed.where("size > 0").select(
        "rank", "h1", "h2", "copy", "start", "size", F.explode(blocks).alias("block")
    )
    # The planner takes either side for the few rows that it unfolds from, and would have the driver
    # broadcast all slots; both sides go by their keys.
    pieces = cut.hint("merge").join(_slots(sources, spark), ["rank", "block"])
    at = F.col("block") * BLOCK
    word_from = F.greatest(at, F.col("start"))
    word_to = F.least(at + F.col("most"), F.col("start") + F.col("size"))
    pieces = pieces.withColumn("word_from", word_from - F.col("start"))
    pieces = pieces.withColumn("word_to", word_to - F.col("start")).where("word_from < word_to")
    return pieces.select("h1", "h2", "copy", "shard", "rank", "slot", "block", "word_from", "word_to")


def mix_report(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) per row: the words that the mix takes of it.

    Null texts have no words. A null source is a source of its own, and the last one. Repeated rows
    and ids are rows of their own. Reruns give the same mix, whatever the order of rows and files.
    """
    placed = _placed(docs)
    taken = mixed_pieces(placed).groupBy("h1", "h2", "copy").agg(
        F.sum(F.col("word_to") - F.col("word_from")).alias("taken")
    )
    rows = placed.join(taken, ["h1", "h2", "copy"], "left")
    return rows.select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")
    )


def mix(docs: DataFrame) -> DataFrame:
    """The mix itself: (shard, source, slot, block, doc_id, word_from, word_to, text) per piece.

    A block of a shard is the pieces of one (source, slot), in the order of word_from within a row.
    The words of a piece are joined by single spaces. Every row meets the list of its pieces once.
    """
    pieces = mixed_pieces(_placed(docs))
    lists = pieces.groupBy("h1", "h2").agg(
        F.collect_list(F.struct("shard", "slot", "block", "word_from", "word_to")).alias("pieces")
    )
    # Rows alike in id, source and text give their pieces from one of them. Texts move once, whole.
    rows = _sized(docs).select("h1", "h2", "doc_id", "source", "text").dropDuplicates(["h1", "h2"])
    found = rows.join(lists, ["h1", "h2"]).withColumn("words", word_array(F.col("text")))

    def cut(piece: Column) -> Column:
        length = (piece["word_to"] - piece["word_from"]).cast("int")
        own = F.slice("words", (piece["word_from"] + 1).cast("int"), length)
        return piece.withField("text", F.array_join(own, " "))

    found = found.select("doc_id", "source", F.explode(F.transform("pieces", cut)).alias("p"))
    return found.select(
        "p.shard", "source", "p.slot", "p.block", "doc_id", "p.word_from", "p.word_to", "p.text"
    )


@entry("op5_mixing")
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(table(spark, sf_dir, "documents"))
