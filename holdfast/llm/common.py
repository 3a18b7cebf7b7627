"""What several operators share: words, row keys, tables between steps, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.workspace import new_path

#: A word is a run of anything but ASCII white space. In Python, bytes.split() cuts the same way.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def words(text: str | None) -> list[bytes]:
    """The words of a text, as UTF-8; none for null."""
    return text.encode().split() if text else []


def word_array(text: Column) -> Column:
    """The words of a text as an array; empty for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def settle(table: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    What follows starts from files every executor reaches, so a lost executor costs its tasks only,
    and the planner knows the size of what it joins.
    """
    spark = table.sparkSession
    path = new_path(spark, name)
    table.write.parquet(path)
    return spark.read.schema(table.schema).parquet(path)


def packed(docs: DataFrame) -> DataFrame:
    """Every column of a row in one struct ``_row``, so that helper columns cannot clash."""
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"))


def by_batch(
    table: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str
) -> DataFrame:
    """mapInArrow with a function of one batch; None gives nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = function(batch)
            if out is not None:
                yield out

    return table.mapInArrow(run, schema)


def numbered(table: DataFrame, order: list[Column], name: str) -> DataFrame:
    """The table with ``number``: 1, 2, 3... in the given order over all its rows.

    Rows are dealt by ranges and sorted within them; a row's number is its place in its range and the
    rows of the ranges before. Only the sizes of the ranges, a row for each task, meet in one place.
    Give an order without ties: equal rows are numbered as they come, and share one range.
    """
    ranges = table.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranges = settle(ranges.withColumn("_range", F.spark_partition_id()).withColumn("_place", place), name)
    sizes = ranges.groupBy("_range").agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    found = ranges.join(F.broadcast(sizes), "_range")
    number = F.col("_before") + F.col("_place") + 1
    return found.withColumn("number", number).drop("_range", "_place", "_before")


def _ordered(vertex: str) -> Column:
    return F.struct(F.xxhash64(vertex).alias("order"), F.col(vertex).alias("id"))


def connected_components(links: DataFrame) -> DataFrame:
    """(v, root) for every vertex of the links (a, b): root is the smallest vertex it reaches.

    Each round every vertex takes the neighbour that comes first in a random (hashed) order as its
    parent, parents are followed four steps, and the links are redrawn between parents. In a random
    order a constant share of the vertices goes each round, whatever the links look like: the rounds
    grow with the logarithm of the vertices. A round is a few shuffles of what is still apart;
    nothing but "any link left?" reaches the driver. A vertex with very many links costs no more
    than others: only minima meet at it.
    """
    links = settle(links.where("a <> b").select("a", "b"), "links")
    labels = links.select(F.col("a").alias("v"), F.col("a").alias("root")).limit(0)
    first = True
    while not links.isEmpty():
        both = links.select(F.col("a").alias("v"), F.col("b").alias("n")).unionAll(
            links.select(F.col("b").alias("v"), F.col("a").alias("n"))
        )
        parent = both.groupBy("v").agg(F.min(_ordered("n")).alias("m"))
        parent = parent.select("v", F.least("m", _ordered("v"))["id"].alias("p"))
        for _ in range(2):
            parent = settle(parent, "parents")
            up = parent.select(F.col("v").alias("p"), F.col("p").alias("pp"))
            parent = parent.join(up, "p").select("v", F.col("pp").alias("p"))
        parent = settle(parent, "parents")
        if first:
            labels, first = parent.select("v", F.col("p").alias("root")), False
        else:
            up = parent.select(F.col("v").alias("root"), "p")
            labels = settle(
                labels.join(up, "root", "left").select("v", F.coalesce("p", "root").alias("root")),
                "labels",
            )
        for end in ("a", "b"):
            up = parent.select(F.col("v").alias(end), F.col("p").alias(f"_{end}"))
            links = links.join(up, end)
        links = links.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"))
        links = settle(links.where("a <> b").distinct(), "links")
    least = labels.groupBy("root").agg(F.min("v").alias("least"))
    return labels.join(least, "root").select("v", F.col("least").alias("root"))
