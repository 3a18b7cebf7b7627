"""CSV with line breaks inside quotes, read in blocks: quotes are counted to find where records begin."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast import workspace

#: Blocks sent to every task, about 40 bytes each; with more, lines are sorted to meet theirs.
BROADCAST = 200_000
#: What a piece of text is: a record; the beginning of one that leaves its block; what goes on with it.
WHOLE, OPEN, MORE = 0, 1, 2
_PIECE = pa.schema([("id", pa.int64()), ("kind", pa.int8()), ("first", pa.bool_()), ("text", pa.binary())])
_PIECE_SQL = "id long, kind byte, first boolean, text binary"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, odd, line): the lines of each block in order; odd tells an odd number of quotes."""
    text = spark.read.option("lineSep", "\n").text(path)
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        (quotes % 2 == 1).alias("odd"),
        F.col("value").alias("line"),
    )


def _blocks(lines: DataFrame) -> DataFrame:
    """(id, file, block, inside, leaves): whether a block begins, and ends, within quotes. A row per block.

    The only order over a file is over its blocks, one narrow row each.
    """
    parity = lines.groupBy("file", "block").agg((F.count_if("odd") % 2).alias("odd"))
    so_far = Window.partitionBy("file").orderBy("block")
    after = F.sum("odd").over(so_far) % 2
    table = parity.select("file", "block", after.alias("after"), "odd")
    table = table.select(
        F.monotonically_increasing_id().alias("id"), "file", "block",
        ((F.col("after") + F.col("odd")) % 2 == 1).alias("inside"),
        (F.col("after") == 1).alias("leaves"),
    )
    path = workspace.new_path(lines.sparkSession, "csv_blocks")
    table.write.parquet(path)
    return lines.sparkSession.read.schema(table.schema).parquet(path)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines put together to records, block by block; what crosses the edge of a block goes out in parts."""
    block, kept, kind, first, within = None, [], WHOLE, False, False

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(zip(*rows), _PIECE.types, strict=True)], schema=_PIECE
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch["id"].to_numpy()
        odd = batch["odd"].to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), len(ids)]
        for start, end in zip(edges, edges[1:]):
            rows = []
            if ids[start] != block:
                if kept:
                    rows.append((block, OPEN if kind == WHOLE else MORE, first, b"\n".join(kept)))
                block, kept = int(ids[start]), []
                within = batch["inside"][start].as_py()
                kind = MORE if within else WHOLE
                first = batch["head"][start].as_py()
            if not (within or first or odd[start:end].any()):  # every line is a record
                n = end - start
                if rows:
                    yield out(rows)
                yield pa.RecordBatch.from_arrays(
                    [batch["id"].slice(start, n), pa.array(np.zeros(n, np.int8)),
                     pa.array(np.zeros(n, bool)), batch["line"].slice(start, n)],
                    schema=_PIECE,
                )
                continue
            for line, turns in zip(batch["line"].slice(start, end - start), odd[start:end], strict=True):
                kept.append(line.as_py())
                within ^= bool(turns)
                if not within:
                    rows.append((block, kind, first, b"\n".join(kept)))
                    kept, kind, first = [], WHOLE, False
            if rows:
                yield out(rows)
    if kept:
        yield out([(block, OPEN if kind == WHOLE else MORE, first, b"\n".join(kept))])


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """(file, first, record): the text of every record of the CSV files at a path.

    Quotes inside quoted text are doubled, so a line begins a record where an even number of quotes
    stands before it in its file. Quotes are counted per block; with the sums over the blocks before
    it, each block is cut into records by itself, and a record that crosses blocks is put together
    from its parts. Files are read twice, a third time only where records cross blocks. A record, not
    a file, must fit in memory. first marks the first record of a file. Lines that are empty
    are no records; an empty file has none. A file whose quotes do not close is an error.
    """
    lines = _lines(spark, path)
    blocks = _blocks(lines)
    few = blocks.count() <= BROADCAST

    def pieces(of: DataFrame) -> DataFrame:
        facts = of.select("id", "file", "block", "inside", (F.col("block") == 0).alias("head"))
        columns = ["id", "inside", "head", "odd", F.col("line").cast("binary").alias("line")]
        if few:
            met = lines.join(F.broadcast(facts), ["file", "block"]).select(*columns)
        else:  # the join may disturb the order of lines
            at = F.monotonically_increasing_id()
            met = lines.withColumn("at", at).join(facts.hint("merge"), ["file", "block"])
            met = met.repartition("id").sortWithinPartitions("id", "at").select(*columns)
        return met.mapInArrow(_cut, _PIECE_SQL)

    text = F.col("text").cast("string")
    names = blocks.select("id", "file", "block")
    whole = pieces(blocks).where(F.col("kind") == WHOLE).select("first", text.alias("record"))

    parts = pieces(blocks.where("inside or leaves")).where(F.col("kind") != WHOLE)
    parts = parts.join(names, "id")
    # Within a block, what goes on with an earlier record stands before what begins one.
    in_order = Window.partitionBy("file").orderBy("block", F.col("kind").desc())
    begun = F.last(F.when(F.col("kind") == OPEN, F.col("block")), ignorenulls=True).over(in_order)
    joined = parts.withColumn("begun", begun).groupBy("file", "begun").agg(
        F.max("first").alias("first"),
        F.array_sort(F.collect_list(F.struct("block", text.alias("text")))).alias("parts"),
    )
    record = F.concat_ws("\n", F.col("parts.text"))
    quotes = F.length(record) - F.length(F.replace(record, F.lit('"'), F.lit("")))
    torn = F.concat(F.lit("quotes do not close in "), F.col("file"))
    closed = F.when(quotes % 2 == 1, F.raise_error(torn).cast("string")).otherwise(record)
    crossing = joined.select("first", closed.alias("record"))
    found = whole.unionByName(crossing)
    return found.where(~F.col("record").isin("", "\r"))


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, header: Sequence[str]
) -> DataFrame:
    """The records at a path in a schema, in any order. Every file must begin with the header.

    Records with too few or too many fields, and fields that the schema cannot read, are errors.
    """
    options = {"escape": '"', "mode": "FAILFAST", "multiLine": "true"}
    texts = read_texts(spark, path).withColumn("record", F.regexp_replace("record", r"\r\z", ""))

    def fields(names: Sequence[str], types: Sequence[str]) -> Column:
        quoted = ["`" + name.replace("`", "``") + "`" for name in names]
        ddl = ", ".join(f"{name} {type_}" for name, type_ in zip(quoted, types, strict=True))
        return F.from_csv("record", ddl, options)

    places = [f"c{i}" for i in range(len(header))]
    as_names = fields(places, ["string"] * len(header))
    own = F.array(*[F.coalesce(as_names.getField(c), F.lit("")) for c in places])
    wrong = F.concat(F.lit("a CSV file has another header: "), F.col("record"))
    is_header = F.when(own == F.array(*map(F.lit, header)), F.lit(True)).otherwise(
        F.raise_error(wrong).cast("boolean")
    )
    rows = texts.where(F.when(F.col("first"), ~is_header).otherwise(F.lit(True)))
    parsed = fields(schema.names, [f.dataType.simpleString() for f in schema])
    return rows.select(parsed.alias("row")).select("row.*")
