"""Fingerprints of inputs."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast import workspace
from holdfast.sources.sha256 import Sha256

#: Files up to this size are digested by one task; larger ones in parts of about this size.
PART_BYTES = 1 << 28
#: Bytes in a row of a part: readers and writers hold thousands of rows at once.
CHUNK = 1 << 12
#: What readers of text put out unpacked: these files are never read in parts.
PACKED = r"\.(gz|bz2|deflate|snappy|lz4|zst|passthrough)$"
#: Largest such file: it passes through one task whole.
MOST_PACKED_BYTES = 1 << 30
#: Readers of text leave these bytes out at the begin of a file.
_MARK = b"\xef\xbb\xbf"
_CHUNK = pa.schema([("id", pa.int64()), ("block", pa.int64()), ("place", pa.int64()), ("data", pa.binary())])
_CHUNK_SQL = "id long, block long, place long, data binary"


def _runs(batch: pa.RecordBatch, columns: Sequence[str]) -> Iterator[tuple[tuple, pa.Buffer]]:
    """Of each run of rows with equal values in some columns: these, and the bytes of ``data``, joined."""
    keys = np.stack([batch[c].to_numpy() for c in columns])
    edges = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), keys.shape[1]]
    data = batch["data"].cast(pa.binary())
    offsets = np.frombuffer(data.buffers()[1], np.int32)[data.offset :]
    for start, end in zip(edges, edges[1:]):
        first, last = int(offsets[start]), int(offsets[end])
        yield tuple(keys[:, start].tolist()), data.buffers()[2].slice(first, last - first)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines put together to chunks, numbered within their block of a file."""
    at, place = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        for (id_, block), data in _runs(batch, ("id", "block")):
            if (id_, block) != at:
                at, place = (id_, block), 0
            offsets = np.append(np.arange(0, data.size, CHUNK), data.size).astype(np.int32)
            n = len(offsets) - 1
            chunks = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), data])
            same = [pa.array(np.full(n, x, np.int64)) for x in at]
            places = pa.array(np.arange(place, place + n, dtype=np.int64))
            yield pa.RecordBatch.from_arrays([*same, places, chunks], schema=_CHUNK)
            place += n


def _going_on(states: dict[int, bytes], sizes: dict[int, int]) -> Callable:
    """A function for mapInArrow: the digest of each file goes on over its chunks, up to its size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, digest = None, None

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {"id": [at], "state": [digest.state], "sha256": [digest.hexdigest()]},
                schema=pa.schema([("id", pa.int64()), ("state", pa.binary()), ("sha256", pa.string())]),
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            for (id_,), data in _runs(batch, ("id",)):
                if id_ != at:
                    if digest:
                        yield out()
                    at, digest = id_, Sha256(states[id_])
                digest.update(data.address, min(data.size, sizes[id_] - digest.n_bytes))
        if digest:
            yield out()

    return run


def _in_parts(part_bytes: int) -> Column:
    """Whether a file is digested in parts. By metadata alone: Spark opens no file that this leaves out."""
    packed = F.col("_metadata.file_path").rlike(PACKED)
    return ~packed & (F.col("_metadata.file_size") > part_bytes)


def _digests_in_parts(
    spark: SparkSession, path: str, files: Sequence[tuple[str, int]], part_bytes: int
) -> list[str]:
    """The digests of large files (file, size) under a path, in their order, the largest first.

    A digest takes a file's bytes in order, so a part of each file at a time; what goes from part to
    part is a state of 112 bytes. The text reader gives the bytes, block by block: it takes off the
    line breaks, put back here, and a byte order mark, seen by the bytes that are wanting.
    """
    numbers = spark.createDataFrame([(i, file) for i, (file, _) in enumerate(files)], "id long, file string")
    lines = spark.read.option("lineSep", "\n").text(path).where(_in_parts(part_bytes))
    lines = lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.concat(F.col("value").cast("binary"), F.lit(b"\n")).alias("data"),
    )
    lines = lines.join(F.broadcast(numbers), "file").select("id", "block", "data")
    chunks = lines.mapInArrow(_chunks, _CHUNK_SQL)
    chunks = chunks.withColumn("n", F.octet_length("data").cast("long"))
    chunks = chunks.withColumn("part", F.floor(F.col("block") / part_bytes))
    folder = workspace.new_path(spark, "file_parts")
    chunks.write.partitionBy("part").parquet(folder)
    chunks = spark.read.schema(chunks.schema).parquet(folder)

    sizes = {i: size for i, (_, size) in enumerate(files)}
    states, found, last = {}, {}, -1
    for row in chunks.groupBy("id").agg(F.sum("n").alias("n"), F.max("part").alias("last")).collect():
        begun, more = Sha256(), row["n"] - sizes[row["id"]]
        if more in (-3, -2):
            mark = pa.py_buffer(_MARK)
            begun.update(mark.address, mark.size)
        elif more not in (0, 1):  # one more: the break put behind a last line without one
            raise RuntimeError(f"{row['n']} bytes read, {sizes[row['id']]} wanted: {files[row['id']][0]}")
        states[row["id"]], last = begun.state, max(last, row["last"])
    for part in range(last + 1):
        left = sum(size > part * part_bytes for size in sizes.values())  # numbers of these: 0, 1, 2...
        rows = chunks.where(F.col("part") == part).select("id", "block", "place", "data")
        rows = rows.repartitionById(left, F.col("id").cast("int"))  # a task for each file, by no hash
        rows = rows.sortWithinPartitions("id", "block", "place").select("id", "data")
        for row in rows.mapInArrow(_going_on(states, sizes), "id long, state binary, sha256 string").collect():
            states[row["id"]], found[row["id"]] = bytes(row["state"]), row["sha256"]
    return [found[i] for i in sizes]


def file_digests(
    spark: SparkSession, path: str, most_bytes: int | None = None, part_bytes: int = PART_BYTES
) -> DataFrame:
    """(path, sha256) of every file under a path; a file over ``most_bytes``, if given, is an error.

    Spark lists no empty files, so these have no row. A file of up to ``part_bytes`` passes through
    one task. Larger ones are read in blocks by all tasks into a table, and a digest goes over that a
    part of each file at a time, when this is called: no task reads more than about a part, whatever
    the size and number of files, but the parts of one file come one after the other. The most that
    stands between two line breaks of a large file must fit in memory. Files that the text reader
    would unpack (PACKED) pass through one task, up to MOST_PACKED_BYTES; beyond that they are an error.
    """
    files = spark.read.format("binaryFile").load(path)
    large = F.concat(F.lit("too large to digest in one task: "), F.col("path"))
    in_parts = _in_parts(part_bytes)
    refused = ~in_parts & (F.col("length") > max(part_bytes, MOST_PACKED_BYTES))
    if most_bytes is not None:
        refused = refused | (F.col("length") > most_bytes)
    content = F.when(refused, F.raise_error(large)).otherwise(F.col("content"))
    found = files.where(~in_parts).select("path", F.sha2(content.cast("binary"), 256).alias("sha256"))
    size = F.when(refused, F.raise_error(large).cast("long")).otherwise(F.col("length"))
    listed = files.where(in_parts).select("path", F.col("_metadata.file_path").alias("file"), size.alias("length"))
    listed = sorted(listed.collect(), key=lambda r: -r["length"])
    if not listed:
        return found
    digests = _digests_in_parts(spark, path, [(r["file"], r["length"]) for r in listed], part_bytes)
    rows = [(r["path"], digest) for r, digest in zip(listed, digests, strict=True)]
    return found.unionAll(spark.createDataFrame(rows, "path string, sha256 string"))


def row_digest(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """MD5 of a row: every field with its length before it, null marked, so no two rows read alike."""
    fields = []
    for c in columns or df.columns:
        text = F.col(c).cast("string")
        framed = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        fields.append(F.coalesce(framed, F.lit("-")))
    return F.md5(F.concat_ws(",", *fields))


def digest_sums(digest: Column) -> list[Column]:
    """Aggregates: the row count, and two sums of 60 bits of each row's digest, as one text."""
    halves = [
        F.coalesce(F.sum(F.conv(F.substring(digest, start, 15), 16, 10).cast("decimal(38,0)")), F.lit(0))
        for start in (1, 16)
    ]
    both = F.concat_ws("-", *[h.cast("string") for h in halves])
    return [F.count("*").alias("n_rows"), both.alias("digest_sum")]


def content_fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Row count and digest sums that do not depend on row order or file layout.

    Every row is hashed on its own and the hashes add up, so the table is never gathered.
    """
    return df.agg(*digest_sums(row_digest(df, columns)))
