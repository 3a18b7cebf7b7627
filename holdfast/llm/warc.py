"""WARC archives: written as text, read in blocks, with record boundaries verified along the chain."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from holdfast.llm.common import packed, settle
from holdfast.llm.entries import entry, table
from holdfast.workspace import new_path

#: Fixed values of the format.
MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Shorter payloads are written in full, however often they occur.
LEAST_REVISIT = 100
#: One date for all records, so that the same pages give the same archive.
DATE = "1970-01-01T00:00:00Z"
NAME = "urn:page:"
#: A length with more digits is none: places in a file are longs.
DIGITS = 18
#: Bytes of a file in which pieces look for the record they belong to.
STRETCH = 1 << 20


def _revisits(pages: DataFrame) -> DataFrame:
    """(page_id, digest, first): pages whose payload a smaller page_id has too. A small table."""
    payload = F.coalesce(pages["html"].cast("string"), F.lit(""))
    keys = settle(
        pages.select(
            pages["page_id"].cast("long").alias("page_id"),
            F.sha2(payload, 256).alias("digest"),
            F.octet_length(payload).alias("size"),
        ).where(F.col("size") >= LEAST_REVISIT).drop("size"),
        "digests",
    )
    firsts = keys.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    firsts = firsts.where("n > 1 and first is not null").drop("n")
    found = keys.join(firsts, "digest").where(~F.col("page_id").eqNullSafe(F.col("first")))
    return settle(found.distinct(), "revisits")


def write_archive(pages: DataFrame, path: str) -> None:
    """A folder of WARC files, a record per row of pages (page_id, url, html), written where rows are.

    Of payloads of at least LEAST_REVISIT bytes that are equal, the smallest page_id is a response
    and the others revisit it. Equal payloads of one page_id are all responses; a null id never
    gives the response if another row has an id. A null html is an empty payload.
    """
    rows = packed(pages).select(
        F.col("_row.page_id").cast("long").alias("page_id"),
        F.col("_row.url").cast("string").alias("url"),
        F.coalesce(F.col("_row.html").cast("string"), F.lit("")).alias("payload"),
    )
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    again = _revisits(pages).toDF("_digest", "_page_id", "first")
    same = (F.col("digest") == F.col("_digest")) & F.col("page_id").eqNullSafe(F.col("_page_id"))
    rows = rows.join(again, same, "left")
    is_again = F.col("first").isNotNull()
    block = F.when(is_again, F.lit("")).otherwise(F.col("payload"))

    def name(page_id: Column) -> Column:
        return F.concat(F.lit(f"<{NAME}"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))

    fields = [
        ("WARC-Type", F.when(is_again, "revisit").otherwise("response")),
        ("WARC-Record-ID", name(F.col("page_id"))),
        ("WARC-Date", F.lit(DATE)),
        ("WARC-Target-URI", F.regexp_replace("url", r"\s", "%20")),
        ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        ("WARC-Profile", F.when(is_again, F.lit(REVISIT))),
        ("WARC-Refers-To", F.when(is_again, name(F.col("first")))),
        ("Content-Type", F.lit("text/html")),
        ("Content-Length", F.octet_length(block).cast("string")),
    ]
    lines = [F.concat(F.lit(f"{field}: "), value) for field, value in fields]  # null: no line
    record = F.concat(F.lit(MAGIC), F.concat_ws("\r\n", *lines), F.lit(END), block)
    rows.select(record.alias("value")).write.option("lineSep", END).text(path)


def parse_head(piece: bytes) -> tuple[dict[str, str], int] | None:
    """The fields of a record whose magic has been cut off, and where its block begins."""
    end = piece.find(END.encode())
    if end < 0:
        return None
    fields = {}
    for line in piece[:end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    length = fields.get("content-length", "")
    if not length.isascii() or not length.isdigit() or len(length.lstrip("0")) > DIGITS:
        return None
    fields["content-length"] = length.lstrip("0") or "0"
    return fields, end + len(END)


_CANDIDATE = pa.schema([
    ("file", pa.string()), ("block", pa.int64()), ("at", pa.int64()), ("size", pa.int64()),
    ("next", pa.int64()), ("exit", pa.int64()), ("type", pa.string()), ("id", pa.string()),
    ("refers_to", pa.string()), ("stated", pa.string()), ("head", pa.int64()),
    ("payload_bytes", pa.int64()), ("digest", pa.string()),
])
_CANDIDATE_SQL = (
    "file string, block long, at long, size long, next long, exit long, type string, id string, "
    "refers_to string, stated string, head long, payload_bytes long, digest string"
)


def _candidate(piece: bytes, at: int) -> dict:
    """What a piece claims to be. next: where the record after it must begin; null if it is none."""
    row = {"at": at, "size": len(piece)}
    head = parse_head(piece)
    if head is None:
        return row
    fields, begin = head
    length = int(fields["content-length"])
    row |= {
        "next": at + begin + length + len(END) + len(MAGIC),
        "type": fields.get("warc-type"),
        "id": fields.get("warc-record-id"),
        "refers_to": fields.get("warc-refers-to"),
        "stated": fields.get("warc-payload-digest", "").removeprefix("sha256:"),
        "head": begin,
        "payload_bytes": length,
    }
    if begin + length <= len(piece):
        row["digest"] = hashlib.sha256(piece[begin : begin + length]).hexdigest()
    return row


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates of each block, with the place where the chain through each leaves the block.

    Places count from the block's first piece: at is where a piece begins, after its magic.
    """

    def leave(rows: list[dict], file: str, block: int) -> pa.RecordBatch:
        exits: dict[int, int | None] = {}
        for row in reversed(rows):
            follow = row.get("next")
            row["exit"] = exits[row["at"]] = exits.get(follow, follow)
            row["file"], row["block"] = file, block
        return pa.RecordBatch.from_pylist(rows, schema=_CANDIDATE)

    key, rows, at = None, [], 0
    for batch in batches:
        for file, block, piece in zip(*(batch[c] for c in ("file", "block", "piece")), strict=True):
            here = file.as_py(), block.as_py()
            if here != key:
                if rows:
                    yield leave(rows, *key)
                key, rows, at = here, [], 0
            piece = piece.as_py()
            if here[1] or at:  # what stands before a file's first magic is no record
                rows.append(_candidate(piece, at))
            at += len(piece) + len(MAGIC)
    if rows:
        yield leave(rows, *key)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, piece): what lies between the magics of the archives, in order within a block.

    The text reader cuts anywhere at a magic, so files are read in blocks like any other text.
    """
    lines = spark.read.option("lineSep", MAGIC).text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("piece"),
    )


def _bases(pieces: DataFrame) -> DataFrame:
    """(file, block, base): where a block's first piece begins in its file. A row per block."""
    size = F.octet_length("piece") + len(MAGIC)
    sums = pieces.groupBy("file", "block").agg(F.sum(size).alias("s"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("file", "block", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("base"))


def _walk(table: pa.Table) -> pa.Table:
    """The candidates of a block that the chain from its entries reaches."""
    rows = {r["at"]: r for r in table.to_pylist()}
    kept = []
    for row in rows.values():
        at = row["at"] if row["entry"] else None
        while at in rows and not rows[at].get("seen"):
            rows[at]["seen"] = True
            kept.append(rows[at])
            at = rows[at]["next"]
    return pa.Table.from_pylist(kept, schema=table.schema)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of the archives at a path: (file, at, type, id, refers_to, stated, payload_bytes, digest).

    Tasks emit every place after a magic as a candidate, with the place where its successor would
    be. Only what is reached from the start of a file is a record: a magic inside a payload is not.
    Within a block the chain is followed by the task; between blocks pointers are doubled, so the
    rounds grow with the logarithm of the blocks of a file. at is the place after the record's magic;
    digest is the SHA-256 of the payload as read, wherever magics cut it.
    """
    pieces = _pieces(spark, path)
    rows = pieces.mapInArrow(_scan, _CANDIDATE_SQL).join(_bases(pieces), ["file", "block"])
    for place in ("at", "next", "exit"):
        rows = rows.withColumn(place, F.col(place) + F.col("base"))
    candidates = settle(rows.drop("base"), "candidates")

    jump = candidates.select("file", "at", F.col("exit").alias("to")).where("to is not null")
    reached = candidates.select("file", F.lit(len(MAGIC)).cast("long").alias("at")).distinct()
    reached, known = settle(reached, "reached"), -1
    while (count := reached.count()) > known:
        known = count
        further = reached.join(jump, ["file", "at"]).select("file", F.col("to").alias("at"))
        reached = settle(reached.unionAll(further).distinct(), "reached")
        second = jump.select("file", F.col("at").alias("to"), F.col("to").alias("_to"))
        jump = settle(jump.join(second, ["file", "to"]).select("file", "at", F.col("_to").alias("to")), "jump")

    entries = reached.withColumn("entry", F.lit(True))
    marked = candidates.join(entries, ["file", "at"], "left").withColumn("entry", F.coalesce("entry", F.lit(False)))
    kind = ", ".join(f"{c} {t}" for c, t in marked.dtypes)
    chain = settle(marked.groupBy("file", "block").applyInArrow(_walk, kind).drop("entry"), "chain")
    whole = chain.where("digest is not null")
    torn = chain.where("digest is null")
    if not torn.isEmpty():
        whole = whole.unionByName(_mended(spark, path, candidates, torn))
    columns = ["file", "at", "type", "id", "refers_to", "stated", "payload_bytes", "digest"]
    return whole.select(*columns)


def _mended(spark: SparkSession, path: str, candidates: DataFrame, torn: DataFrame) -> DataFrame:
    """The records whose payload holds magics, with digests over all their pieces.

    Records lie side by side, so a piece finds its own by place: both meet in stretches of the file
    that they touch. Only the pieces of such records are read again and moved. They come to the
    digest in order, one at a time: a record is never put together, however many magics it holds.
    """
    begins = torn.select("file", F.col("at").alias("own"), F.col("next").alias("end"), "head", "payload_bytes")
    touched = F.explode(F.sequence(F.floor(F.col("own") / STRETCH), F.floor(F.col("end") / STRETCH)))
    ranges = begins.withColumn("stretch", touched)
    marks = candidates.select("file", "at", F.floor(F.col("at") / STRETCH).alias("stretch"))
    owned = marks.join(ranges, ["file", "stretch"]).where("at >= own and at < end")
    owned = settle(owned.select("file", "at", "own", "head", "payload_bytes"), "owned")
    pieces = _pieces(spark, path)
    placed = pieces.mapInArrow(_place, "file string, block long, at long, piece binary")
    placed = placed.join(_bases(pieces), ["file", "block"]).withColumn("at", F.col("at") + F.col("base"))
    parts = placed.select("file", "at", "piece").join(owned, ["file", "at"]).drop("block")
    parts = parts.repartition("file", "own").sortWithinPartitions("file", "own", "at")
    digests = parts.select("file", "own", "head", "payload_bytes", "piece").mapInArrow(
        _digested, "file string, at long, digest string"
    )
    return torn.drop("digest").join(digests, ["file", "at"])


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each record's payload, from its pieces in order with a magic between them."""

    def done(key: tuple, state) -> pa.RecordBatch:
        columns = [pa.array([key[0]]), pa.array([key[1]], pa.int64()), pa.array([state.hexdigest()])]
        return pa.RecordBatch.from_arrays(columns, names=["file", "at", "digest"])

    key, state, place = None, None, 0
    for batch in batches:
        for file, own, head, length, piece in zip(*(batch[c].to_pylist() for c in batch.schema.names), strict=True):
            if (file, own) != key:
                if key is not None:
                    yield done(key, state)
                key, state, place = (file, own), hashlib.sha256(), 0
            else:
                piece = MAGIC.encode() + piece
            state.update(piece[max(0, head - place) : max(0, head + length - place)])
            place += len(piece)
    if key is not None:
        yield done(key, state)


def _place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces with their place, from the block's first piece."""
    key, at = None, 0
    for batch in batches:
        places = []
        for file, block, piece in zip(*(batch[c] for c in ("file", "block", "piece")), strict=True):
            here = file.as_py(), block.as_py()
            if here != key:
                key, at = here, 0
            places.append(at)
            at += len(piece.as_buffer()) + len(MAGIC)
        columns = [batch["file"], batch["block"], pa.array(places, pa.int64()), batch["piece"]]
        yield pa.RecordBatch.from_arrays(columns, names=["file", "block", "at", "piece"])


def page_records(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) per record of an archive.

    A revisit has the size and digest of the payload it refers to, as read from that response; one
    whose response is not in the archive gives no row. A record whose id is no page's has a null
    page_id. Repeated records give a row each; an archive without records, none. What a payload holds
    never matters: a magic or a length inside it is not followed.
    """
    number = lambda c: F.regexp_extract(c, f"<{NAME}(-?[0-9]+)>", 1).try_cast("long")
    records = settle(
        read_records(spark, path).select(
            number(F.col("id")).alias("page_id"),
            "payload_bytes",
            F.col("digest").alias("payload_digest"),
            F.col("type").alias("record_type"),
            number(F.col("refers_to")).alias("refers_to"),
            "stated",
        ),
        "records",
    )
    responses = records.where("record_type = 'response'").drop("stated")
    full = responses.select(
        F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("stated"), F.col("payload_bytes").alias("n")
    ).distinct()
    again = records.where("record_type = 'revisit'").join(full, ["refers_to", "stated"])
    again = again.select(
        "page_id", F.col("n").alias("payload_bytes"), F.col("stated").alias("payload_digest"), "record_type", "refers_to"
    )
    return responses.unionByName(again)


SQL = f"""
with payloads as (
  select page_id, coalesce(html, '') as payload, strlen(coalesce(html, '')) as size from pages
),
firsts as (
  select *, case when size >= {LEAST_REVISIT} then min(page_id) over (partition by payload) else page_id end as first
  from payloads
)
select page_id, size::bigint as payload_bytes, sha256(payload) as payload_digest,
  case when first = page_id then 'response' else 'revisit' end as record_type,
  case when first <> page_id then first end as refers_to
from firsts
"""


@entry("op4_warc", SQL)
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "archive")
    write_archive(table(spark, sf_dir, "pages"), path)
    return page_records(spark, path)
