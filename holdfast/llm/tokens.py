"""Token counts: texts encoded in batches of equal bytes, only the lengths come back."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm.common import packed
from holdfast.llm.entries import entry, table

#: Bytes of a batch that the library encodes at once, about; characters of a piece of a long text.
BATCH = 1 << 18
PIECE = 1 << 16
#: Characters between which a blank may be a cut: ASCII, and letters of Latin, Greek, Cyrillic, Hebrew,
#: Arabic, Han, kana and Hangul that no normal form joins with a blank.
SAFE = "0-9A-Za-zÀ-ÖØ-öø-ɏΑ-ΡΣ-ωЁА-яёא-תء-ي一-鿿ぁ-ゖァ-ヺ가-힣"
#: Tokens of a context; longer texts are over the limit.
LIMIT = 4096


@dataclass(frozen=True)
class Encoder:
    """lengths: the number of tokens of each text of a list. cut: where a long text may be split.

    A text is split at a match of ``cut``, the match itself left out, if the tokens of its parts add
    up to those of the text; None: the text is never split.
    """

    lengths: Callable[[list[str]], list[int]]
    cut: re.Pattern | None


def _sentencepiece(path: str) -> Encoder:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    # A space between two other characters ends a piece if no piece goes on after one, and the part
    # after it is encoded as it stood: with one space, which the library puts before every text.
    inside = any(re.search("[^▁]▁", p) for p in pieces)
    starts = model.encode(" a", out_type=str) != model.encode("a", out_type=str)
    plain = model.encode("a", out_type=str)[:1] == ["▁a"] and model.encode("a  a") != model.encode("a a")
    safe = not inside and starts and plain

    def lengths(texts: list[str]) -> list[int]:
        return [len(ids) for ids in model.encode(texts, num_threads=1)]

    return Encoder(lengths, re.compile(f"(?<=[{SAFE}.,]) (?=[{SAFE}])") if safe else None)


def _tokenizers(path: str) -> Encoder:
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()

    def lengths(texts: list[str]) -> list[int]:
        return [len(e.ids) for e in model.encode_batch_fast(texts, add_special_tokens=False)]

    return Encoder(lengths, None)


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """The encoder of a vocabulary file, loaded once in each worker: .model or .json."""
    return _sentencepiece(path) if path.endswith(".model") else _tokenizers(path)


def pieces(text: str, cut: re.Pattern | None, size: int) -> list[str]:
    """The text in pieces of about so many characters, split where it is safe."""
    out, start = [], 0
    while cut is not None and len(text) - start > size:
        found = cut.search(text, start + size)
        if not found:
            break
        out.append(text[start : found.start()])
        start = found.end()
    out.append(text[start:])
    return out


def count_tokens(texts: Iterator[str], model: Encoder, size: int = PIECE, batch: int = BATCH) -> list[int]:
    """Tokens of each text. Batches hold about the same number of bytes, however long texts are."""
    counts: list[int] = []
    owner: list[int] = []
    waiting: list[str] = []
    held = 0

    def flush() -> None:
        for i, n in zip(owner, model.lengths(waiting), strict=True):
            counts[i] += n
        owner.clear()
        waiting.clear()

    for i, text in enumerate(texts):
        counts.append(0)
        for piece in pieces(text, model.cut, size):
            owner.append(i)
            waiting.append(piece)
            held += len(piece) if piece.isascii() else len(piece.encode())
            if held >= batch:
                flush()
                held = 0
    if waiting:
        flush()
    return counts


def with_tokens(docs: DataFrame, path: str) -> DataFrame:
    """All columns in ``_row``, with ``n_tokens``: as the library gives them, no token added.

    path: a vocabulary file that every executor has at the same place. Null counts as empty text; special
    strings inside texts are read as the library does by default. Long texts are encoded in pieces
    where the vocabulary allows, and a text without any blank, as in Chinese, in one. Repeated rows and
    ids give a row each, an empty table none; all columns stay in ``_row``.
    """

    @F.arrow_udf("bigint")
    def counted(texts: pa.Array) -> pa.Array:
        texts = pc.fill_null(texts, "")
        return pa.array(count_tokens((t.as_py() for t in texts), encoder(path)), pa.int64())

    return packed(docs).withColumn("n_tokens", counted(F.col("_row.text").cast("string")))


@entry("op7_tokens")
def op7_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    found = with_tokens(
        table(spark, sf_dir, "documents").select("doc_id", "text"),
        str(public_tokenizers.path("piece_bpe_32k.model")),
    )
    return found.select(
        F.col("_row.doc_id").alias("doc_id"),
        F.coalesce(F.octet_length(F.col("_row.text")), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > LIMIT).alias("over_limit"),
    )
