from __future__ import annotations

import random

import public_tokenizers
import pytest
import sentencepiece

from conftest import SMALL
from holdfast.llm import tokens

PIECES = str(public_tokenizers.path("piece_bpe_32k.model"))
WHOLE = sentencepiece.SentencePieceProcessor(model_file=PIECES)


def whole(text):
    return len(WHOLE.encode(text or "", num_threads=1))


ODD = ["", " ", "  ", "a", " a", "a ", "<s> </s> <unk> <0x0A>", "é😀 ▁ ▁▁ x", "a\tb\nc  d", "\x00 \x01", "one" * 500, "漢字 かな 1 2 3"]


def test_odd_texts_are_counted_as_the_library_does():
    assert tokens.count_tokens(iter(ODD), tokens.encoder(PIECES)) == [whole(t) for t in ODD]


@pytest.mark.parametrize("size", [1, 7, 50])
def test_split_texts_count_the_same(size):
    draw = random.Random(size)
    parts = ["the", "Straße", "l'été", ".", ",", "  ", "   ", "\n", "▁", "12", "3.5", "a", "I", "z" * 30, "<s>", "😀", "\t", "x▁y"]
    texts = [" ".join(draw.choices(parts, k=200)) for _ in range(60)] + ["".join(draw.choices(parts, k=200)) for _ in range(20)]
    model = tokens.encoder(PIECES)
    assert model.cut is not None and any(len(tokens.pieces(t, model.cut, size)) > 3 for t in texts)
    assert tokens.count_tokens(iter(texts), model, size, 300) == [whole(t) for t in texts]


WORDS = {
    "cyrillic": "привет мир Ёлка вокзал", "greek": "καλημέρα κόσμε Ωραία", "arabic": "مرحبا بالعالم كتاب", "hebrew": "שלום עולם ספר",
    "hangul": "안녕 세상 책을", "latin": "Straße l'été año ŝi œuvre ĳs", "kana": "これは ペン です 漢字",
    "odd": "ﹰ ﱞ ¨ x\u0301 ͺ \u3000 ½ ﬁn Å № \u0301a",
}


@pytest.mark.parametrize("script", WORDS)
def test_long_texts_of_other_scripts_are_split(script):
    """A long text in words of other scripts comes in pieces, and counts as the library counts it."""
    draw = random.Random(script)
    text = " ".join(draw.choices(WORDS[script].split(" ") + ["and", "7", "."], k=4000))
    model = tokens.encoder(PIECES)
    assert len(tokens.pieces(text, model.cut, 200)) > 20
    assert tokens.count_tokens(iter([text]), model, 200, 5000) == [whole(text)]


def test_batches_are_balanced_by_bytes():
    sizes = []

    def lengths(texts):
        sizes.append(sum(len(t.encode()) for t in texts))
        return [1] * len(texts)

    mixed = [("ж" if i % 2 else "a") * 100 for i in range(4000)]
    tokens.count_tokens(iter(mixed), tokens.Encoder(lengths, None), 1 << 16, 10_000)
    assert all(10_000 <= n < 10_200 for n in sizes[:-1])


def test_query_and_split_documents(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    expected = sorted((i, len((t or "").encode()), whole(t), whole(t) > 4096) for i, t in docs)
    got = tokens.op7_tokens(spark, SMALL)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert sorted(map(tuple, got.collect())) == expected
    model = tokens.encoder(PIECES)
    assert tokens.count_tokens((t or "" for _, t in docs), model, 100) == [whole(t) for _, t in docs]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_json_vocabularies(name):
    from tokenizers import Tokenizer

    path = str(public_tokenizers.path(name))
    plain = Tokenizer.from_file(path)
    expected = [len(plain.encode(t, add_special_tokens=False).ids) for t in ODD]
    assert tokens.count_tokens(iter(ODD), tokens.encoder(path), 3, 5) == expected


def test_rows(spark):
    docs = spark.createDataFrame([(1, None, 9), (1, None, 9), (None, "a b", 8)], "doc_id long, text string, n_tokens int")
    got = tokens.with_tokens(docs, PIECES).collect()
    assert sorted((r["_row"]["n_tokens"], r["n_tokens"]) for r in got) == [(8, whole("a b")), (9, 0), (9, 0)]
    assert tokens.with_tokens(docs.limit(0), PIECES).collect() == []
