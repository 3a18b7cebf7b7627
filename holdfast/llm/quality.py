"""Quality rules, line first: bad lines go, then documents that lost too much."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm.common import packed, words
from holdfast.llm.entries import entry, table


@dataclass(frozen=True)
class Limits:
    """What the rules allow."""

    least_words: int = 20
    most_repeats: int = 30  # percent of the words
    window: int = 8
    most_symbols: float = 0.1  # of a line's characters
    most_capitals: float = 0.6  # of a line's letters, in lines of five letters or more
    most_cries: int = 3  # exclamation and question marks, where they outnumber stops
    open_words: int = 40  # a line of so many words must have some punctuation
    boilerplate: float = 0.2  # of a line's characters, from where on it is boilerplate
    menu_words: float = 3.0  # words between separators, on average, that make a menu
    most_lost: float = 0.5  # of a document's characters


LIMITS = Limits()

#: What boilerplate lines say, in lower case; English, French, German, Spanish.
BOILERPLATE = (
    "all rights reserved",
    "terms of use",
    "terms of service",
    "privacy policy",
    "cookie policy",
    "accept cookies",
    "accept all cookies",
    "enable javascript",
    "javascript is disabled",
    "javascript is required",
    "subscribe to our",
    "sign up for our",
    "click here",
    "read more",
    "powered by",
    "lorem ipsum",
    "licensed under",
    "skip to content",
    "skip to main content",
    "tous droits réservés",
    "conditions d'utilisation",
    "conditions générales",
    "politique de confidentialité",
    "accepter les cookies",
    "activer javascript",
    "abonnez-vous à notre",
    "cliquez ici",
    "lire la suite",
    "en savoir plus",
    "propulsé par",
    "aller au contenu",
    "alle rechte vorbehalten",
    "nutzungsbedingungen",
    "datenschutzerklärung",
    "cookies akzeptieren",
    "javascript aktivieren",
    "abonnieren sie unseren",
    "hier klicken",
    "klicken sie hier",
    "weiterlesen",
    "mehr erfahren",
    "zum inhalt springen",
    "bereitgestellt von",
    "todos los derechos reservados",
    "condiciones de uso",
    "términos de uso",
    "política de privacidad",
    "política de cookies",
    "aceptar cookies",
    "habilite javascript",
    "suscríbete a nuestro",
    "haga clic aquí",
    "haz clic aquí",
    "leer más",
    "saltar al contenido",
)
SYMBOLS = "#*$%&|<>"
SEPARATORS = (" | ", " > ", " » ", " › ", " · ", " • ", " / ")
STOPS = ".,!?…:;\"'”’)»。！？"


def line_fault(line: str, limits: Limits = LIMITS) -> str | None:
    """The rule that a line with a word fails: punctuation, navigation or boilerplate; else None."""
    bare = line.strip()
    n = len(bare)
    menu = sum(map(bare.count, SEPARATORS))
    if menu >= 2 and len(bare.split()) - menu <= limits.menu_words * (menu + 1):
        return "navigation"
    if sum(map(bare.count, SYMBOLS)) > limits.most_symbols * n:
        return "punctuation"
    cries = bare.count("!") + bare.count("?")
    if cries > limits.most_cries and cries > 2 * (bare.count(".") + bare.count(",")):
        return "punctuation"
    if cries > limits.most_cries and bare.upper() == bare:
        letters = sum(map(str.isalpha, bare))
        if letters >= 5 and sum(map(str.isupper, bare)) > limits.most_capitals * letters:
            return "punctuation"
    if n > 2 * limits.open_words and not any(map(bare.__contains__, STOPS)):
        if len(bare.split()) >= limits.open_words:
            return "punctuation"
    if boilerplate(bare) >= limits.boilerplate * n:
        return "boilerplate"
    return None


def boilerplate(line: str) -> int:
    """Characters of a line that boilerplate phrases take: one of them says little of a long line."""
    low = line.lower()
    return sum(len(p) * low.count(p) for p in BOILERPLATE if p in low)


def clean(text: str, limits: Limits = LIMITS) -> tuple[str, int, int]:
    """The text without failing lines and without repeated ones; characters before and after.

    Blank lines stay and do not count. Of equal lines the first stays.
    """
    kept, seen, before, after = [], set(), 0, 0
    for line in text.split("\n"):
        size = len(line)
        if not line.strip(" \t\n\x0b\x0c\r"):
            kept.append(line)
            continue
        before += size
        if line in seen or line_fault(line, limits):
            continue
        seen.add(line)
        after += size
        kept.append(line)
    return "\n".join(kept), before, after


def repeat_words(found: list[bytes], width: int) -> int:
    """Words that lie in a window of so many words (a power of two) found twice or more.

    Windows are told apart exactly: words are numbered, then pairs of neighbouring numbers, pairs of
    those, and so on until a number stands for a window.
    """
    n = len(found) - width + 1
    if n < 2:
        return 0
    # Equal windows have equal sums of hashes: without equal sums there is nothing to number.
    sums = np.fromiter(map(hash, found), np.int64, len(found)).view(np.uint64)
    span, factor = 1, 0x9E3779B97F4A7C15
    while span < width:
        sums = sums[:-span] * np.uint64(factor) + sums[span:]
        span, factor = span * 2, factor * factor % (1 << 64)
    sums.sort()
    if not (sums[1:] == sums[:-1]).any():
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in found), np.int64, len(found))
    span = 1
    while span < width:
        pairs = ids[:-span] * (int(ids.max()) + 1) + ids[span:]
        ids = np.unique(pairs, return_inverse=True)[1]
        span *= 2
    repeated = np.bincount(ids)[ids] > 1
    cover = np.zeros(len(found) + 1, np.int64)
    cover[:n] += repeated
    cover[width : width + n] -= repeated
    return int((np.cumsum(cover)[:-1] > 0).sum())


def measure(text: str | None, limits: Limits = LIMITS) -> dict:
    """All figures and verdicts of one text; null has no words and fails."""
    text = text or ""
    found = words(text)
    n_words = len(found)
    lines, seen, n_dup = text.split("\n"), set(), 0
    for line in lines:
        if line in seen:
            n_dup += 1
        elif line.strip(" \t\n\x0b\x0c\r"):
            seen.add(line)
    white = sum(map(text.count, " \t\n\x0b\x0c\r"))
    repeats = repeat_words(found, limits.window)
    failed = n_words < limits.least_words or 100 * repeats > limits.most_repeats * n_words
    cleaned, before, after = ("", 0, 0) if failed else clean(text, limits)
    kept = not failed and before - after <= limits.most_lost * before
    return {
        "n_words": n_words,
        "word_chars": len(text) - white,
        "n_symbols": sum(map(text.count, SYMBOLS)),
        "n_dup_lines": n_dup,
        "n_repeat_words": repeats,
        "base_failed": failed,
        "kept": kept,
        "cleaned": cleaned if kept else None,
    }


_KIND = (
    "struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,"
    "n_repeat_words:bigint,base_failed:boolean,kept:boolean,cleaned:string>"
)
_NUMBERS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_ARROW = pa.struct(
    [(c, pa.int64()) for c in _NUMBERS]
    + [("base_failed", pa.bool_()), ("kept", pa.bool_()), ("cleaned", pa.string())]
)


def with_quality(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """All columns in ``_row``, with the figures and verdicts of ``measure`` in ``quality``.

    ``cleaned`` has the text that is left of kept documents (null if ``with_text`` is false). Null
    and empty texts have no words and fail. Every row is judged on its own; repeats are alike.
    """

    @F.arrow_udf(_KIND)
    def judged(texts: pa.Array) -> pa.Array:
        rows = []
        for text in texts:
            row = measure(text.as_py())
            if not with_text:
                row["cleaned"] = None
            rows.append(row)
        return pa.array(rows, _ARROW)

    return packed(docs).withColumn("quality", judged(F.col("_row.text").cast("string")))


def clean_documents(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with their text cleaned. All columns are kept."""
    found = with_quality(docs).where("quality.kept")
    columns = [F.col("quality.cleaned") if c == "text" else F.col("_row")[c] for c in docs.columns]
    return found.select(*[x.alias(c) for x, c in zip(columns, docs.columns, strict=True)])


@entry("op2_quality")
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_quality(table(spark, sf_dir, "documents").select("doc_id", "text"), with_text=False)
    return found.select(F.col("_row.doc_id").alias("doc_id"), F.col("quality").dropFields("cleaned").alias("q")).select(
        "doc_id", "q.*"
    )
