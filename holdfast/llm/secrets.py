"""Secrets in text: a trigram index picks the candidates of each rule, regular expressions verify."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm.common import packed, settle
from holdfast.llm.entries import entry, table
from holdfast.llm.trigrams import ANYTHING, Query, derive, ignores_case


#: Candidates up to this many are broadcast to the texts; beyond it both are joined by key.
BROADCAST = 1_000_000


@dataclass(frozen=True)
class Rule:
    """What to look for.

    pattern: a regular expression that Java and Python read alike. A match stays if its group has the
    least length.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 0

    @cached_property
    def query(self) -> Query:
        """The Boolean trigram query that a text with a match meets. No condition: the rule has no
        mandatory trigram and scans every text."""
        return derive(self.pattern)

    @cached_property
    def ignore_case(self) -> bool:
        """Whether the query is for the text in lower case of A-Z."""
        return ignores_case(self.pattern)


#: The patterns that every scan must report.
BASE_RULES = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]{24,}"),
)

#: A private key: from its BEGIN line to the END line, or, where there is none before the next such
#: line, over the headers and the lines of base64 that follow (line breaks may be escaped or blanks).
#: Repeats are possessive: they take no stack, however long the key.
_BEGIN, _END = r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----", r"-----END [A-Z ]{0,30}PRIVATE KEY-----"
_BREAK = r"(?:\s|\\[nr])"
_KEY = (
    rf"{_BEGIN}(?:[^-]*+(?:-(?!----)[^-]*+)*+{_END}"
    rf"|(?:{_BREAK}*+(?:Proc-Type|DEK-Info):[^\r\n\\]*+)*+"
    rf"(?:[\s>]*+(?:\\[nr])*+[A-Za-z0-9+/]{{16,}}+={{0,2}}+)*+"
    rf"(?:{_BREAK}++[A-Za-z0-9+/]{{1,15}}+={{0,2}}+(?=[\x20\t]*+(?:[\r\n]|\\[nr]|\Z)))?+)"
)

#: What the method finds beside them.
MORE_RULES = (
    Rule("private_key", _KEY),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("host_token", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abpr]-[A-Za-z0-9-]{10,}"),
    Rule("url_password", r"://[^\s:/@]{1,64}:[^\s:/@]{3,64}@"),
)
RULES = BASE_RULES + MORE_RULES


def _forms(rules: tuple[Rule, ...]) -> list[tuple[str, bool]]:
    """Every trigram that a query asks for, with whether it is asked for in lower case."""
    return sorted({(t, r.ignore_case) for r in rules for t in r.query.grams()})


def trigram_postings(texts: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The inverted index: (key, gram), a posting for each text and trigram it has.

    texts: (key, text). Only trigrams that some rule asks for are indexed: others are never read.
    Equal texts post equal rows; what reads the postings takes sets of them.
    """
    # Lower case of A-Z only: what rules that ignore case match.
    folded = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    lower = texts.select("key", "text", folded.alias("lower"))
    has = [
        F.when(F.contains(F.col("lower" if fold else "text"), F.lit(t)), F.lit(i))
        for i, (t, fold) in enumerate(_forms(rules))
    ]
    gram = F.explode(F.array_compact(F.array(*has)))
    return lower.select("key", gram.alias("gram"))


def _met(query: Query, number: dict[str, int]) -> Column:
    """Whether the array ``grams`` meets a query."""
    if query.kind == "gram":
        return F.array_contains("grams", number[query.gram])
    parts = [_met(p, number) for p in sorted(query.parts, key=repr)]
    return reduce(and_ if query.kind == "all" else or_, parts)


def candidates(postings: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(key, asked): the rules whose Boolean query a text meets, by intersecting postings; a bit each.

    One pass over the postings: those of a key are gathered (no more than the queries' trigrams) and
    each query is a test of that set.
    """
    forms = _forms(rules)
    held = postings.groupBy("key").agg(F.collect_set("gram").alias("grams"))
    asked = F.lit(0).cast("long")
    for rank, rule in enumerate(rules):
        if rule.query != ANYTHING:
            number = {t: i for i, (t, fold) in enumerate(forms) if fold == rule.ignore_case}
            asked = asked + F.when(_met(rule.query, number), 1 << rank).otherwise(0).cast("long")
    return held.select("key", asked.alias("asked")).where("asked <> 0")


def rule_spans(text: Column, rule: Rule, rank: int) -> Column:
    """Spans (start, rank, end) of a rule's matches in a text, in code points, end exclusive.

    Splitting by the pattern gives what lies between the matches, extracting gives the matches; the
    lengths of both, added up in turn, are the places.
    """
    pattern = F.lit(rule.pattern)
    lengths = F.arrays_zip(
        F.transform(F.split(text, rule.pattern), F.length).alias("gap"),
        F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length).alias("own"),
        F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length).alias("held"),
    )
    kind = "struct<at:int,spans:array<struct<start:int,rank:int,end:int>>>"
    none = F.from_json(F.lit('{"at":0,"spans":[]}'), kind)

    def step(state: Column, part: Column) -> Column:
        start = state["at"] + part["gap"]
        end = start + F.coalesce(part["own"], F.lit(0))
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"))
        found = F.when(part["held"] >= rule.least, F.array_append(state["spans"], span))
        return F.struct(end.alias("at"), F.coalesce(found, state["spans"]).alias("spans"))

    any_match = F.regexp_like(text, pattern)
    empty = F.array().cast("array<struct<start:int,rank:int,end:int>>")
    return F.when(any_match, F.aggregate(lengths, none, step)["spans"]).otherwise(empty)


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All columns in ``_row``, with ``spans``: (start, rank, end) sorted; rank is the rule's place.

    The index names the texts each rule must verify; rules without mandatory trigrams scan every
    text. Texts are keyed by a hash: equal texts share postings, and should two different texts ever
    meet under one key, each is merely verified for the other's rules too. Null and empty texts have
    no spans; texts are searched whole, however long. Repeated rows and ids give a row each, an empty
    table none; other columns may have any names.

    Up to BROADCAST candidate keys go to the texts, which then do not move; beyond that both are
    joined by key, and Spark splits what a frequent text brings together.
    """
    if len(rules) > 62:
        raise ValueError("62 rules at most go into one scan")
    rows = packed(docs).withColumn("text", F.coalesce(F.col("_row.text").cast("string"), F.lit("")))
    rows = rows.withColumn("key", F.xxhash64("text"))
    named = settle(candidates(trigram_postings(rows.select("key", "text"), rules), rules), "candidates")
    if named.count() <= BROADCAST:
        named = F.broadcast(named)
    joined = rows.join(named, "key", "left")
    found = []
    for rank, rule in enumerate(rules):
        own = rule_spans(F.col("text"), rule, rank)
        if rule.query != ANYTHING:
            asked = F.coalesce("asked", F.lit(0)).bitwiseAND(F.lit(1 << rank).cast("long")) != 0
            own = F.when(asked, own).otherwise(F.array().cast("array<struct<start:int,rank:int,end:int>>"))
        found.append(own)
    return joined.select("_row", F.array_sort(F.concat(*found)).alias("spans"))


def span_text(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    one = lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"], s["end"])
    return F.array_join(F.transform(spans, one), ",")


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[secret]") -> DataFrame:
    """The documents, with every span replaced by a mark; overlapping spans share one.

    Documents without secrets are unchanged. All columns are kept; ``n_chars``, where there is one,
    is counted again in the documents that change.
    """
    found = find_secrets(docs, rules)
    text = F.col("_row.text").cast("string")
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, span: Column) -> Column:
        gap = F.substring(text, state["at"] + 1, F.greatest(span["start"] - state["at"], F.lit(0)))
        fresh = F.concat(state["out"], gap, F.lit(mark))
        out = F.when((span["start"] < state["at"]), state["out"]).otherwise(fresh)
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), out.alias("out"))

    last = F.aggregate("spans", begin, step)
    rest = F.concat(last["out"], F.substring(text, last["at"] + 1, F.length(text)))
    clean = F.when(F.size("spans") > 0, rest).otherwise(text)
    found = found.withColumn("_clean", clean)
    changes = {"text": F.col("_clean")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        counted = F.when(F.size("spans") > 0, F.length("_clean").cast(kind))
        changes["n_chars"] = F.coalesce(counted, F.col("_row.n_chars"))
    return found.select(*[changes.get(c, F.col("_row")[c]).alias(c) for c in docs.columns])


@entry("op6_secrets")
def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["rank"] < len(BASE_RULES))

    def of_rank(k: int) -> Column:
        # One argument only: to a function of two, filter gives each span's place as the second.
        return F.size(F.filter("spans", lambda s: s["rank"] == k)).cast("long")

    counts = [of_rank(k).alias(f"n_{rule.kind}") for k, rule in enumerate(BASE_RULES)]
    return found.select(
        F.col("_row.doc_id").alias("doc_id"),
        *counts,
        F.sha2(span_text(base), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
    )
