"""Exact, seeded, stratified splits and folds, decided by the order of an id hash.

Every class is ordered by ``md5(seed:id)`` and cut at its quotas. Only the hash values at the
cuts are looked up (a few counting jobs over hash prefixes); the assignment itself is then a
projection with no window and no shuffle, whatever the number of rows.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.functions.labels import label_binary
from holdfast.spec import LabelSpec, ModelingSpec, SplitSpec

SPLIT_NAMES = ("train", "validation", "test")
#: Prefix counts that one counting job brings back, about. Many classes get shorter prefixes.
COUNTS = 200_000
#: Hash digits examined per counting job, at most: 16**3 prefixes of each class.
DIGITS = 3
#: Prefix groups with no more rows than this are listed row by row.
LIST_LIMIT = 20_000
#: Up to this many classes the cuts are literals; more are joined as a table of a row per class.
LITERAL_CLASSES = 50


def id_hash(id_column: str, seed: int) -> Column:
    """Hash that orders the rows: independent of partitioning and row order."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_column).cast("string")))


def apportion(counts: Mapping[str, int], draw: int) -> dict[str, int]:
    """Share ``draw`` rows over the classes in proportion, by largest remainder."""
    n = sum(counts.values())
    exact = {c: counts[c] * draw / n for c in counts}
    given = {c: math.floor(x) for c, x in exact.items()}
    left = draw - sum(given.values())
    by_remainder = sorted(counts, key=lambda c: (given[c] - exact[c], c))
    for c in by_remainder[:left]:
        given[c] += 1
    return given


def split_quotas(counts: Mapping[str, int], spec: SplitSpec) -> dict[str, dict[str, int]]:
    """Rows per class and split: the test share first, then validation out of the rest."""
    for c, k in counts.items():
        if k < 2:
            raise ValueError(f"class {c!r} has fewer than 2 rows")
    n = sum(counts.values())
    n_test = math.ceil(n * spec.test)
    rest = apportion(counts, n - n_test)
    n_validation = math.ceil((n - n_test) * (spec.validation / (spec.train + spec.validation)))
    n_train = n - n_test - n_validation
    if min(n_test, n_validation, n_train) < len(counts):
        raise ValueError("too few rows to put every class into every split")
    train = apportion(rest, n_train)
    return {
        c: {
            "test": counts[c] - rest[c],
            "validation": rest[c] - train[c],
            "train": train[c],
        }
        for c in counts
    }


def fold_quotas(counts: Mapping[str, int], folds: int) -> dict[str, list[int]]:
    """Rows per class and fold: classes laid end to end and dealt out in turn."""
    if max(counts.values()) < folds:
        raise ValueError(f"no class has {folds} rows, so {folds} folds cannot be stratified")
    dealt: dict[str, list[int]] = {}
    start = 0
    for c in sorted(counts):
        end = start + counts[c]
        dealt[c] = [len(range(start + (i - start) % folds, end, folds)) for i in range(folds)]
        start = end
    return dealt


def _digits(classes: int) -> int:
    """Prefix length that keeps the counts of all classes near COUNTS; one digit at least."""
    return max(1, min(DIGITS, int(math.log(max(16, COUNTS / max(1, classes)), 16))))


def _prefix_counts(keyed: DataFrame, digits: int) -> list:
    """Rows per class and hash prefix: 16 ** digits rows for each class at most."""
    prefix = F.substring("h", 1, digits).alias("prefix")
    return keyed.groupBy("cls", prefix).agg(F.count("*").alias("n")).collect()


def _first_counts(keyed: DataFrame) -> tuple[list, dict[str, int]]:
    """Prefix counts to begin with, and rows per class. A row without an id or a label is an error."""
    facts = keyed.groupBy("cls").agg(F.count("*").alias("n"), F.count("h").alias("with_id")).collect()
    lost = sum(r["n"] - r["with_id"] for r in facts)
    if lost:
        raise ValueError(f"{lost} rows have no id: cannot place them")
    counts = _checked({r["cls"]: r["n"] for r in facts})
    return _prefix_counts(keyed, _digits(len(counts))), counts


def _within(keyed: DataFrame, spots: set[tuple[str, str]], digits: int) -> DataFrame:
    """Rows of the given (class, prefix) pairs, all prefixes of one length: a few per class."""
    listed = keyed.sparkSession.createDataFrame(sorted(spots), "cls string, prefix string")
    near = keyed.withColumn("prefix", F.substring("h", 1, digits))
    return near.join(F.broadcast(listed), ["cls", "prefix"], "left_semi").drop("prefix")


def _cut_hashes(
    keyed: DataFrame, first: list, ranks: Mapping[str, Sequence[int]]
) -> dict[tuple[str, int], str]:
    """Hash of the rank-th row of each class, for every rank asked for."""
    # (class, rank) -> (prefix known so far, rows of the class before that prefix)
    where = {(c, k): ("", 0) for c, ks in ranks.items() for k in ks if k > 0}
    found: dict[tuple[str, int], str] = {}
    counts = first
    digits = len(first[0]["prefix"]) if first else DIGITS
    step = digits
    while where:
        listed: set[tuple[str, str]] = set()
        deeper: set[tuple[str, str]] = set()
        by_class: dict[str, list[tuple[str, int]]] = {}
        for r in sorted(counts, key=lambda r: (r["cls"], r["prefix"])):
            by_class.setdefault(r["cls"], []).append((r["prefix"], r["n"]))
        for spot, (prefix, before) in where.items():
            cls, rank = spot
            for longer, n in by_class.get(cls, []):
                if not longer.startswith(prefix):
                    continue
                if before + n >= rank:
                    where[spot] = (longer, before)
                    (listed if n <= LIST_LIMIT or digits >= 32 else deeper).add((cls, longer))
                    break
                before += n
        if listed:
            near: dict[str, list[tuple[str, int]]] = {}
            rows = _within(keyed, listed, digits).groupBy("cls", "h").agg(F.count("*").alias("n"))
            for r in sorted(rows.collect(), key=lambda r: (r["cls"], r["h"])):
                near.setdefault(r["cls"], []).append((r["h"], r["n"]))
            for spot in [s for s, (p, _) in where.items() if (s[0], p) in listed]:
                cls, rank = spot
                prefix, before = where.pop(spot)
                for h, n in near[cls]:
                    if not h.startswith(prefix):
                        continue
                    before += n
                    if before >= rank:
                        found[spot] = h
                        break
        if where:
            inside = _within(keyed, deeper, digits)
            digits = min(digits + step, 32)
            counts = _prefix_counts(inside, digits)
    return found


def _keyed(df: DataFrame, id_column: str, class_column: str, seed: int) -> DataFrame:
    return df.select(
        F.col(class_column).cast("string").alias("cls"), id_hash(id_column, seed).alias("h")
    )


def _assign(
    df: DataFrame,
    class_column: str,
    h: Column,
    parts: Mapping[str, Sequence[tuple[object, str | None]]],
    rest: object,
    name: str,
) -> DataFrame:
    """Add the first part of the row's class whose cut hash is not passed; ``rest`` beyond the last.

    With few classes the cuts are literals and nothing is joined; with many they are a table of one
    row per class, broadcast.
    """
    cls = F.col(class_column).cast("string")
    if len(parts) > LITERAL_CLASSES:
        rows = [(c, [cut for _, cut in ends]) for c, ends in sorted(parts.items())]
        cuts = df.sparkSession.createDataFrame(rows, "_cls string, _cuts array<string>")
        joined = df.join(F.broadcast(cuts), cls == F.col("_cls"), "left")
        chosen = None
        for i, (part, _) in enumerate(next(iter(parts.values()))):
            test = h <= F.col("_cuts")[i]
            chosen = F.when(test, F.lit(part)) if chosen is None else chosen.when(test, F.lit(part))
        return joined.select(*[df[c] for c in df.columns], chosen.otherwise(F.lit(rest)).alias(name))
    chosen: Column | None = None
    for c in sorted(parts):
        for part, cut in parts[c]:
            if cut is None:
                continue
            test = (cls == c) & (h <= cut)
            chosen = F.when(test, F.lit(part)) if chosen is None else chosen.when(test, F.lit(part))
    return df.withColumn(name, F.lit(rest) if chosen is None else chosen.otherwise(F.lit(rest)))


def _checked(counts: dict) -> dict[str, int]:
    if not counts:
        raise ValueError("no rows to split")
    if None in counts:
        raise ValueError(f"{counts[None]} rows have no label: cannot stratify")
    return counts


def stratified_split(
    df: DataFrame, id_column: str, label_column: str, spec: SplitSpec = SplitSpec()
) -> DataFrame:
    """The rows with a ``split`` column: train, validation or test. Ids must be unique."""
    keyed = _keyed(df, id_column, label_column, spec.seed)
    first, counts = _first_counts(keyed)
    quotas = split_quotas(counts, spec)
    ranks = {c: (q["test"], q["test"] + q["validation"]) for c, q in quotas.items()}
    cuts = _cut_hashes(keyed, first, ranks)
    parts = {
        c: [("test", cuts.get((c, a))), ("validation", cuts.get((c, b)))]
        for c, (a, b) in ranks.items()
    }
    return _assign(df, label_column, id_hash(id_column, spec.seed), parts, "train", "split")


def stratified_folds(
    df: DataFrame, id_column: str, label_column: str, folds: int, seed: int = 42
) -> DataFrame:
    """The rows with a ``fold`` column, 0 to folds - 1, class shares kept. Ids must be unique."""
    keyed = _keyed(df, id_column, label_column, seed)
    first, counts = _first_counts(keyed)
    quotas = fold_quotas(counts, folds)
    upto = {c: [sum(q[: i + 1]) for i in range(folds - 1)] for c, q in quotas.items()}
    cuts = _cut_hashes(keyed, first, upto)
    parts = {c: [(i, cuts.get((c, k))) for i, k in enumerate(ks)] for c, ks in upto.items()}
    folded = _assign(df, label_column, id_hash(id_column, seed), parts, folds - 1, "fold")
    return folded.withColumn("fold", F.col("fold").cast("int"))


def literal_column(spark: SparkSession, name: str, values: Sequence) -> DataFrame:
    """A short fixed list of values as a one-column table, with its position."""
    listed = F.posexplode(F.array(*[F.lit(v) for v in values]))
    return spark.range(1).select(listed.alias("position", name))


def assert_quotas(split: DataFrame, label_column: str, spec: SplitSpec) -> None:
    """ValueError when a written split misses its exact sizes: its ids are not unique, then.

    One count per class and split reaches the driver.
    """
    cls = F.col(label_column).cast("string").alias("cls")
    sizes = {(r["cls"], r["split"]): r["n"] for r in split.groupBy(cls, "split").agg(F.count("*").alias("n")).collect()}
    counts: dict[str, int] = {}
    for (c, _), n in sizes.items():
        counts[c] = counts.get(c, 0) + n
    quotas = split_quotas(counts, spec)
    off = {k: (sizes.get((c, k), 0), n) for c, q in quotas.items() for k, n in q.items() if sizes.get((c, k), 0) != n}
    if off:
        raise ValueError(f"split sizes and quotas differ (found, wanted): {off}; ids repeat")


def split_manifest(split: DataFrame, label: LabelSpec) -> DataFrame:
    """Rows and positive rate (6 digits) of each split; an empty split has rate 0."""
    sizes = split.groupBy("split").agg(
        F.count("*").alias("n_rows"), F.avg(label_binary(label)).alias("rate")
    )
    names = literal_column(split.sparkSession, "split", SPLIT_NAMES)
    return names.join(sizes, "split", "left").select(
        "split",
        F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"),
        F.round(F.coalesce("rate", F.lit(0.0)), 6).alias("positive_rate"),
    )


def split_integrity(split: DataFrame, spec: ModelingSpec) -> DataFrame:
    """One row per check: ids in more than one split, unassigned rows, class-rate gaps."""
    y = label_binary(spec.label)
    known = [F.col("split") == s for s in SPLIT_NAMES]
    # One bit per split: numbers, unlike names, are combined in a hash aggregate.
    bits = sum((F.when(k, 2**i).otherwise(0) for i, k in enumerate(known)), F.lit(0))
    per_id = split.groupBy(spec.id_column).agg(F.bit_or(bits).alias("seen"))
    overlap = per_id.agg(F.count_if(F.bit_count("seen") > 1).alias("value")).select(
        F.lit("ids_in_two_splits").alias("check"), F.col("value").cast("double")
    )
    facts = split.agg(
        F.count("*").alias("n"),
        *[F.sum(k.cast("long")).alias(f"n_{s}") for k, s in zip(known, SPLIT_NAMES)],
        F.avg(y).alias("rate"),
        *[F.avg(F.when(k, y)).alias(f"rate_{s}") for k, s in zip(known, SPLIT_NAMES)],
    )
    placed = sum((F.coalesce(f"n_{s}", F.lit(0)) for s in SPLIT_NAMES), F.lit(0))
    wide = facts.select(
        (F.col("n") - placed).cast("double").alias("rows_without_split"),
        *[
            F.round(F.abs(F.col(f"rate_{s}") - F.col("rate")), 6).alias(f"rate_gap_{s}")
            for s in SPLIT_NAMES
        ],
    )
    return overlap.unionByName(wide.unpivot([], wide.columns, "check", "value"))


def split_overlap(split: DataFrame, id_column: str, left: str, right: str) -> DataFrame:
    """Ids present in both of two splits; empty for a sound split."""
    a = split.where(F.col("split") == left).select(id_column)
    b = split.where(F.col("split") == right).select(id_column)
    return a.intersect(b)


def replicate_rows(df: DataFrame, copies: int, id_column: str) -> DataFrame:
    """Every row ``copies`` times, ids made unique by the suffix ``_b<copy>``."""
    numbered = df.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    new_id = F.concat(F.col(id_column).cast("string"), F.lit("_b"), F.col("_copy").cast("string"))
    return numbered.withColumn(id_column, new_id).drop("_copy")
