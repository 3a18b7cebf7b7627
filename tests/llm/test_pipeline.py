from __future__ import annotations

from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from conftest import SMALL
from holdfast.llm import decontaminate, langid, mixing, secrets, simhash
from test_mixing import plain_targets
from test_secrets import plain
from test_simhash import plain_components, plain_fingerprint


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Input and output of every stage, as run() chains them."""
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, SMALL).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((docs, after))
        docs = after
    return out


def test_columns_and_names(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language", "near_duplicates", "benchmark_passages", "secrets", "mixture"]
    for before, after in steps[:-1]:
        assert sorted(before.columns) == sorted(after.columns)


def rows(table):
    return {r["doc_id"]: r["text"] for r in table.collect()}


def test_language(steps):
    before, after = map(rows, steps[0])
    assert all(before[i] == t for i, t in after.items())
    assert all(t is None or not langid.has_letter(t) or len(t) < 60 for i, t in before.items() if i not in after)


def test_near_duplicates(steps):
    before, after = map(rows, steps[1])
    ids = sorted(before)
    groups = plain_components([plain_fingerprint(before[i]) for i in ids], simhash.DISTANCE)
    least = {}
    for i, g in zip(ids, groups):
        least.setdefault(g, i)
    assert sorted(after) == sorted(least.values())


def test_benchmark_passages(spark, steps):
    before, after = map(rows, steps[2])
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()
    items = decontaminate.Items.of([tuple(r) for r in bench])

    def holds(text):
        numbers, _ = items.numbered([text])
        scores = (decontaminate.align(numbers, w)[0] / (decontaminate.MATCH * len(w)) for w in items.words)
        return any(s >= decontaminate.LEAST for s in scores)

    assert sorted(after) == sorted(i for i, t in before.items() if not holds(t))


def test_secrets(steps):
    before, after = map(rows, steps[3])
    assert sorted(before) == sorted(after)
    for i, text in before.items():
        if plain(text):
            assert after[i] != text and "[secret]" in after[i]
        assert not [s for s in plain(after[i]) if s[2] in ("access", "hex")]
        if after[i] != text:
            assert len(after[i]) < len(text) + 200


def test_mixture(steps):
    before, after = steps[4]
    size, texts = defaultdict(int), {}
    for r in before.collect():
        texts[r["doc_id"]] = (r["text"] or "").split()
        size[r["source"]] += len(texts[r["doc_id"]])
    got, used = Counter(), Counter()
    for p in after.collect():
        got[p["source"]] += p["word_to"] - p["word_from"]
        used[p["doc_id"]] += p["word_to"] - p["word_from"]
        assert p["text"].split() == texts[p["doc_id"]][p["word_from"] : p["word_to"]]
    assert all(abs(got[s] - n) <= mixing.BLOCK + 1 for s, n in plain_targets(size).items())
    assert all(n <= 2 * len(texts[i]) for i, n in used.items())


def test_run_is_the_stages(spark, steps):
    ours = corpus_pipeline.run(spark, SMALL)
    assert ours.count() == steps[-1][1].count() and ours.columns == steps[-1][1].columns


def test_odd_rows_through_every_stage(spark, tmp_path):
    """Nulls in every column, repeated rows, an empty table, clashing names."""
    kind = "doc_id long, text string, lang string, source string, n_chars long, _row string, score double"
    odd = [(None, None, None, None, None, None, None), (1, "", "en", "a", 0, "x", 0.0), (2, "a b c d", None, None, 7, None, 1.0),
           (2, "a b c d", None, None, 7, None, 1.0), (3, "token=abcdefgh " * 300, "en", "b", 4500, "y", 2.0), (4, "der die das", "de", None, 11, "z", None)]
    for n, data in enumerate((odd, [])):
        docs = spark.createDataFrame(data, kind)
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, SMALL)
            out.write.parquet(str(tmp_path / f"{n}-{name}"))
            if k < 4:
                assert out.columns == docs.columns
                docs = spark.read.schema(out.schema).parquet(str(tmp_path / f"{n}-{name}"))
