from __future__ import annotations

import os
import time
from datetime import datetime, timedelta

import pytest

from holdfast import LabelSpec, ModelingSpec
from holdfast.streaming import labels

SPEC = ModelingSpec("id", {}, (), LabelSpec("y"))
T0 = datetime(2024, 1, 1)
SCORES = "id string, scored_at timestamp, predicted_churn string"
LABELS = "id string, labelled_at timestamp, y string"


def at(hours):
    return T0 + timedelta(hours=hours)


def write(spark, path, files, schema):
    """A file for each list of rows, in order of arrival."""
    for i, rows in enumerate(files):
        target = f"{path}/part{i}"
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(target)
        stamp = time.time() - 1000 + i * 10
        for name in os.listdir(target):
            os.utime(f"{target}/{name}", (stamp, stamp))


def stream(spark, path, schema):
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
        .option("recursiveFileLookup", True).parquet(path)
    )


@pytest.fixture(scope="module")
def case(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("late"))
    scores = [
        [("a", at(0), "Yes"), ("b", at(0), "No"), ("c", at(1), "Yes"), ("d", at(1), "No"), ("e", at(2), "Yes")],
        [("a", at(30), "No"), ("f", at(31), "No"), ("b", at(0), "No")],  # a scored again, b repeated
        [("end", at(5000), "No")],
        [("end", at(9000), "No")],
        [("end", at(9001), "No")],
    ]
    given = [
        [("a", at(5), "Yes"), ("b", at(10), "No"), ("b", at(8), "Yes"), ("x", at(3), "Yes"), ("d", at(4), None)],
        [("c", at(26), "Yes"), ("e", at(26), "No"), ("a", at(40), "No"), ("b", at(8), "No")],  # c too late, e just in time
        [("end", at(5000), "No")],
        [("end", at(9000), "No")],
        [("end", at(9001), "No")],
    ]
    write(spark, f"{base}/scores", scores, SCORES)
    write(spark, f"{base}/labels", given, LABELS)
    labels.label_stream(
        stream(spark, f"{base}/scores", SCORES), stream(spark, f"{base}/labels", LABELS), SPEC, "24 hours",
        watermark="48 hours", path=f"{base}/out", checkpoint=f"{base}/state",
    ).awaitTermination()
    return base


def rows(table):
    return sorted(tuple(r) for r in table.where("id <> 'end'").collect())


def test_late_missing_and_repeated_labels(spark, case):
    got = {(r[0], r[1]): r[3:] for r in rows(labels.streamed_labels(spark, f"{case}/out", SPEC))}
    assert got == {
        ("a", at(0)): (at(5), "Yes"), ("a", at(30)): (at(40), "No"),  # each score its own label
        ("b", at(0)): (at(8), "No"),  # three labels: the earliest, of equal ones the smaller
        ("c", at(1)): (None, None),  # beyond the wait
        ("d", at(1)): (None, None),  # a label without a value is none
        ("e", at(2)): (at(26), "No"), ("f", at(31)): (None, None),
    }


def test_stream_equals_the_table(spark, case):
    read = lambda name: spark.read.option("recursiveFileLookup", True).parquet(f"{case}/{name}")
    table = labels.scored_with_labels(read("scores"), read("labels"), SPEC, "24 hours")
    assert rows(labels.streamed_labels(spark, f"{case}/out", SPEC)) == rows(table)
    counts = {tuple(r)[:2]: r[2] for r in labels.label_counts(table.where("id <> 'end'")).collect()}
    assert counts == {("Yes", "Yes"): 1, ("No", "No"): 2, ("Yes", None): 1, ("No", None): 2, ("Yes", "No"): 1}


def test_state_is_freed_and_open_scores_wait(spark, case, tmp_path):
    """What is open has no row yet; a label that comes in a later run closes it."""
    write(spark, f"{tmp_path}/scores", [[("g", at(0), "Yes")]], SCORES)
    write(spark, f"{tmp_path}/labels", [[("x", at(0), "Yes")]], LABELS)

    def run():
        query = labels.label_stream(
            stream(spark, f"{tmp_path}/scores", SCORES), stream(spark, f"{tmp_path}/labels", LABELS), SPEC,
            "24 hours", watermark="48 hours", path=f"{tmp_path}/out", checkpoint=f"{tmp_path}/state",
        )
        query.awaitTermination()
        return rows(labels.streamed_labels(spark, f"{tmp_path}/out", SPEC)), query.recentProgress

    assert run()[0] == []
    write(spark, f"{tmp_path}/labels/more", [[("g", at(20), "No")]], LABELS)
    assert run()[0] == [("g", at(0), "Yes", at(20), "No")]
    for k in (900, 901, 902):
        write(spark, f"{tmp_path}/scores/end{k}", [[("end", at(k), "No")]], SCORES)
        write(spark, f"{tmp_path}/labels/end{k}", [[("end", at(k), "No")]], LABELS)
        got, progress = run()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in map(dict_of, progress) if p["stateOperators"]]
    assert got == [("g", at(0), "Yes", at(20), "No")] and held[-1] <= 6


def dict_of(progress):
    import json

    return progress if isinstance(progress, dict) else json.loads(progress.json)
