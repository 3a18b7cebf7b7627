import os

import pytest
from pyspark.sql import functions as F

from holdfast.operators.quality import Check
from holdfast.streaming import late, windows

DAY = 86_400


def checks():
    return [Check("minimum", "value", F.col("value") < 1), Check("domain", "kind", F.col("kind") == "x")]


def days(spark, path, starts):
    """A file per day given, taken in that order: 24 rows an hour apart, one more without a time."""
    for i, start in enumerate(starts):
        rows = spark.range(25).select(
            F.when(F.col("id") < 24, F.timestamp_seconds(1_700_006_400 + DAY * start + F.col("id") * 3600)).alias("ts"),
            F.when(F.col("id") % 5 == 0, "x").otherwise("y").alias("kind"),
            (F.col("id") % 7).cast("double").alias("value"),
        )
        known = set(os.listdir(path)) if os.path.exists(path) else set()
        rows.coalesce(1).write.mode("append").parquet(path)
        for name in set(os.listdir(path)) - known:
            os.utime(os.path.join(path, name), (1_000_000_000 + 10 * i,) * 2)
    return spark.read.parquet(path)


def run(spark, tmp_path, table, name="out"):
    source = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1)
    path = str(tmp_path / name)
    late.count_stream(
        source.parquet(str(tmp_path / "in")), "ts", "1 day", checks(), path=path,
        checkpoint=str(tmp_path / f"{name}_state"), delay="36 hours",
    ).awaitTermination()
    return path


def batch_counts(table):
    known = table.where("ts is not null")
    return sorted(map(tuple, windows.window_failures(known, "ts", "1 day", checks()).collect()))


def test_stream_and_late_rows_equal_the_table(spark, tmp_path):
    # Day 0 comes again when day 6 has been seen; day 5 comes within the delay.
    table = days(spark, str(tmp_path / "in"), [0, 3, 6, 0, 5, 9, 3])
    path = run(spark, tmp_path, table)
    counted = late.counts(spark, path)
    whole = late.with_late(counted)
    assert sorted(map(tuple, whole.drop("n_late").collect())) == batch_counts(table)
    day = (F.unix_timestamp("window_start") - 1_700_006_400) / DAY
    found = {int(r["day"]): r["n_late"] for r in whole.withColumn("day", day).collect() if r["n_late"]}
    assert found == {0: 24, 3: 24}
    apart = counted.where("late")
    assert apart.agg(F.sum("n_rows")).first()[0] == 48 and counted.count() == 7


def test_a_replayed_batch_counts_once(spark, tmp_path):
    table = days(spark, str(tmp_path / "in"), [0, 3, 0])
    path = run(spark, tmp_path, table)
    before = sorted(map(tuple, late.counts(spark, path).collect()))
    last = max((tmp_path / "out_state" / "commits").iterdir(), key=lambda p: p.name if p.name.isdigit() else "")
    for file in (last, last.with_name(f".{last.name}.crc")):
        if file.exists():
            file.unlink()
    run(spark, tmp_path, table)
    assert sorted(map(tuple, late.counts(spark, path).collect())) == before


def test_a_batch_without_commit_is_not_read(spark, tmp_path):
    table = days(spark, str(tmp_path / "in"), [0, 1])
    path = run(spark, tmp_path, table)
    spark.read.parquet(f"{path}/counts/batch=1").write.parquet(f"{path}/counts/batch=2")
    assert late.counts(spark, path).agg(F.sum("n_rows")).first()[0] == 48


def test_fold_keeps_the_counts(spark, tmp_path):
    table = days(spark, str(tmp_path / "in"), [0, 3, 0])
    path = run(spark, tmp_path, table)
    folded = late.fold(spark, path, str(tmp_path / "folded"))
    assert sorted(map(tuple, folded.collect())) == sorted(map(tuple, late.counts(spark, path).collect()))
    with pytest.raises(Exception, match="(?i)exist"):
        late.fold(spark, path, str(tmp_path / "folded"))
