from pyspark.sql import functions as F

from holdfast.operators.quality import Check
from holdfast.streaming import windows


def events(spark, path):
    rows = spark.range(400).select(
        F.timestamp_seconds(F.col("id") * 600 + 1_700_000_000).alias("ts"),
        F.when(F.col("id") % 5 == 0, "x").otherwise("y").alias("kind"),
        (F.col("id") % 7).cast("double").alias("value"),
    )
    rows.repartitionByRange(4, "ts").sortWithinPartitions("ts").write.parquet(path)
    return spark.read.parquet(path)


def checks():
    return [Check("minimum", "value", F.col("value") < 1), Check("domain", "kind", F.col("kind") == "x")]


def test_validation_stream_equals_the_table(spark, tmp_path):
    table = events(spark, str(tmp_path / "in"))
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(
        str(tmp_path / "in")
    )
    windows.validate_stream(
        stream, "ts", "6 hours", checks(), output=str(tmp_path / "out"),
        checkpoint=str(tmp_path / "state"), watermark="10 days",
    ).awaitTermination()
    written = spark.read.parquet(str(tmp_path / "out"))
    assert written.select("batch").distinct().count() > 1
    got = sorted(map(tuple, windows.latest_windows(written).collect()))
    want = sorted(map(tuple, windows.window_failures(table, "ts", "6 hours", checks()).collect()))
    assert got == want and sum(r[1] for r in got) == 400


def test_drift_stream_equals_the_table(spark, tmp_path):
    table = events(spark, str(tmp_path / "in"))
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(
        str(tmp_path / "in")
    )
    windows.drift_stream(
        stream, "ts", "1 day", ["kind"], output=str(tmp_path / "out"),
        checkpoint=str(tmp_path / "state"), watermark="10 days",
    ).awaitTermination()
    streamed = windows.latest_counts(spark.read.parquet(str(tmp_path / "out")))
    batch = windows.window_category_counts(table, "ts", "1 day", ["kind"])
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))
    reference = batch.groupBy("column", "value").agg(F.sum("n").alias("n"))
    assert not any(r["drift_flag"] for r in windows.drift_windows(streamed, reference).collect())
    shifted = reference.withColumn("n", F.when(F.col("value") == "x", 3000).otherwise(F.col("n")))
    assert any(r["drift_flag"] for r in windows.drift_windows(streamed, shifted).collect())


def days(spark, path, starts, extra=()):
    """A file per day given, in order: 24 rows an hour apart from each start."""
    import os
    import time

    for i, start in enumerate([*starts, *extra]):
        rows = spark.range(24).select(
            F.timestamp_seconds(F.lit(1_700_006_400 + 86_400 * start) + F.col("id") * 3600).alias("ts"),
            F.when(F.col("id") % 5 == 0, "x").otherwise("y").alias("kind"),
            (F.col("id") % 7).cast("double").alias("value"),
        )
        rows.coalesce(1).write.mode("append").parquet(path)
        for name in os.listdir(path):  # files are taken in the order of their times
            full = os.path.join(path, name)
            if name.endswith(".parquet") and os.stat(full).st_mtime > time.time() - 500:
                os.utime(full, (1_000_000_000 + 10 * i,) * 2)
    return spark.read.parquet(path)


def state_rows(query):
    return [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]


def test_streams_free_their_state_and_drop_late_rows(spark, tmp_path):
    table = days(spark, str(tmp_path / "in"), [0, 3, 6, 9, 12, 15], extra=[0])

    def stream():
        source = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1)
        return source.parquet(str(tmp_path / "in"))

    drift = windows.drift_stream(
        stream(), "ts", "1 day", ["kind"], output=str(tmp_path / "d"),
        checkpoint=str(tmp_path / "ds"), watermark="1 hour",
    )
    drift.awaitTermination()
    checked = windows.validate_stream(
        stream(), "ts", "1 day", checks(), output=str(tmp_path / "v"),
        checkpoint=str(tmp_path / "vs"), watermark="1 hour",
    )
    checked.awaitTermination()
    assert len(state_rows(drift)) >= 7 and max(state_rows(drift)) <= 4
    assert max(state_rows(checked)) <= 2
    found = windows.latest_counts(spark.read.parquet(str(tmp_path / "d")))
    assert found.agg(F.sum("n")).first()[0] == 6 * 24  # the late day counts nothing
    latest = windows.latest_windows(spark.read.parquet(str(tmp_path / "v")))
    assert latest.agg(F.sum("n_rows")).first()[0] == 6 * 24
    folded = windows.compact(spark.read.parquet(str(tmp_path / "v")), str(tmp_path / "c"), ["window_start"])
    assert sorted(map(tuple, windows.latest_windows(folded).collect())) == sorted(map(tuple, latest.collect()))


def test_drift_windows_without_listing_absent_categories(spark):
    """Against the full table of cells, with one degree of freedom and with more; no nested loop."""
    from holdfast.operators.drift import chi2_from_counts

    reference = [("a", "u", 30), ("a", "v", 50), ("a", "w", 20), ("b", "p", 60), ("b", "q", 9), ("c", "z", 5)]
    cells = [(1, "a", "u", 10), (1, "a", "new", 4), (2, "a", "w", 8), (1, "b", "p", 12), (2, "b", "q", 3),
             (3, "b", "p", 2), (3, "b", "q", 2), (1, "c", "z", 4), (2, "c", "z", 4), (2, "c", "y", 6), (1, "e", "k", 7)]
    ref = spark.createDataFrame(reference, "column string, value string, n long")
    counts = spark.createDataFrame(cells, "window_start int, column string, value string, n long")
    full = []
    for w, c in {(w, c) for w, c, _, _ in cells}:
        own = {v: n for w_, c_, v, n in cells if (w_, c_) == (w, c)}
        base = {v: n for c_, v, n in reference if c_ == c}
        full += [(w, c, v, base.get(v, 0), own.get(v, 0)) for v in {*own, *base}]
    table = spark.createDataFrame(full, "window_start int, column string, value string, n_ref long, n_cur long")
    want = {(r["window_start"], r["column"]): r for r in chi2_from_counts(table, ["window_start", "column"]).collect()}
    got = windows.drift_windows(counts, ref)
    rows = got.collect()
    assert len(rows) == len(want)
    for r in rows:
        other = want[r["window_start"], r["column"]]
        for name in ("n_values", "n_ref", "n_cur", "dof"):
            assert r[name] == other[name], (r, other)
        assert r["statistic"] == other["statistic"] or abs(r["statistic"] - other["statistic"]) < 1e-9
    one = windows.drift_windows(counts.where("column = 'a'"), ref.where("column = 'a'"))
    for frame in (got, one):
        assert "NestedLoop" not in frame._jdf.queryExecution().toString()


def test_streams_read_a_folder_of_events(spark, tmp_path):
    """At scale a table is a folder of part files: the registered streams read all of them."""
    from conftest import SMALL
    from holdfast.catalog import models

    rows = spark.read.parquet(f"{SMALL}/events.parquet")
    rows.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    for query in (models.validate_stream, models.drift_stream):
        folder = sorted(map(tuple, query(spark, str(tmp_path)).collect()))
        assert folder and folder == sorted(map(tuple, query(spark, SMALL).collect()))
