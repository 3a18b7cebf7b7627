import pytest
from pyspark.sql import functions as F

from holdfast.operators import sketches


def table(spark, n=30_000):
    return spark.range(n).select(
        (F.col("id") % 6).cast("string").alias("part"),
        F.when(F.col("id") % 11 > 0, F.abs(F.xxhash64("id")) % 10_007).alias("v"),
        F.when(F.col("id") % 6 == 5, F.lit(None)).otherwise(F.col("id") % 3).cast("double").alias("few"),
        F.concat(F.lit("t"), F.col("id") % 9000).alias("name"),
    )


def rows(df):
    return {r["column"]: r.asDict() for r in df.collect()}


def test_parts_merge_within_the_stated_errors(spark, tmp_path):
    df = table(spark)
    path = str(tmp_path / "sketches")
    for which in ("part < '4'", "part >= '4'"):
        new = sketches.sketch_parts(df.where(which), F.col("part"), ["v", "few"], ["name"])
        stored = sketches.add_parts(new, path)
    assert stored.count() == 18
    got = rows(sketches.summarize(stored))
    for column in ("v", "few", "name"):
        exact = df.agg(
            F.count("*").alias("n_rows"), F.count_if(F.col(column).isNull()).alias("n_missing"),
            F.countDistinct(column).alias("n"),
        ).first()
        assert (got[column]["n_rows"], got[column]["n_missing"]) == (exact["n_rows"], exact["n_missing"])
        assert abs(got[column]["n_distinct"] - exact["n"]) <= sketches.distinct_error() * exact["n"]
    assert (got["v"]["smallest"], got["v"]["largest"]) == df.agg(F.min("v"), F.max("v")).first()
    assert got["name"]["quantile"] is None and got["few"]["n_distinct"] == 3
    for share in (0.01, 0.5, 0.9):
        estimates = sketches.summarize(stored, share)
        for row in sketches.rank_gap(df, estimates, ["v", "few"], share).collect():
            assert row["gap"] <= 2 * sketches.rank_error()


def test_a_part_sketched_again_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "sketches")
    make = lambda df: sketches.sketch_parts(df, F.col("part"), ["v"])
    df = table(spark, 600)
    sketches.add_parts(make(df), path)
    sketches.add_parts(make(df.where("part = '2'")), path)
    stored = sketches.add_parts(make(df.where("part = '3'").limit(10)), path)
    got = rows(sketches.summarize(stored))["v"]
    assert got["n_rows"] == 510


def test_small_parts_are_exact(spark):
    df = table(spark, 300)
    one = rows(sketches.summarize(sketches.sketch_parts(df, F.lit("all"), ["v"])))["v"]
    values = sorted(r["v"] for r in df.where("v is not null").select("v").collect())
    assert one["quantile"] == values[(len(values) + 1) // 2 - 1]
    assert one["n_distinct"] == len(set(values))


def test_missing_empty_and_odd_columns(spark):
    df = spark.sql(
        "select * from values (cast(null as string), double('NaN'), cast(null as double)), "
        "(null, 1.5D, null), ('p', -0.0D, null) as t(part, `a.b`, none)"
    )
    made = sketches.sketch_parts(df, F.col("part"), ["a.b", "none"], ["part"])
    assert {r["part"] for r in made.collect()} == {"none", "p"}
    got = rows(sketches.summarize(made))
    assert (got["a.b"]["n_missing"], got["a.b"]["n_distinct"], got["a.b"]["largest"]) == (1, 2, 1.5)
    assert (got["none"]["n_missing"], got["none"]["quantile"], got["none"]["n_distinct"]) == (3, None, 0)
    assert sketches.summarize(sketches.sketch_parts(df.limit(0), F.col("part"), ["none"])).count() == 0
    with pytest.raises(ValueError, match="none"):
        sketches.sketch_parts(df, F.col("part"), ["none"], ["none"])
