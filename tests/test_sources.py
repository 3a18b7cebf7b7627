import glob
import gzip
import hashlib
import random
from urllib.parse import unquote

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from holdfast import workspace
from holdfast.contracts import SNAPSHOT_RULES
from holdfast.functions import repair
from holdfast.operators import quality
from holdfast.plans import prepare
from holdfast.sources import fingerprint, readers, registry, sinks
from holdfast.sources.sha256 import Sha256


def test_raw_csv_roundtrip(spark, raw, tmp_path):
    path = sinks.write_table(raw, str(tmp_path / "raw.csv"))
    back = readers.read_raw_csv(spark, path)
    assert dict(back.dtypes)["TotalCharges"] == "double"
    assert back.where("TotalCharges is null").count() == 1
    assert back.where("customerID = '5575-GNVDE'").first()["TotalCharges"] == 1889.5


def test_csv_header_is_checked_by_name(spark, raw, tmp_path):
    turned = sinks.write_table(raw.select(*reversed(raw.columns)), str(tmp_path / "turned.csv"))
    assert readers.read_raw_csv(spark, turned).where("Churn = 'Yes'").count() == 2
    more = sinks.write_table(raw.withColumn("extra", F.lit(1)), str(tmp_path / "more.csv"))
    with pytest.raises(ValueError, match="extra"):
        readers.read_text_csv(spark, more, raw.columns)
    with pytest.raises(quality.ValidationError, match="extra"):
        prepare.load_and_validate(spark, more)


def test_suffix_decides(spark, sample, tmp_path):
    parquet = sinks.write_table(sample, str(tmp_path / "a.parquet"))
    assert readers.read_table(spark, parquet).count() == 4
    csv = sinks.write_table(sample, str(tmp_path / "a.CSV"))
    assert readers.read_table(spark, csv).columns == sample.columns
    for path in ("x.json", "x", "x.parquet.gz"):
        with pytest.raises(ValueError, match="unsupported"):
            readers.read_table(spark, path)
        with pytest.raises(ValueError, match="unsupported"):
            sinks.write_table(sample, path)


def test_nan_becomes_null(spark, tmp_path):
    path = str(tmp_path / "nan.parquet")
    spark.sql("select double('NaN') as a, 1.5D as b, float('NaN') as c").write.parquet(path)
    assert tuple(readers.read_parquet(spark, path).first()) == (None, 1.5, None)


@pytest.mark.parametrize(
    "text, value",
    [("29.85", 29.85), (" 1e3 ", 1000.0), ("", None), (" \t", None), ("1d", None), ("1f", None),
     ("n/a", None), ("NaN", None), (".5", 0.5), ("-3.", -3.0), ("0x1A", None), (None, None),
     ("inf", float("inf"))],
)
def test_to_number(spark, text, value):
    df = spark.createDataFrame([(text,)], "c string")
    assert df.select(repair.to_number(df, "c")).first()[0] == value


def test_file_digest_is_sha256(spark, tmp_path):
    target = tmp_path / "f.txt"
    target.write_bytes(b"some bytes")
    row = fingerprint.file_digests(spark, str(target)).first()
    assert row["sha256"] == hashlib.sha256(b"some bytes").hexdigest()


def test_content_fingerprint_ignores_layout(spark, customers):
    one = fingerprint.content_fingerprint(customers).first()
    other = fingerprint.content_fingerprint(customers.repartition(7).orderBy("tenure")).first()
    changed = fingerprint.content_fingerprint(customers.withColumn("tenure", F.lit(1))).first()
    assert one == other and one["digest_sum"] != changed["digest_sum"]
    assert fingerprint.content_fingerprint(customers.limit(0)).first()["n_rows"] == 0


def test_champion_table(spark, tmp_path):
    path = str(tmp_path / "champion")
    with pytest.raises(FileNotFoundError):
        registry.read_champion(spark, path)
    facts = dict(
        model_source="champion", recall_floor=0.5, beta=1.25, floor_kept=True,
        test_metrics={"roc_auc": 0.8},
    )
    registry.freeze_champion(spark, path, model_path="m1", threshold=0.4, **facts)
    registry.freeze_champion(spark, path, model_path="m2", threshold=0.47, **facts)
    latest = registry.read_champion(spark, path)
    assert (latest["model_path"], latest["threshold"]) == ("m2", 0.47)
    bare = str(tmp_path / "bare")
    spark.createDataFrame([("m",)], "model_path string").write.parquet(bare)
    with pytest.raises(ValueError, match="threshold"):
        registry.read_champion(spark, bare)


def test_model_candidates(spark, tmp_path):
    model = tmp_path / "model" / "metadata"
    model.mkdir(parents=True)
    (model / "part-0").write_text("{}")
    there, gone = str(tmp_path / "model"), str(tmp_path / "gone")
    assert registry.resolve_model(spark, "given") == ("given", "override")
    assert registry.resolve_model(spark, None, there, gone) == (there, "champion")
    assert registry.resolve_model(spark, None, gone, there) == (there, "fallback")
    with pytest.raises(FileNotFoundError):
        registry.resolve_model(spark, None, gone, gone)


def test_run_table_and_leaderboard(spark, tmp_path):
    path = str(tmp_path / "runs")
    a = registry.run_row("a", {"c": 1.0}, {"val_roc_auc": 0.7, "val_f1": 0.5})
    b = registry.run_row("b", {}, {"val_roc_auc": 0.8, "val_f1": 0.4})
    trial = registry.run_row("trial_1", {}, {"cv_mean_roc_auc": 0.9}, parent=b[0])
    registry.log_runs(spark, path, [a])
    registry.log_runs(spark, path, [b, trial])
    board = registry.leaderboard(spark.read.parquet(path), "val_roc_auc").collect()
    assert [(r["name"], r["val_roc_auc"], r["val_f1"]) for r in board] == [
        ("b", 0.8, 0.4), ("a", 0.7, 0.5)
    ]


def test_shared_folder_comes_from_the_session(spark):
    assert workspace.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert workspace.new_path(spark, "x") != workspace.new_path(spark, "x")


def test_typed_reads_numbers(raw):
    row = readers.typed(raw, SNAPSHOT_RULES).where("customerID = '7590-VHVEG'").first()
    assert (row["tenure"], row["MonthlyCharges"], row["TotalCharges"]) == (1, 29.85, None)


def test_standard_csv(spark, tmp_path):
    """Doubled quotes are read as one; a line break inside quotes is refused or, asked for, read."""
    path = tmp_path / "a.csv"
    path.write_text('id,body\n1,"say ""hi"", ok"\n2,plain\n')
    rows = [tuple(r) for r in readers.read_text_csv(spark, str(path)).collect()]
    assert rows == [("1", 'say "hi", ok'), ("2", "plain")]
    broken = tmp_path / "b.csv"
    broken.write_text('id,body,last\n1,"two\nlines",x\n2,plain,y\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_text_csv(spark, str(broken)).collect()
    rows = [tuple(r) for r in readers.read_text_csv(spark, str(broken), multi_line=True).collect()]
    assert rows == [("1", "two\nlines", "x"), ("2", "plain", "y")]


def test_fingerprints_tell_rows_apart(spark):
    def digest(*rows):
        return fingerprint.content_fingerprint(spark.createDataFrame(list(rows), "a string, b string")).first()[1]

    alike = [("a|b", ""), ("a", "b|"), (None, ""), ("", ""), ("", None), ("1:a", "b"), ("a,1:b", ""), ("a", "1:b")]
    assert len({digest(r) for r in alike}) == len(alike)
    assert digest(("x", "y"), ("z", None)) == digest(("z", None), ("x", "y"))


def test_large_files_are_refused_by_name(spark, tmp_path):
    (tmp_path / "f.bin").write_bytes(b"12345")
    assert fingerprint.file_digests(spark, str(tmp_path)).count() == 1
    with pytest.raises(Exception, match="too large"):
        fingerprint.file_digests(spark, str(tmp_path), most_bytes=4).collect()


def test_run_folder_is_cleaned(spark, monkeypatch):
    monkeypatch.setattr(workspace, "_RUN", "run-test")
    path = workspace.new_path(spark, "x")
    spark.range(3).write.parquet(path)
    assert readers.path_exists(spark, path) and path.startswith(workspace.run_dir(spark))
    workspace.clean_up(spark)
    assert not readers.path_exists(spark, path)


def test_file_digests_in_parts(spark, tmp_path, monkeypatch):
    """Large files, whatever their bytes, by the same digests; no task sees more than about a part."""
    draw = random.Random(3)
    noise = draw.randbytes(300_000)
    files = {
        "noise": noise, "ended": noise[:70_000] + b"\n", "breaks": b"\n" * 50_000, "crlf": b"a\r\nb\rc\n" * 9_000,
        "marked": b"\xef\xbb\xbf" + noise[:60_001] + b"x", "marked_ended": b"\xef\xbb\xbfab\n" * 20_000,
        "mark_only": b"\xef\xbb\xbf", "no_break": b"\x00" * 90_000, "small": b"some bytes", "empty": b"",
        "at_bound": noise[:40_000], "over_bound": noise[:40_001], "a b%20[é].parquet": noise[5:120_000],
        "packed.gz": gzip.compress(noise[:100_000]),
    }
    (tmp_path / "in").mkdir()
    for name, data in files.items():
        (tmp_path / "in" / name).write_bytes(data)
    monkeypatch.setattr(workspace, "_RUN", "run-parts")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = fingerprint.file_digests(spark, str(tmp_path / "in"), part_bytes=40_000).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    named = {unquote(r["path"]).rsplit("/", 1)[1]: r["sha256"] for r in got}
    assert files.pop("empty") == b"" and len(got) == len(files)  # Spark lists no empty files
    assert named == {unquote(name): hashlib.sha256(data).hexdigest() for name, data in files.items()}
    parts = spark.read.parquet(glob.glob(f"{workspace.run_dir(spark)}/file_parts-*")[0].removeprefix("file:"))
    assert parts.agg(F.max(F.octet_length("data"))).first()[0] <= fingerprint.CHUNK
    sizes = parts.groupBy("id", "part").agg(F.sum("n").alias("n")).collect()
    by_size = sorted(r["n"] for r in sizes)
    assert len({r["part"] for r in sizes}) == 8 and by_size[-1] == 90_001 and by_size[-2] < 45_000
    workspace.clean_up(spark)


def test_large_files_in_parts_are_refused_if_asked(spark, tmp_path):
    (tmp_path / "f.bin").write_bytes(b"12345\n6")
    assert fingerprint.file_digests(spark, str(tmp_path), part_bytes=2).first()["sha256"] == hashlib.sha256(b"12345\n6").hexdigest()
    with pytest.raises(Exception, match="too large"):
        fingerprint.file_digests(spark, str(tmp_path), most_bytes=4, part_bytes=2).collect()


def test_sha256_goes_on():
    data, at = random.Random(4).randbytes(100_000), 0
    digest = Sha256()
    for size in (0, 1, 63, 64, 65, 127, 1000, 55, 56, 98_569):
        part = pa.py_buffer(data[at : at + size])
        digest = Sha256(digest.state)
        digest.update(part.address, part.size)
        at += size
        assert digest.n_bytes == at and digest.hexdigest() == hashlib.sha256(data[:at]).hexdigest()
    assert at == len(data)
