"""Scans, repair, labels and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast import workspace
from holdfast.catalog import tables as t
from holdfast.catalog.entries import entry
from holdfast.functions import labels, repair
from holdfast.operators import features
from holdfast.operators.training import SCORE
from holdfast.operators import scoring
from holdfast.plans import prepare
from holdfast.sources import fingerprint, readers, sinks
from holdfast.spec import LabelSpec

FEED_NUMBER = (
    "case when regexp_matches(trim({c}), '^[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)([eE][+-]?[0-9]+)?$') "
    "then cast(trim({c}) as double) end"
)


@entry(
    "scan_csv",
    f"with {t.FEED_SQL} select order_key, order_id, {FEED_NUMBER.format(c='price_text')} "
    "as price, status from feed",
)
def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the feed as CSV, read it back as text and repair the nullable number."""
    columns = ["order_key", "order_id", "price_text", "status"]
    path = workspace.new_path(spark, "feed") + ".csv"
    rows = t.feed(spark, sf_dir).select(*columns)
    sinks.write_table(rows, path)
    text = readers.read_text_csv(spark, path, columns)
    return text.select(
        F.col("order_key").cast("long").alias("order_key"),
        "order_id",
        repair.to_number(text, "price_text").alias("price"),
        "status",
    )


@entry(
    "scan_parquet",
    "select l_returnflag, count(*) as n_rows, cast(sum(cast(l_quantity as bigint)) as bigint) "
    "as units from lineitem where l_shipdate >= timestamp '1998-01-01' group by l_returnflag",
)
def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pruned, filtered Parquet scan: three columns are read and the date filter is pushed."""
    lines = readers.read_parquet(spark, f"{sf_dir}/lineitem.parquet")
    return (
        lines.where(F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
        .groupBy("l_returnflag")
        .agg(F.count("*").alias("n_rows"), F.sum(F.col("l_quantity").cast("long")).alias("units"))
    )


@entry(
    "scan_dispatch",
    "select 'parquet' as format, count(*) as n_rows, count(c_acctbal) as n_known from customer "
    "union all select 'csv', count(*), count(c_acctbal) from customer",
)
def scan_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table through both readers that the suffix chooses between."""
    base = workspace.new_path(spark, "customer")
    source = f"{sf_dir}/customer.parquet"
    csv = sinks.write_table(readers.read_table(spark, source), f"{base}.csv")

    def count(path: str) -> DataFrame:
        found = readers.read_table(spark, path)
        return found.agg(
            F.count("*").alias("n_rows"), F.count("c_acctbal").alias("n_known")
        ).select(F.lit(readers.path_format(path)).alias("format"), "n_rows", "n_known")

    return count(source).unionByName(count(csv))


def fingerprint_sql(name: str, columns: str) -> str:
    """The content fingerprint of a table in SQL."""
    texts = [f"cast({c} as varchar)" for c in columns.split()]
    framed = ", ".join(f"coalesce(strlen({x}) || ':' || {x}, '-')" for x in texts)
    halves = [f"cast(sum(cast(('0x' || substr(d, {k}, 15)) as bigint)) as varchar)" for k in (1, 16)]
    return (
        f"with rows as (select md5(concat_ws(',', {framed})) as d from {name}) "
        f"select count(*) as n_rows, {halves[0]} || '-' || {halves[1]} as digest_sum from rows"
    )


@entry(
    "fingerprint",
    fingerprint_sql("customer", "c_custkey c_name c_nationkey c_acctbal c_mktsegment"),
)
def content_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.content_fingerprint(t.table(spark, sf_dir, "customer"))


@entry("fingerprint_documents", fingerprint_sql("documents", "doc_id text lang source n_chars"))
def fingerprint_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long texts with nulls, quotes and line breaks."""
    return fingerprint.content_fingerprint(t.table(spark, sf_dir, "documents"))


@entry(
    "csv_roundtrip",
    "with awkward as (select doc_id, concat(' ', text, ' \"', source, '\", ', text, ' ') as body from "
    "documents) select doc_id, md5(body) as digest, strlen(body) as n_bytes from awkward",
)
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document texts with blanks at the ends, quotes, commas and line breaks, through a CSV table."""
    quoted = F.concat(F.lit(' "'), "source", F.lit('", '))
    body = F.concat(F.lit(" "), "text", quoted, "text", F.lit(" "))
    rows = t.table(spark, sf_dir, "documents").select("doc_id", body.alias("body"))
    path = sinks.write_table(rows, workspace.new_path(spark, "texts") + ".csv")
    back = readers.read_text_csv(spark, path, multi_line=True)
    return back.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.md5("body").alias("digest"),
        F.octet_length("body").alias("n_bytes"),
    )


@entry("file_digests")
def file_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SHA-256 of the input files."""
    found = fingerprint.file_digests(spark, f"{sf_dir}/*.parquet")
    return found.select(F.element_at(F.split("path", "/"), -1).alias("file"), "sha256")


@entry(
    "coerce_numeric",
    f"with {t.FEED_SQL} select order_key, price_text, {FEED_NUMBER.format(c='price_text')} "
    "as price from feed",
)
def coerce_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.feed(spark, sf_dir)
    return rows.select(
        "order_key", "price_text", repair.to_number(rows, "price_text").alias("price")
    )


@entry(
    "prepare_modeling",
    f"with {t.FEED_SQL} select order_key, "
    f"cast(trunc(coalesce({FEED_NUMBER.format(c='flag_text')}, 0)) as bigint) as flag, "
    f"{FEED_NUMBER.format(c='price_text')} as price, flag_text is null as flag_was_missing "
    "from feed",
)
def prepare_modeling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flag and nullable number repaired; whether the flag was missing is kept beside it."""
    rows = t.feed(spark, sf_dir).withColumn("flag_was_missing", F.col("flag_text").isNull())
    return prepare.prepare_modeling(rows, t.FEED_SPEC).select(
        "order_key",
        F.col("flag_text").alias("flag"),
        F.col("price_text").alias("price"),
        "flag_was_missing",
    )


QUALITY = LabelSpec("label", positive="1", negative="0")
DOCUMENT_LABELS_SQL = (
    "labelled as (select d.doc_id, cast(l.quality as varchar) as label "
    "from documents d left join labels l on l.doc_id = d.doc_id)"
)


def document_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its quality label where it has one."""
    documents = t.table(spark, sf_dir, "documents").select("doc_id")
    quality = t.table(spark, sf_dir, "labels").select(
        "doc_id", F.col("quality").cast("string").alias("label")
    )
    return documents.join(quality, "doc_id", "left")


@entry(
    "label_binary",
    f"with {DOCUMENT_LABELS_SQL} select doc_id, "
    "case when label = '1' then 1 else 0 end as y from labelled",
)
def label_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = document_labels(spark, sf_dir)
    return rows.select("doc_id", labels.label_binary(QUALITY).alias("y"))


@entry(
    "label_ternary",
    f"with {DOCUMENT_LABELS_SQL} select doc_id, "
    "case label when '1' then 1 when '0' then 0 end as y from labelled",
)
def label_ternary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = document_labels(spark, sf_dir)
    return rows.select("doc_id", labels.label_ternary(QUALITY).alias("y"))


@entry(
    "feature_matrix",
    f"with {t.SNAPSHOT_SQL} select is_debtor, tenure_days, n_orders, avg_ticket, total_spend, "
    "acctbal, segment, region, nation, top_priority from snapshot",
)
def feature_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.feature_matrix(t.snapshot(spark, sf_dir), t.SNAPSHOT_SPEC)


@entry(
    "apply_threshold",
    f"with {t.SCORED_SQL} select case when score >= cast(0.47 as double) then 'R' else 'N' end "
    "as predicted, y, count(*) as n_rows from scored group by 1, 2",
)
def apply_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.scored(spark, sf_dir)
    predicted = labels.apply_threshold("score", 0.47, t.SCORED_LABEL).alias("predicted")
    return rows.groupBy(predicted, "y").agg(F.count("*").alias("n_rows"))


SCORED_SNAPSHOT_SQL = (
    t.SNAPSHOT_SQL
    + ", graded as (select *, cast(n_orders as double) / cast(n_orders + 10 as double) as score "
    "from snapshot)"
)


def scored_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with a score made from their order count."""
    n = F.col("n_orders").cast("double")
    return t.snapshot(spark, sf_dir).withColumn(SCORE, n / (n + 10.0))


@entry(
    "score_projection",
    f"with {SCORED_SNAPSHOT_SQL} select customer_id, score as churn_probability, "
    "case when score >= cast(0.5 as double) then 'Yes' else 'No' end as predicted_churn, "
    "churn as actual_churn from graded",
)
def score_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score_projection(scored_snapshot(spark, sf_dir), t.SNAPSHOT_SPEC, 0.5)


@entry(
    "score_override",
    f"with {SCORED_SNAPSHOT_SQL} select customer_id, score as churn_probability, "
    "case when score >= cast(0.35 as double) then 'Yes' else 'No' end as predicted_churn "
    "from graded",
)
def score_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A given cut instead of the frozen one, on rows without any label."""
    blank = scored_snapshot(spark, sf_dir).withColumn("churn", F.lit(None).cast("string"))
    return scoring.score_projection(blank, t.SNAPSHOT_SPEC, 0.35)


@entry(
    "scored_vs_actual",
    f"with {SCORED_SNAPSHOT_SQL} select case when score >= cast(0.5 as double) then 'Yes' "
    "else 'No' end as predicted_churn, churn as actual_churn, count(*) as n_rows "
    "from graded group by 1, 2",
)
def scored_vs_actual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores without labels, joined with the labels that came later."""
    late = t.snapshot(spark, sf_dir).select("customer_id", "churn")
    return scoring.scored_vs_actual(score_override_half(spark, sf_dir), late, t.SNAPSHOT_SPEC)


def score_override_half(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score_projection(
        scored_snapshot(spark, sf_dir), t.SNAPSHOT_SPEC, 0.5, with_actual=False
    )


@entry(
    "sink_roundtrip",
    f"with {SCORED_SNAPSHOT_SQL}, out as (select customer_id, score, case when score >= "
    "cast(0.5 as double) then 'Yes' else 'No' end as predicted from graded) "
    "select 'parquet' as format, * from out union all select 'csv', * from out",
)
def sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores written as Parquet and as CSV, and read back."""
    rows = score_override_half(spark, sf_dir)
    base = workspace.new_path(spark, "scores")
    schema = rows.schema
    out = None
    for suffix in (".parquet", ".csv"):
        path = sinks.write_table(rows, base + suffix)
        back = readers.read_table(spark, path, schema).select(
            F.lit(readers.path_format(path)).alias("format"),
            "customer_id",
            F.col(SCORE).alias("score"),
            F.col(scoring.PREDICTED).alias("predicted"),
        )
        out = back if out is None else out.unionByName(back)
    return out
