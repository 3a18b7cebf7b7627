"""Exploratory queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast import workspace
from holdfast.catalog import tables as t
from holdfast.catalog.entries import entry
from holdfast.operators import categories, drift, eda, sketches
from holdfast.plans import explore

LABEL = t.SNAPSHOT_SPEC.label
TEXTS = ["segment", "region", "nation", "top_priority"]
NUMBERS = [
    "customer_id", "is_debtor", "tenure_days", "n_orders", "avg_ticket", "total_spend", "acctbal",
]
COLUMNS = [
    "customer_id", "is_debtor", "tenure_days", "n_orders", "avg_ticket", "total_spend", "acctbal",
    "segment", "region", "nation", "top_priority", "churn",
]


def _with(body: str) -> str:
    return f"with {t.SNAPSHOT_SQL} {body}"


@entry(
    "table_shape",
    _with(
        "select count(*) as n_rows, cast(12 as bigint) as n_columns, "
        f"'{','.join(COLUMNS)}' as columns from snapshot"
    ),
)
def table_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eda.table_shape(t.snapshot(spark, sf_dir))


@entry("label_counts", _with("select churn, count(*) as n_rows from snapshot group by churn"))
def label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eda.label_counts(t.snapshot(spark, sf_dir), LABEL)


@entry(
    "positive_rate",
    _with(
        "select round(avg(case when churn = 'Yes' then cast(1 as double) else 0 end) * 100, 3) "
        "as positive_rate_pct from snapshot"
    ),
)
def positive_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eda.positive_rate(t.snapshot(spark, sf_dir), LABEL)


@entry(
    "class_distribution",
    f"with {t.FEED_SQL}, names as (select unnest(['O', 'F']) as label), n as (select count(*) as "
    "n_all from feed) select label, count(status) as n_rows, round(cast(count(status) as double) "
    "* 100 / max(n_all), 3) as pct from names cross join n left join feed on status = label "
    "group by label",
)
def class_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third status value counts in the total and in neither class."""
    return eda.class_distribution(t.feed(spark, sf_dir), t.FEED_LABEL)


FEED_COLUMNS = [r.name for r in t.FEED_RULES]
MISSING_SQL = (
    f"with {t.FEED_SQL}, miss as ("
    + " union all ".join(
        f"select '{c}' as \"column\", count(*) filter (where {c} is null) as missing_count, "
        "count(*) as n_all from feed"
        for c in FEED_COLUMNS
    )
    + ") select \"column\", missing_count, "
    "round(cast(missing_count as double) * 100 / n_all, 2) as missing_pct "
    "from miss where missing_count > 0"
)


@entry("missing_by_column", MISSING_SQL)
def missing_by_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eda.missing_by_column(t.feed(spark, sf_dir))


@entry("missing_topk", MISSING_SQL + ' order by missing_count desc, "column" limit 3')
def missing_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eda.missing_topk(t.feed(spark, sf_dir), 3)


CARDINALITY_SQL = _with(
    " union all ".join(
        f"select '{c}' as \"column\", count(distinct {c}) + max(case when {c} is null then 1 "
        "else 0 end) as n_distinct from snapshot"
        for c in TEXTS
    )
)


@entry("cardinality", CARDINALITY_SQL)
def cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.snapshot(spark, sf_dir)
    return eda.cardinality(rows, eda.text_columns(rows, LABEL))


@entry("cardinality_topk", CARDINALITY_SQL + ' order by n_distinct desc, "column" limit 2')
def cardinality_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.snapshot(spark, sf_dir)
    return eda.cardinality_topk(rows, eda.text_columns(rows, LABEL), 2)


CORRELATION = " union all ".join(
    f"select '{c}' as name, corr(cast({c} as double), case when churn = 'Yes' then cast(1 as "
    f"double) else 0 end) as r, var_pop(cast({c} as double)) as v from snapshot"
    for c in NUMBERS
)


@entry(
    "label_correlation",
    _with(
        f"select name as \"column\", round(r, 6) as correlation from ({CORRELATION}) x "
        "where v > 0 order by abs(r) desc, name limit 15"
    ),
)
def label_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.snapshot(spark, sf_dir)
    found = eda.label_correlation(rows, LABEL, eda.number_columns(rows, LABEL))
    return found.select("column", F.round("correlation", 6).alias("correlation"))


def _fact(section: str, name: str, value: str, source: str = "snapshot") -> str:
    return (
        f"select '{section}' as section, '{name}' as name, cast({value} as double) as value "
        f"from {source}"
    )


EDA_SQL = _with(
    " union all ".join(
        [
            _fact("shape", "n_rows", "count(*)"),
            _fact("shape", "n_columns", "max(12)"),
            _fact(
                "positive_rate_pct", "Yes",
                "round(avg(case when churn = 'Yes' then cast(1 as double) else 0 end) * 100, 3)",
            ),
            "select 'label_count', churn, cast(count(*) as double) from snapshot group by churn",
            *[
                f"select * from ({_fact('missing_count', c, f'count(*) - count({c})')}) x "
                "where value > 0"
                for c in COLUMNS
            ],
            *[
                "select * from ("
                + _fact(
                    "missing_pct", c,
                    f"round(cast(count(*) - count({c}) as double) * 100 / count(*), 2)",
                )
                + f") x where (select count(*) - count({c}) from snapshot) > 0"
                for c in COLUMNS
            ],
            *[
                _fact(
                    "cardinality", c,
                    f"count(distinct {c}) + max(case when {c} is null then 1 else 0 end)",
                )
                for c in TEXTS
            ],
            f"select 'label_correlation', name, round(r, 6) from ({CORRELATION}) y where v > 0",
        ]
    )
)


@entry("eda_summary", EDA_SQL)
def eda_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eda.eda_summary(t.snapshot(spark, sf_dir), LABEL)


@entry("eda_job", EDA_SQL)
def eda_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary written as a JSON report and read back."""
    return explore.eda_job(t.snapshot(spark, sf_dir), LABEL, workspace.new_path(spark, "eda"))


# --- category sets ---------------------------------------------------------------------------


@entry(
    "contingency",
    f"with {t.DRIFT_SQL}, long as (select is_cur, 'l_returnflag' as \"column\", l_returnflag as "
    "value from pair union all select is_cur, 'l_linestatus', l_linestatus from pair union all "
    "select is_cur, 'holey', coalesce(holey, '__NA__') from pair) select \"column\", value, "
    "cast(sum(1 - is_cur) as bigint) as n_ref, cast(sum(is_cur) as bigint) as n_cur from long "
    "group by 1, 2",
)
def contingency(spark: SparkSession, sf_dir: str) -> DataFrame:
    reference, current = t.drift_pair(spark, sf_dir)
    return drift.contingency(reference, current, ["l_returnflag", "l_linestatus", "holey"])


def _language_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """English documents as the reference, the others as the current table."""
    documents = t.table(spark, sf_dir, "documents").select("lang", "source")
    english = F.col("lang") == "en"
    return documents.where(english), documents.where(~english)


@entry(
    "category_union",
    "select distinct 'lang' as \"column\", lang as value from documents union "
    "select distinct 'source', source from documents",
)
def category_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    reference, current = _language_tables(spark, sf_dir)
    return categories.category_union(reference, current, ["lang", "source"])


@entry(
    "unseen_categories",
    "select 'lang' as \"column\", lang as value from documents where lang <> 'en' group by lang "
    "union all select 'source', source from (select source from documents where lang <> 'en' "
    "except select source from documents where lang = 'en') x",
)
def unseen_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    reference, current = _language_tables(spark, sf_dir)
    return categories.unseen_categories(reference, current, ["lang", "source"])


LINE_NUMBERS = ["l_quantity", "l_discount", "l_linenumber"]


@entry(
    "merged_statistics",
    " union all ".join(
        f"select '{c}' as \"column\", count(*) as n_rows, count(*) - count({c}) as n_missing, "
        f"{smallest} as smallest, {largest} as largest, count(distinct {c}) as n_distinct, {near} as "
        "median_near from lineitem"
        for c, smallest, largest, near in [
            *[(c, f"min(cast({c} as double))", f"max(cast({c} as double))", "true") for c in LINE_NUMBERS],
            ("l_returnflag", "cast(null as double)", "cast(null as double)", "cast(null as boolean)"),
        ]
    ),
)
def merged_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of each year's lines; the last years are added later, without reading the earlier.

    Columns of few values have exact distinct counts. median_near: the exact rank of the merged median is within
    twice the stated bound of one half.
    """
    lines = t.table(spark, sf_dir, "lineitem")
    year = F.year("l_shipdate")
    path = workspace.new_path(spark, "sketches")
    for part in (lines.where(year < 1997), lines.where((year >= 1997) | year.isNull())):
        stored = sketches.add_parts(sketches.sketch_parts(part, year, LINE_NUMBERS, ["l_returnflag"]), path)
    merged = workspace.new_path(spark, "merged")
    sketches.summarize(stored).write.parquet(merged)
    summary = spark.read.parquet(merged)
    gaps = sketches.rank_gap(lines, summary.where(F.col("quantile").isNotNull()), LINE_NUMBERS)
    near = (F.col("gap") <= 2 * sketches.rank_error()).alias("median_near")
    return summary.join(gaps, "column", "left").select(
        "column", "n_rows", "n_missing", "smallest", "largest", "n_distinct", near
    )
