"""Validation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.catalog import tables as t
from holdfast.catalog.entries import entry
from holdfast.operators import quality, row_rules, splitting

WHOLE = "regexp_matches(trim({c}), '^[+-]?[0-9]+$')"
REAL = "regexp_matches(trim({c}), '^[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)([eE][+-]?[0-9]+)?$')"
NUMBER = "case when " + REAL + " then cast(trim({c}) as double) end"
PRIORITIES = "('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')"


def _rule_sql(rule: str, column: str, broken: str) -> str:
    return (
        f"select '{rule}' as rule, '{column}' as \"column\", count(*) filter (where {broken}) "
        f"as n_failed, min(case when {broken} then cast({column} as varchar) end) "
        "as sample_value from feed"
    )


TYPE_SQL = [
    _rule_sql("type", "order_key", "false"),
    _rule_sql("type", "order_id", "false"),
    _rule_sql("type", "flag_text", f"flag_text is not null and not {WHOLE.format(c='flag_text')}"),
    _rule_sql(
        "type", "units_text", f"units_text is not null and not {WHOLE.format(c='units_text')}"
    ),
    _rule_sql("type", "price_text", f"price_text is not null and not {REAL.format(c='price_text')}"),
    _rule_sql("type", "amount", "false"),
    _rule_sql("type", "priority", "false"),
    _rule_sql("type", "status", "false"),
]
NULL_SQL = [
    _rule_sql("not_null", c, f"{c} is null")
    for c in ("order_key", "order_id", "flag_text", "units_text", "amount", "priority", "status")
]
DOMAIN_SQL = [
    _rule_sql("domain", "flag_text", f"({NUMBER.format(c='flag_text')}) not in (0, 1)"),
    _rule_sql("domain", "priority", f"priority not in {PRIORITIES}"),
    _rule_sql("domain", "status", "status not in ('F', 'O')"),
]
RANGE_SQL = [
    _rule_sql("minimum", "units_text", f"({NUMBER.format(c='units_text')}) < 0"),
    _rule_sql("minimum", "price_text", f"({NUMBER.format(c='price_text')}) < 0"),
    _rule_sql("minimum", "amount", "amount < 0"),
]


def _all(parts: list[str]) -> str:
    return f"with {t.FEED_SQL} " + " union all ".join(parts)


def _numeric_samples(df: DataFrame) -> DataFrame:
    """Samples of the one double column are compared by their rule, not by number formatting."""
    sample = F.when(F.col("column") != "amount", F.col("sample_value"))
    return df.withColumn("sample_value", sample)


AMOUNT_FREE = (
    "select rule, \"column\", n_failed, case when \"column\" <> 'amount' then sample_value end "
    "as sample_value from ({body}) x"
)


@entry("validate_types", _all(TYPE_SQL))
def validate_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.feed(spark, sf_dir)
    return quality.count_failures(rows, quality.type_checks(rows, t.FEED_RULES))


@entry("validate_nulls", _all(NULL_SQL))
def validate_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.feed(spark, sf_dir)
    return quality.count_failures(rows, quality.null_checks(rows, t.FEED_RULES))


@entry("validate_domain", _all(DOMAIN_SQL))
def validate_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.feed(spark, sf_dir)
    return quality.count_failures(rows, quality.domain_checks(rows, t.FEED_RULES))


@entry(
    "validate_range",
    f"with {t.FEED_SQL} " + AMOUNT_FREE.format(body=" union all ".join(RANGE_SQL)),
)
def validate_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.feed(spark, sf_dir)
    return _numeric_samples(
        quality.count_failures(rows, quality.range_checks(rows, t.FEED_RULES))
    )


EVERY_RULE = " union all ".join(TYPE_SQL + NULL_SQL + DOMAIN_SQL + RANGE_SQL)


@entry(
    "validate_report",
    f"with {t.FEED_SQL} " + AMOUNT_FREE.format(body=EVERY_RULE) + " where n_failed > 0",
)
def validate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numeric_samples(quality.violations(t.feed(spark, sf_dir), t.FEED_RULES))


@entry(
    "validate_columns",
    f"with {t.FEED_SQL}, counted as ("
    + AMOUNT_FREE.format(body=" union all ".join(
        p for p in TYPE_SQL + NULL_SQL + DOMAIN_SQL + RANGE_SQL if "'status'" not in p
    ))
    + " where n_failed > 0) select rule, \"column\", n_failed from counted "
    "union all select 'column_missing', 'status', 1 "
    "union all select 'column_unexpected', 'state', 1",
)
def validate_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed with one column renamed: both sides of the difference, and the other breaks."""
    renamed = t.feed(spark, sf_dir).withColumnRenamed("status", "state")
    return quality.violations(renamed, t.FEED_RULES).select("rule", "column", "n_failed")


ROW_SQL = f"""
with {t.FEED_SQL},
read as (
  select *, {NUMBER.format(c="flag_text")} as f, {NUMBER.format(c="price_text")} as p,
         case when {WHOLE.format(c="units_text")} then cast(trim(units_text) as bigint) end as u
  from feed),
ruled as (
  select order_key, trim(order_id) as order_id, cast(trunc(f) as integer) as flag_text,
         cast(trunc({NUMBER.format(c="units_text")}) as bigint) as units_text, p as price_text,
         amount, trim(priority) as priority, status,
         concat_ws('; ',
           case when coalesce(trim(order_id), '') = '' then 'order_id: must not be empty' end,
           case when f is null or trunc(f) not in (0, 1) then 'flag_text: must be 0 or 1' end,
           case when u is null or u < 0 then 'units_text: must be a whole number, 0 or more' end,
           case when coalesce(trim(price_text), '') <> '' and p is null
                then 'price_text: must be a number or blank' end,
           case when amount is null or amount < 0
                then 'amount: must be a number, 0 or more' end,
           case when coalesce(trim(priority), '') = '' then 'priority: must not be empty' end
         ) as reasons
  from read)
"""


@entry(
    "row_rules",
    ROW_SQL + "select order_key, order_id, flag_text, units_text, price_text, amount, priority, "
    "status, reasons from ruled",
)
def row_rules_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row as read, with the reasons it would be refused for."""
    checked = row_rules.check_rows(t.feed(spark, sf_dir), t.FEED_SPEC, carry=["order_key"])
    return checked.withColumn("reasons", F.array_join("reasons", "; "))


@entry(
    "row_accepted",
    ROW_SQL + "select order_id, flag_text, units_text, price_text, amount, priority, status "
    "from ruled where reasons = ''",
)
def row_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = row_rules.check_rows(t.feed(spark, sf_dir).drop("order_key"), t.FEED_SPEC)
    return row_rules.accepted(checked)


@entry(
    "row_reject_reasons",
    ROW_SQL + "select reason, count(*) as n_rows from (select unnest(string_split(reasons, '; ')) "
    "as reason from ruled where reasons <> '') x group by reason",
)
def row_reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows each reason refuses."""
    checked = row_rules.check_rows(t.feed(spark, sf_dir).drop("order_key"), t.FEED_SPEC)
    reasons = row_rules.rejected(checked).select(F.explode("reasons").alias("reason"))
    return reasons.groupBy("reason").agg(F.count("*").alias("n_rows"))


@entry(
    "row_unknown_columns",
    f"with {t.FEED_SQL} select 'order_key' as \"column\", count(*) as n_refused from feed",
)
def row_unknown_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A surplus column refuses the whole input: the column, and the rows refused with it."""
    rows = t.feed(spark, sf_dir)
    surplus = row_rules.unknown_columns(rows, t.FEED_SPEC)
    return rows.agg(F.count("*").alias("n_refused")).select(
        F.explode(F.array(*[F.lit(c) for c in surplus])).alias("column"), "n_refused"
    )


@entry(
    "split_integrity",
    f"with {t.SPLIT_SQL}, rates as (select split, avg(case when churn = 'Yes' then 1.0 else 0 end) "
    "as rate from split group by split), overall as (select avg(case when churn = 'Yes' then 1.0 "
    "else 0 end) as rate from split) "
    "select 'ids_in_two_splits' as \"check\", cast(count(*) filter (where k > 1) as double) as value "
    "from (select customer_id, count(distinct split) as k from split group by customer_id) x "
    "union all select 'rows_without_split', cast(count(*) filter (where split is null) as double) "
    "from split union all select concat('rate_gap_', r.split), round(abs(r.rate - o.rate), 6) "
    "from rates r cross join overall o",
)
def split_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = splitting.stratified_split(t.written_snapshot(spark, sf_dir), "customer_id", "churn", t.SPLIT)
    return splitting.split_integrity(split, t.SNAPSHOT_SPEC)


LEAK_COLUMNS = ("segment", "region", "nation", "top_priority")


@entry(
    "leakage_checks",
    f"with {t.SNAPSHOT_SQL}, long as ("
    + " union all ".join(
        f"select '{c}' as col, {c} as v, case when churn = 'Yes' then 1 else 0 end as y "
        "from snapshot"
        for c in LEAK_COLUMNS
    )
    + "), per as (select col, v, sum(y) as pos, sum(1 - y) as neg from long group by col, v) "
    "select 'id_unique' as \"check\", 'customer_id' as \"column\", "
    "count(distinct customer_id) as n_values, count(distinct customer_id) as n_pure, "
    "round(cast(count(distinct customer_id) as double) / count(*), 6) as share, "
    "count(*) = count(distinct customer_id) as suspect from snapshot union all "
    "select 'label_determined', col, count(*), count(*) filter (where least(pos, neg) = 0), "
    "round(cast(sum(greatest(pos, neg)) as double) / sum(pos + neg), 6), "
    "sum(least(pos, neg)) = 0 from per group by col",
)
def leakage_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.leakage_checks(t.snapshot(spark, sf_dir), t.SNAPSHOT_SPEC)
