"""The driver's tables in the roles of a snapshot table, a raw feed, scored rows and a drift pair.

Each DataFrame here has a SQL twin used by the oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast import workspace
from holdfast.contracts import ColumnRule
from holdfast.sources import sinks
from holdfast.spec import LabelSpec, ModelingSpec, SplitSpec

SPLIT = SplitSpec()

SNAPSHOT_SPEC = ModelingSpec(
    id_column="customer_id",
    numeric={
        "is_debtor": "flag",
        "tenure_days": "optional",
        "n_orders": "whole",
        "avg_ticket": "optional",
        "total_spend": "optional",
        "acctbal": "number",
    },
    categorical=("segment", "region", "nation", "top_priority"),
    label=LabelSpec("churn"),
)


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables; its schema is read from a file footer once per path."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer: features from orders before the cut-off, label from orders after.

    One shuffle: orders are summed per customer on the map side first, so a customer with a
    third of all orders arrives as one row per map task.
    """
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_totalprice", "o_orderpriority", F.to_date("o_orderdate").alias("day")
    )
    cutoff = orders.agg(F.date_sub(F.max("day"), 365)).scalar()
    aged = orders.withColumn("age", F.datediff(cutoff, "day"))
    past = F.col("age") > 0
    per_customer = aged.groupBy("o_custkey").agg(
        F.count_if(past).alias("n_orders"),
        F.sum(F.when(past, F.col("o_totalprice"))).alias("spend"),
        F.max(F.when(past, F.col("age"))).alias("tenure_days"),
        F.count_if(~past).alias("n_after"),
        F.mode(F.when(past, F.col("o_orderpriority")), deterministic=True).alias("top_priority"),
    )
    customer = table(spark, sf_dir, "customer")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .join(per_customer, F.col("c_custkey") == F.col("o_custkey"), "left")
        .select(
            F.col("c_custkey").alias("customer_id"),
            (F.col("c_acctbal") < 0).cast("int").alias("is_debtor"),
            "tenure_days",
            F.coalesce("n_orders", F.lit(0)).cast("long").alias("n_orders"),
            F.round(F.try_divide("spend", "n_orders"), 6).alias("avg_ticket"),
            F.round("spend", 2).alias("total_spend"),
            F.col("c_acctbal").alias("acctbal"),
            F.col("c_mktsegment").alias("segment"),
            F.col("r_name").alias("region"),
            F.col("n_name").alias("nation"),
            "top_priority",
            F.when(F.coalesce("n_after", F.lit(0)) == 0, "Yes").otherwise("No").alias("churn"),
        )
    )


def written_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot as a table: fitting and splitting read it several times."""
    path = workspace.new_path(spark, "snapshot") + ".parquet"
    return spark.read.parquet(sinks.write_table(snapshot(spark, sf_dir), path))


SNAPSHOT_SQL = """
cut as (select cast(max(o_orderdate) as date) - 365 as cutoff from orders),
past as (select o.*, cutoff from orders o cross join cut where cast(o_orderdate as date) < cutoff),
hist as (select o_custkey, count(*) as n_orders, round(sum(o_totalprice), 2) as total_spend,
                round(avg(o_totalprice), 6) as avg_ticket, max(cutoff) as cutoff,
                min(cast(o_orderdate as date)) as first_day from past group by o_custkey),
prio as (select o_custkey, o_orderpriority as top_priority from (
           select o_custkey, o_orderpriority, row_number() over (
             partition by o_custkey order by count(*) desc, o_orderpriority asc) as rn
           from past group by o_custkey, o_orderpriority) x where rn = 1),
fut as (select distinct o_custkey from orders cross join cut
        where cast(o_orderdate as date) >= cutoff),
snapshot as (
  select c_custkey as customer_id, case when c_acctbal < 0 then 1 else 0 end as is_debtor,
         cast(date_diff('day', h.first_day, h.cutoff) as integer) as tenure_days,
         coalesce(h.n_orders, 0) as n_orders, h.avg_ticket, h.total_spend,
         c_acctbal as acctbal, c_mktsegment as segment, r_name as region, n_name as nation,
         p.top_priority, case when f.o_custkey is null then 'Yes' else 'No' end as churn
  from customer c join nation on c_nationkey = n_nationkey
  join region on n_regionkey = r_regionkey
  left join hist h on h.o_custkey = c_custkey left join prio p on p.o_custkey = c_custkey
  left join fut f on f.o_custkey = c_custkey)
"""

# Exact quotas by largest remainder and the hash order inside each class.
SPLIT_SQL = (
    SNAPSHOT_SQL
    + """,
cls as (select churn, count(*) as c from snapshot group by churn),
tot as (select sum(c) as n, cast(ceil(cast(sum(c) as double) * cast(0.15 as double)) as bigint)
               as n_test from cls),
tot2 as (select n, n_test, cast(ceil(cast(n - n_test as double)
           * (cast(0.15 as double) / (cast(0.7 as double) + cast(0.15 as double)))) as bigint)
           as n_val from tot),
rest0 as (select churn, c, n, n_test, n_val,
                 cast(c as double) * cast(n - n_test as double) / cast(n as double) as x
          from cls cross join tot2),
rest1 as (select *, floor(x) + case when row_number() over (order by x - floor(x) desc, churn)
                 <= (n - n_test) - sum(floor(x)) over () then 1 else 0 end as rest from rest0),
train0 as (select *, cast(rest as double) * cast(n - n_test - n_val as double)
                  / cast(n - n_test as double) as tx from rest1),
quota as (select churn, c - rest as q_test,
                 rest - (floor(tx) + case when row_number() over (
                     order by tx - floor(tx) desc, churn)
                   <= (n - n_test - n_val) - sum(floor(tx)) over () then 1 else 0 end) as q_val
          from train0),
ordered as (select s.*, row_number() over (partition by churn
              order by md5(concat('42:', cast(customer_id as varchar)))) as rn from snapshot s),
split as (select o.*, case when rn <= q_test then 'test'
                           when rn <= q_test + q_val then 'validation' else 'train' end as split
          from ordered o join quota using (churn))
"""
)

# --- raw feed: text fields with the faults a real feed has --------------------------------

FEED_LABEL = LabelSpec("status", positive="F", negative="O")

FEED_RULES: tuple[ColumnRule, ...] = (
    ColumnRule("order_key", T.LongType()),
    ColumnRule("order_id", T.StringType()),
    ColumnRule("flag_text", T.LongType(), domain=(0, 1)),
    ColumnRule("units_text", T.LongType(), minimum=0),
    ColumnRule("price_text", T.DoubleType(), nullable=True, minimum=0),
    ColumnRule("amount", T.DoubleType(), minimum=0),
    ColumnRule(
        "priority",
        T.StringType(),
        domain=("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"),
    ),
    ColumnRule("status", T.StringType(), domain=("F", "O")),
)

FEED_SPEC = ModelingSpec(
    id_column="order_id",
    numeric={
        "flag_text": "flag",
        "units_text": "whole",
        "price_text": "optional",
        "amount": "amount",
    },
    categorical=("priority",),
    label=FEED_LABEL,
)

FEED_SQL_SELECT = """
select o_orderkey as order_key,
       case when o_orderkey % 97 = 0 then '  ' else concat(' O', cast(o_orderkey as {text})) end
         as order_id,
       case o_orderkey % 7 when 0 then '0' when 1 then '1' when 2 then ' 1 ' when 3 then '1.0'
         when 4 then null when 5 then '0.5' else 'x' end as flag_text,
       case o_orderkey % 11 when 0 then '-3' when 1 then '2.5' when 2 then null
         else cast(o_orderkey % 50 as {text}) end as units_text,
       case when o_orderkey % 17 = 0 then ' ' when o_orderkey % 23 = 0 then 'n/a'
         when o_orderkey % 29 = 0 then '1d' when o_orderkey % 37 = 0 then '-1e3'
         else cast(o_totalprice as {text}) end as price_text,
       case when o_orderkey % 31 = 0 then -o_totalprice when o_orderkey % 41 = 0 then null
         else o_totalprice end as amount,
       case when o_orderkey % 13 = 0 then null when o_orderkey % 19 = 0 then 'BOGUS'
         else o_orderpriority end as priority,
       o_orderstatus as status
from {orders}
"""
FEED_SQL = "feed as (" + FEED_SQL_SELECT.format(text="varchar", orders="orders") + ")"


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a raw feed row."""
    return spark.sql(
        FEED_SQL_SELECT.format(text="string", orders="{orders}"),
        orders=table(spark, sf_dir, "orders"),
    )


# --- scored rows ----------------------------------------------------------------------------

SCORED_LABEL = LabelSpec("l_returnflag", positive="R", negative="N")

SCORED_SQL = """
scored as (
  select l_linestatus, l_linenumber, case when l_linestatus = 'O' then 'validation' else 'test' end
           as split,
         (l_quantity / cast(50 as double) + l_extendedprice / cast(105000 as double)
           + l_discount * cast(5 as double)) / cast(2.5 as double) as score,
         case when l_returnflag = 'R' then 1 else 0 end as y
  from lineitem)
"""

CUMULATIVE_SQL = (
    SCORED_SQL
    + """,
per_score as (select split, score, sum(y) as pos, sum(1 - y) as neg
              from scored group by split, score),
cum as (select split, score, pos, neg,
               sum(pos) over (partition by split order by score desc) as cpos,
               sum(neg) over (partition by split order by score desc) as cneg,
               sum(pos) over (partition by split) as apos,
               sum(neg) over (partition by split) as aneg
        from per_score)
"""
)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line with a score in 0..1 and a 0/1 label; line status plays the split."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(
        "l_linestatus",
        "l_linenumber",
        F.when(F.col("l_linestatus") == "O", "validation").otherwise("test").alias("split"),
        (
            (
                F.col("l_quantity") / F.lit(50.0)
                + F.col("l_extendedprice") / F.lit(105000.0)
                + F.col("l_discount") * F.lit(5.0)
            )
            / F.lit(2.5)
        ).alias("score"),
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
    )


# --- drift pair -----------------------------------------------------------------------------

DRIFT_SPEC = ModelingSpec(
    id_column="l_orderkey",
    numeric={
        "l_quantity": "number",
        "l_extendedprice": "number",
        "l_discount": "number",
        "l_tax": "number",
        "moved": "number",
        "rarely": "optional",
        "absent_number": "number",
    },
    categorical=("l_returnflag", "l_linestatus", "holey", "constant", "absent_text"),
    label=LabelSpec("_label"),
)

DRIFT_SQL = """
mid as (select min(l_shipdate) + (max(l_shipdate) - min(l_shipdate)) / 2 as middle from lineitem),
pair as (
  select case when l_shipdate >= middle then 1 else 0 end as is_cur, l_quantity, l_extendedprice,
         l_discount, l_tax,
         case when l_shipdate >= middle then l_quantity + 80 else l_quantity end as moved,
         cast(null as double) as rarely, l_returnflag, l_linestatus,
         case when l_quantity > 45 then null else l_linestatus end as holey, 'same' as constant
  from lineitem cross join mid)
"""


def drift_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Lines shipped before and from the middle of the ship-date range on.

    ``moved`` carries a planted shift, ``rarely`` has no value, ``holey`` has missing categories.
    """
    lines = table(spark, sf_dir, "lineitem")
    first, last = F.min("l_shipdate"), F.max("l_shipdate")
    middle = lines.agg((first + (last - first) / 2).alias("at")).scalar()
    late = F.col("l_shipdate") >= middle

    def side(rows: DataFrame, shift: float) -> DataFrame:
        return rows.select(
            "l_quantity",
            "l_extendedprice",
            "l_discount",
            "l_tax",
            (F.col("l_quantity") + shift).alias("moved"),
            F.lit(None).cast("double").alias("rarely"),
            "l_returnflag",
            "l_linestatus",
            F.when(F.col("l_quantity") <= 45, F.col("l_linestatus")).alias("holey"),
            F.lit("same").alias("constant"),
        )

    return side(lines.where(~late), 0.0), side(lines.where(late), 80.0)
