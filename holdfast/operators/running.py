"""Running totals over a global order without a single-task window.

A window with no partition, or partitioned by a handful of groups, sends everything to a
handful of tasks. Here the order column is cut into value ranges first: every range adds up
on its own, and the totals of the ranges before it are joined in. The result is exact.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Up to this many rows a group is summed by one window partition.
ONE_RANGE_ROWS = 1_000_000
#: Most value ranges.
MOST_RANGES = 10_000
#: Range totals are broadcast up to this many rows, groups times ranges, and joined beyond it.
BROADCAST_ROWS = 200_000


@dataclass(frozen=True)
class ValueRanges:
    """Cut points shared by all groups, and how many groups there are."""

    edges: tuple[float, ...]
    groups: int


def measure_ranges(
    rows: DataFrame,
    order_by: str,
    by: Sequence[str] = (),
    one_range_rows: int = ONE_RANGE_ROWS,
    most_ranges: int = MOST_RANGES,
) -> ValueRanges:
    """Choose cut points that keep every range of a large group small. One row reaches the driver.

    Cut points are quantiles over the rows of all groups above ``one_range_rows``, shared by all
    groups: a range holds no more rows, of any group, than its share of them all. A value repeated
    in a third of the rows is one grouped row later on. Groups may be as many as they like; those
    that are small are summed by one window partition each, cut or not.
    """
    # Counting rows, not values, leaves a costly score uncomputed; it can only be an upper bound.
    sizes = rows.groupBy(*by).agg(F.count("*").alias("n"))
    large = F.col("n") > one_range_rows
    facts = sizes.agg(
        F.count("*").alias("groups"),
        F.count_if(large).alias("large"),
        F.coalesce(F.sum(F.when(large, F.col("n"))), F.lit(0)).alias("in_large"),
    ).first()
    groups = max(facts["groups"], 1)
    if not facts["large"]:
        return ValueRanges((), groups)
    if facts["large"] < facts["groups"]:
        names = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
        rows = rows.join(
            sizes.where(large).select(*[F.col(c).alias(f"_{c}") for c in by]),
            reduce(and_, names),
            "left_semi",
        )
    count = max(2, min(most_ranges, 1 + (4 * facts["in_large"]) // one_range_rows))
    shares = [i / count for i in range(1, count)]
    cuts = rows.agg(F.percentile_approx(order_by, shares, max(10_000, 8 * count)).alias("cuts"))
    edges = {float(e) for e in cuts.first()["cuts"] or () if not math.isnan(e)}
    return ValueRanges(tuple(sorted(edges)), groups)


def running_totals(
    counts: DataFrame,
    order_by: str,
    totals: Sequence[str],
    ranges: ValueRanges,
    by: Sequence[str] = (),
    descending: bool = False,
) -> DataFrame:
    """Add ``cum_<c>`` (running total) and ``all_<c>`` (group total) for every column of totals.

    ``counts`` holds one row per group and value of ``order_by``.
    """
    by = list(by)
    order = F.col(order_by).desc() if descending else F.col(order_by).asc()
    if not ranges.edges:
        upto = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        whole = Window.partitionBy(*by).orderBy(order).rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing
        )
        return counts.select(
            "*",
            *[F.sum(c).over(upto).alias(f"cum_{c}") for c in totals],
            *[F.sum(c).over(whole).alias(f"all_{c}") for c in totals],
        )

    splits = [float("-inf"), *ranges.edges, float("inf")]
    ranged = Bucketizer(splits=splits, inputCol=order_by, outputCol="_range").transform(counts)
    per_range = ranged.groupBy(*by, "_range").agg(*[F.sum(c).alias(f"_sum_{c}") for c in totals])
    range_order = F.col("_range").desc() if descending else F.col("_range").asc()
    before = Window.partitionBy(*by).orderBy(range_order).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    offsets = per_range.select(
        *by,
        "_range",
        *[F.coalesce(F.sum(f"_sum_{c}").over(before), F.lit(0)).alias(f"_off_{c}") for c in totals],
        *[F.sum(f"_sum_{c}").over(whole).alias(f"all_{c}") for c in totals],
    )
    inside = (
        Window.partitionBy(*by, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    )
    summed = ranged.select("*", *[F.sum(c).over(inside).alias(f"_in_{c}") for c in totals])
    if ranges.groups * (len(ranges.edges) + 1) <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    return summed.join(offsets, [*by, "_range"]).select(
        *counts.columns,
        *[(F.col(f"_in_{c}") + F.col(f"_off_{c}")).alias(f"cum_{c}") for c in totals],
        *[f"all_{c}" for c in totals],
    )
