"""Running totals over a sorted table of any length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.session import materialize


def with_running_total(
    df: DataFrame, order_by: str, amount: str, name: str,
    totals: dict[str, Column] | None = None,
) -> DataFrame:
    """Add `name`: the sum of `amount` over all rows up to and including this one.

    Rows are spread by ranges of `order_by` and written with the number of their range, so
    that a range keeps its rows from here on. The sums of the ranges, one row each, are added
    up first; every range then only sums its own rows. No task sees the whole table. Each
    column of `totals` is summed over the whole table and added to every row, from the
    same sums of ranges.
    """
    totals = totals or {}
    ranged = materialize(
        df.repartitionByRange(order_by).withColumn("range", F.spark_partition_id()), "ranges")
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    starts = ranged.groupBy("range").agg(
        F.sum(amount).alias("held"), *(F.sum(value).alias(t) for t, value in totals.items()))
    starts = starts.select(
        "range", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("start"),
        *(F.sum(t).over(whole).alias(t) for t in totals))
    within = F.sum(amount).over(Window.partitionBy("range").orderBy(order_by))
    return (
        ranged.join(starts, "range")
        .select(*df.columns, (F.col("start") + within).alias(name), *totals))
