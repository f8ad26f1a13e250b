"""Sliding windows, their coverage by intervals, and budgets within groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.shared import materialize


def numbered(df: DataFrame, order: Sequence[Column], name: str = "rn") -> DataFrame:
    """``df`` with dense numbers from 1 on in a total order, without one task for all rows.

    Rows are dealt by ranges and numbered within; a range starts after the rows of
    the ranges before it, and only the table of ranges is summed in one task.
    """
    dealt = materialize(df.repartitionByRange(*order).withColumn("__p", F.spark_partition_id()), "ranges")
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("__p").agg(F.count("*").alias("__n")).select("__p", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    within = F.row_number().over(Window.partitionBy("__p").orderBy(*order))
    return dealt.withColumn("__rn", within).join(F.broadcast(starts), "__p").withColumn(name, F.col("__start") + F.col("__rn")).drop("__p", "__rn", "__start")


def sliding(df: DataFrame, length: str, size: int, hop: int) -> DataFrame:
    """Complete windows (w, start, end) of each row with ``length``; a tail that doesn't fill one is dropped."""
    out = df.where(F.col(length) >= size).withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), F.col(length) - size, F.lit(hop).cast("long"))))
    return out.withColumn("end", F.col("start") + size).withColumn("w", (F.col("start") / hop).cast("long"))


def coverage(intervals: DataFrame, keys: Sequence[str], size: int, hop: int) -> DataFrame:
    """(keys, w, active): how much of each window disjoint intervals cover.

    An interval knows the windows it meets from its own ends, so it is spread
    over them and summed; there is no join of windows with intervals.
    """
    first = F.greatest(F.lit(0), F.expr(f"floor((start - {size}) / {hop}) + 1")).cast("long")
    last = F.expr(f"ceil(end / {hop}) - 1").cast("long")
    met = intervals.where("end > start and end > 0").withColumn("__f", first).withColumn("__l", last).where("__l >= __f")
    met = met.withColumn("w", F.explode(F.sequence("__f", "__l")))
    part = F.least(F.col("end"), F.col("w") * hop + size) - F.greatest(F.col("start"), F.col("w") * hop)
    return met.groupBy(*keys, "w").agg(F.sum(F.greatest(part, F.lit(0))).alias("active"))


def within_budget(df: DataFrame, keys: Sequence[str], size: Column, ties: Sequence[str], k: int, budget: float) -> DataFrame:
    """The ``k`` largest rows of each key, as long as the budget isn't used up before the row (the last may overshoot)."""
    order = Window.partitionBy(*keys).orderBy(F.desc("__size"), *ties)
    out = df.withColumn("__size", size).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    used = F.coalesce(F.sum("__size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return out.withColumn("used_before", used).where(F.col("used_before") < budget).drop("__size")
