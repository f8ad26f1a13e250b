"""Weighted votes, weighted mean vectors, descriptive statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def vote(df: DataFrame, keys: Sequence[str], label: str, weight: Column) -> DataFrame:
    """(keys, label, confidence, n, mixed): the label with the most weight (least label in a tie), its share of the weight."""
    tally = df.groupBy(*keys, label).agg(F.sum(weight).alias("w"), F.count("*").alias("c"))
    order = Window.partitionBy(*keys).orderBy(F.desc("w"), F.asc(label))
    every = Window.partitionBy(*keys)
    out = tally.withColumn("rn", F.row_number().over(order)).withColumns(
        {"all": F.sum("w").over(every), "n": F.sum("c").over(every), "mixed": F.count("*").over(every) > 1}
    )
    share = F.when(F.col("all") > 0, F.round(F.col("w") / F.col("all"), 4)).otherwise(0.0)
    return out.where("rn = 1").select(*keys, label, share.alias("confidence"), "n", "mixed")


def mean_vectors(df: DataFrame, keys: Sequence[str], vector: str, weight: Column) -> DataFrame:
    """(keys, pos, x): the weighted mean vector of each key at unit length, in long form.

    Sums combine per position before the shuffle; a key with many rows is no
    single task's.
    """
    long = df.select(*keys, weight.cast("double").alias("w"), F.posexplode(vector).alias("pos", "v"))
    mean = long.groupBy(*keys, "pos").agg((F.sum(F.col("v").cast("double") * F.col("w")) / F.sum("w")).alias("m"))
    norm = F.sqrt(F.sum(F.col("m") * F.col("m")).over(Window.partitionBy(*keys)))
    return mean.withColumn("x", F.col("m") / F.greatest(norm, F.lit(1e-12))).drop("m")


def describe(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """n, mean, p50, p90 (interpolated), max by key."""
    q = F.percentile(value, F.array(F.lit(0.5), F.lit(0.9)))
    out = df.groupBy(*keys).agg(F.count(value).alias("n"), F.round(F.avg(value), 4).alias("mean"), q.alias("q"), F.round(F.max(value), 4).alias("max"))
    return out.withColumns({"p50": F.round(F.col("q")[0], 4), "p90": F.round(F.col("q")[1], 4)}).drop("q")
