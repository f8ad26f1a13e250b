"""Interval algebra on tables of half-open (start, end) rows under key columns.

Everything is a sweep over sorted boundaries with window functions: one
shuffle on the keys, no join of intervals with intervals, so a key with many
intervals costs n log n and not n squared. Integer times are exact.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def merge(df: DataFrame, keys: Sequence[str], gap: float = 0) -> DataFrame:
    """Union of the intervals of each key; those at most ``gap`` apart join, nested ones vanish."""
    order = Window.partitionBy(*keys).orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = (reach.isNull() | (F.col("start") - reach > gap)).cast("int")
    marked = df.select(*keys, "start", "end").withColumn("__new", opens)
    marked = marked.withColumn("__island", F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*keys, "__island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("__island")


def merge_by_session(df: DataFrame, keys: Sequence[str], gap_ms: int = 0) -> DataFrame:
    """``merge`` for whole milliseconds as dynamic-gap session windows (the form that also streams)."""
    stamp = F.timestamp_millis(F.col("start"))
    length = F.concat((F.col("end") - F.col("start") + gap_ms).cast("string"), F.lit(" milliseconds"))
    out = df.groupBy(*keys, F.session_window(stamp, length).alias("w")).agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return out.drop("w")


def sweep(sides: dict[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Elementary pieces (keys, start, end) between neighbouring boundaries, with the depth of each side."""

    def ends(name: str, df: DataFrame) -> DataFrame:
        open_, close = df.where("end > start").select(*keys, F.col("start").alias("t"), F.lit(1).alias("by")), df.where("end > start").select(
            *keys, F.col("end").alias("t"), F.lit(-1).alias("by")
        )
        return open_.unionByName(close).select(*keys, "t", *[(F.col("by") if n == name else F.lit(0)).alias(n) for n in sides])

    every = reduce(DataFrame.unionByName, [ends(n, d) for n, d in sides.items()])
    steps = every.groupBy(*keys, "t").agg(*[F.sum(n).alias(n) for n in sides])
    order = Window.partitionBy(*keys).orderBy("t")
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    out = steps.select(*keys, F.col("t").alias("start"), F.lead("t").over(order).alias("end"), *[F.sum(n).over(running).alias(n) for n in sides])
    return out.where("end is not null")


def subtract(df: DataFrame, cuts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What of ``df`` (as a union) no interval of ``cuts`` covers, as maximal pieces."""
    return merge(sweep({"__a": df, "__b": cuts}, keys).where("__a > 0 and __b = 0"), keys)


def intersect(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What both cover, as maximal pieces."""
    return merge(sweep({"__a": a, "__b": b}, keys).where("__a > 0 and __b > 0"), keys)


def split_long(df: DataFrame, longest: float) -> DataFrame:
    """Each interval in ceil(length / longest) equal pieces, numbered by ``piece``."""
    n = F.greatest(F.ceil((F.col("end") - F.col("start")) / F.lit(longest)), F.lit(1)).cast("int")
    out = df.withColumn("__n", n).withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
    step = (F.col("end") - F.col("start")) / F.col("__n")
    return out.withColumns({"start": F.col("start") + F.col("piece") * step, "end": F.col("start") + (F.col("piece") + 1) * step}).drop("__n")


def total(df: DataFrame, keys: Sequence[str], name: str = "speech") -> DataFrame:
    """Length of the union by key."""
    return merge(df, keys).groupBy(*keys).agg(F.sum(F.col("end") - F.col("start")).alias(name))


def overlap_ratio(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, both, either, ratio): lengths of intersection and union, and their ratio (0 if both are silent)."""
    length = F.col("end") - F.col("start")
    pieces = sweep({"__a": a, "__b": b}, keys)
    both = F.coalesce(F.sum(F.when((F.col("__a") > 0) & (F.col("__b") > 0), length)), F.lit(0))
    either = F.coalesce(F.sum(F.when((F.col("__a") > 0) | (F.col("__b") > 0), length)), F.lit(0))
    out = pieces.groupBy(*keys).agg(both.alias("both"), either.alias("either"))
    return out.withColumn("ratio", F.when(F.col("either") > 0, F.col("both") / F.col("either")).otherwise(0.0))


def request_spans(df: DataFrame, keys: Sequence[str], n_samples: Column, sr: int, out_sr: int, gap: int, shortest: int, context: int) -> DataFrame:
    """Spans (a, b, inner_a, inner_b) to send out and to splice back, from intervals in milliseconds.

    Intervals at most ``gap`` apart are one request, those shorter than
    ``shortest`` none; ``context`` is added on both sides within the file. The
    splice bounds come from the times at the output rate.
    """
    k = out_sr // sr
    at = lambda ms, rate: F.expr(f"({ms}) * {rate} div 1000")  # noqa: E731  both are truncated towards zero
    m = merge(df, keys, gap).where(F.col("end") - F.col("start") >= shortest)
    m = m.withColumn("a", F.greatest(F.lit(0), at(f"start - {context}", sr))).withColumn("b", F.least(n_samples, at(f"end + {context}", sr)))
    m = m.withColumn("inner_a", F.greatest(F.col("a") * k, at("start", out_sr))).withColumn("inner_b", F.least(F.col("b") * k, at("end", out_sr)))
    return m.where("inner_b > inner_a").select(*keys, "a", "b", "inner_a", "inner_b")


def grow(df: DataFrame, keys: Sequence[str], by: int) -> DataFrame:
    """Dilation: each side wider by ``by``, overlaps joined."""
    return merge(df.withColumns({"start": F.col("start") - by, "end": F.col("end") + by}), keys)


def shrink(df: DataFrame, keys: Sequence[str], by: int) -> DataFrame:
    """Erosion of the union: each side narrower by ``by``, empty pieces dropped."""
    return merge(df, keys).withColumns({"start": F.col("start") + by, "end": F.col("end") - by}).where("end > start")
