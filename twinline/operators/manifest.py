"""Manifests: rollups per split, folds of variants, keyed appends, cache reuse by fingerprint."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def fold_calls(rows: DataFrame) -> DataFrame:
    """One row per call: the clean one where there is one, else the lowest variant."""
    order = Window.partitionBy("call").orderBy(F.col("variant").asc_nulls_first())
    return rows.withColumn("__rn", F.row_number().over(order)).where("__rn = 1").drop("__rn")


def split_rollup(rows: DataFrame, chunks: DataFrame, splits: Sequence[str]) -> DataFrame:
    """Per configured or found split: rows, calls, hours of rows, hours of calls, speakers, chunks; zeros for an empty one."""
    spark = rows.sparkSession
    by_row = rows.groupBy("split").agg(F.count("*").alias("rows"), F.countDistinct("call").alias("calls"), F.round(F.sum("duration") / 3600, 4).alias("hours"))
    clean = fold_calls(rows).groupBy("split").agg(F.round(F.sum("duration") / 3600, 4).alias("clean_hours"))
    speakers = rows.select("split", F.explode("speakers").alias("s")).groupBy("split").agg(F.countDistinct("s").alias("speakers"))
    per_chunk = chunks.groupBy("split").agg(F.count("*").alias("chunks"))
    names = spark.createDataFrame([(s,) for s in splits], "split string")
    out = names.join(by_row, "split", "full_outer").join(clean, "split", "left").join(speakers, "split", "left").join(per_chunk, "split", "left")
    return out.na.fill(0)


def merge_append(batches: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """Last write wins: one row per key, from the latest batch."""
    rest = [c for c in batches.columns if c not in keys]
    last = batches.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("__r"))
    return last.select(*keys, *[F.col(f"__r.{c}").alias(c) for c in rest])


def reuse(built: DataFrame, wanted: DataFrame, settings: Sequence[str]) -> DataFrame:
    """(call, reuse): whether a built call's settings are all the wanted ones, nulls equal to nulls."""
    cond = F.lit(True)
    for s in settings:
        cond = cond & F.col(f"w.{s}").eqNullSafe(F.col(f"b.{s}"))
    joined = wanted.alias("w").join(built.withColumn("__have", F.lit(True)).alias("b"), "call", "left")
    return joined.select("call", (F.coalesce(F.col("__have"), F.lit(False)) & cond).alias("reuse"))


def settings_diff(recorded: DataFrame, requested: DataFrame, lenient: Sequence[str] = ("model",)) -> DataFrame:
    """(name, recorded, requested) where they differ; a lenient setting only if both sides know it."""
    both = recorded.select("name", F.col("value").alias("recorded")).join(requested.select("name", F.col("value").alias("requested")), "name", "full_outer")
    loose = F.col("name").isin(*lenient) & (F.col("recorded").isNull() | F.col("requested").isNull())
    return both.where(~F.col("recorded").eqNullSafe(F.col("requested")) & ~loose)


def pending(items: DataFrame, done: DataFrame, key: str, limit: int | None = None) -> DataFrame:
    """Items without an output, in order of their key; no limit for None or 0."""
    out = items.join(done.select(key), key, "left_anti")
    return out.orderBy(key).limit(limit) if limit else out


def stale(found: DataFrame, selected: DataFrame, kept: DataFrame, apart: Sequence[str] = ("chunks",)) -> DataFrame:
    """(split, call, variant, what) of stored mixtures that no longer belong; a null variant is the clean one.

    All of a call that the selection doesn't hold goes; of a selected call, the variants that aren't kept.
    The selection must be the whole one, not the calls of a limited run. Splits set apart aren't looked at.
    """
    have = found.where(~F.col("split").isin(*apart)) if apart else found
    gone = have.join(selected.select("call").distinct(), "call", "left_anti").withColumn("what", F.lit("call"))
    rest = have.where("variant is not null").join(selected.select("call").distinct(), "call", "left_semi")
    old = rest.join(kept.where("variant is not null").select("call", "variant").distinct(), ["call", "variant"], "left_anti")
    return gone.unionByName(old.withColumn("what", F.lit("variant"))).select("split", "call", "variant", "what")


def work_estimate(calls: DataFrame, realtime: float, full: bool = False) -> DataFrame:
    """(calls, seconds, wall): audio to enhance and the time it takes; speech of both sides, the duration where there is none, or all channels."""
    speech = F.aggregate(F.coalesce("speech", F.array()), F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0)))
    duration = F.coalesce("duration", F.lit(0.0))
    each = duration * F.col("channels") if full else F.when(speech > 0, speech).otherwise(duration)
    seconds = F.coalesce(F.sum(each), F.lit(0.0))
    return calls.agg(F.count("*").alias("calls"), seconds.alias("seconds"), F.round(seconds / realtime, 4).alias("wall"))


def rate_faults(calls: DataFrame, cached: DataFrame, wanted: int, source: int, marked: int | None, summed: bool = False) -> DataFrame:
    """(fault, n, example): why targets would end up at mixed rates, before any work; empty if they can't.

    ``cached`` has (call, rate) as found in the headers, ``marked`` is the rate the cache claims, ``summed`` that
    mixtures are sums of their targets. Targets at the source's own rate need no check here.
    """
    out = calls.select("call").join(cached.select("call", "rate"), "call", "left")
    if wanted == source:
        return out.where(F.lit(False)).select(F.lit("").alias("fault"), F.lit(0).cast("long").alias("n"), F.col("call").alias("example"))
    tests = {"not cached": F.col("rate").isNull(), "other rate": F.col("rate") != wanted, "marked otherwise": F.lit(marked != wanted), "sum of targets": F.lit(summed)}
    found = F.explode(F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in tests.items()])))
    return out.select("call", found.alias("fault")).groupBy("fault").agg(F.count("*").alias("n"), F.min("call").alias("example"))


def resolve_targets(calls: DataFrame, cached: DataFrame, policy: str) -> DataFrame:
    """``calls`` with ``enhanced``, whether a call's targets come from the cache of enhanced copies.

    'never' takes none, 'auto' those that are there; for 'always' a call without one raises when its row is read.
    """
    if policy not in ("never", "auto", "always"):
        raise ValueError(f"targets are taken never, auto or always, not {policy}")
    if policy == "never":
        return calls.withColumn("enhanced", F.lit(False))
    have = cached.select("call").distinct().withColumn("enhanced", F.lit(True))
    missing = F.raise_error(F.concat(F.lit("no enhanced copy of "), F.col("call").cast("string"))).cast("boolean") if policy == "always" else F.lit(False)
    return calls.join(have, "call", "left").withColumn("enhanced", F.coalesce("enhanced", missing))
