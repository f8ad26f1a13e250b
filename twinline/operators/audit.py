"""Audits: every check is a query that returns (check, key, message) rows for what it finds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .manifest import fold_calls


def violations(df: DataFrame, check: str, key, message) -> DataFrame:
    return df.select(F.lit(check).alias("check"), F.col(key).cast("string").alias("key") if isinstance(key, str) else key.cast("string").alias("key"), message.alias("message"))


def leaks(rows: DataFrame) -> DataFrame:
    """Speakers in more than one split."""
    x = rows.select("split", F.explode("speakers").alias("speaker")).groupBy("speaker").agg(F.countDistinct("split").alias("n"))
    return violations(x.where("n > 1"), "split_leak", "speaker", F.format_string("in %d splits", "n"))


def caps(rows: DataFrame, sides: DataFrame, max_calls: int | None, max_ms: int | None) -> DataFrame:
    """Speakers past the selection's caps, every call counted once whatever its variants."""
    calls = fold_calls(rows).select("call")
    per = sides.join(calls, "call", "left_semi").groupBy("speaker").agg(F.countDistinct("call").alias("calls"), F.sum("ms").alias("ms"))
    out = []
    if max_calls:
        out.append(violations(per.where(F.col("calls") > max_calls), "call_cap", "speaker", F.format_string("%d calls", "calls")))
    if max_ms:
        out.append(violations(per.where(F.col("ms") > max_ms), "duration_cap", "speaker", F.format_string("%d ms", "ms")))
    return reduce(DataFrame.unionByName, out) if out else violations(per.limit(0), "call_cap", "speaker", F.lit(""))


def partition_of(combined: DataFrame, parts: DataFrame, key: str) -> DataFrame:
    """Split manifests against the combined one: missing, surplus, repeated, in the wrong split."""
    n = parts.groupBy(key).agg(F.count("*").alias("n"), F.min("split").alias("at"))
    both = combined.select(key, "split").join(n, key, "full_outer")
    what = F.when(F.col("n").isNull(), "missing").when(F.col("split").isNull(), "surplus").when(F.col("n") > 1, "repeated").when(F.col("at") != F.col("split"), "wrong_split")
    return violations(both.withColumn("what", what).where(F.col("what").isNotNull()), "split_manifest", key, F.col("what"))


def orphans(found: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    """On disk and not listed, or listed and not on disk."""
    extra = violations(found.join(listed, key, "left_anti"), "orphan", key, F.lit("not listed"))
    return extra.unionByName(violations(listed.join(found, key, "left_anti"), "orphan", key, F.lit("not found")))


def variants_agree(rows: DataFrame, meta: DataFrame) -> DataFrame:
    """Variants in the manifest against those recorded, both ways."""
    on = (F.col("r.call") == F.col("m.call")) & (F.col("r.variant") == F.col("m.variant"))
    both = rows.alias("r").join(meta.alias("m"), on, "full_outer")
    call, v = F.coalesce("r.call", "m.call"), F.coalesce("r.variant", "m.variant")
    bad = both.where("r.call is null or m.call is null")
    return violations(bad, "variant", F.concat_ws(":", call, v), F.when(F.col("r.call").isNull(), "not in manifest").otherwise("not recorded"))


def chunk_splits(chunks: DataFrame, rows: DataFrame) -> DataFrame:
    """Chunks whose split isn't their call's."""
    calls = fold_calls(rows).select("call", F.col("split").alias("of"))
    bad = chunks.join(calls, "call", "left").where(~F.col("split").eqNullSafe(F.col("of")))
    return violations(bad, "chunk_split", F.concat_ws(":", "call", "w"), F.concat_ws(" ", "split", F.coalesce("of", F.lit("none"))))


def levels(recorded: DataFrame, measured: DataFrame, key: str) -> DataFrame:
    """Measured levels away from the recorded by more than a thousandth (1e-6 at least)."""
    both = recorded.select(key, F.col("rms").alias("want")).join(measured.select(key, F.col("rms").alias("got")), key, "left")
    off = F.col("got").isNull() | (F.abs(F.col("got") - F.col("want")) > F.greatest(F.lit(1e-6), F.lit(1e-3) * F.col("want")))
    return violations(both.where(off), "rms", key, F.when(F.col("got").isNull(), "missing").otherwise("level"))


def formats(rows: DataFrame, sr: int) -> DataFrame:
    """Rates and lengths of stored trios (call, sr, n, target_sr, n1, n2): the expected rate, a whole ratio, as many samples as the ratio says."""
    ratio = F.col("target_sr") / F.col("sr")
    longer = (F.col("n1") != F.col("n") * ratio) | (F.col("n2") != F.col("n") * ratio)
    unknown = F.greatest(*[F.col(c).isNull().cast("int") for c in ("sr", "n", "target_sr", "n1", "n2")]) > 0
    what = F.when(unknown, "unreadable").when(F.col("sr") != sr, "rate").when(F.col("target_sr") % F.col("sr") != 0, "ratio").when(longer, "duration")
    return violations(rows.withColumn("what", what).where("what is not null"), "format", "call", F.col("what"))


def floors(rows: DataFrame, check: str, key: str, value: str, least: float) -> DataFrame:
    """Measures below a floor, such as a background's distance or an alignment; those that couldn't be taken are left out."""
    return violations(rows.where(F.col(value) < least), check, key, F.format_string("%.2f", F.col(value)))


def drifts(recorded: DataFrame, measured: DataFrame, check: str, keys: list[str], value: str, tolerance: float) -> DataFrame:
    """Measures away from the recorded by more than the tolerance; those recorded only are for other checks."""
    both = recorded.select(*keys, F.col(value).alias("want")).join(measured.select(*keys, F.col(value).alias("got")), keys)
    return violations(both.where(F.abs(F.col("got") - F.col("want")) > tolerance), check, F.concat_ws(":", *keys), F.lit("other than recorded"))


def gender_share(rows: DataFrame, tolerance: float = 0.10) -> DataFrame:
    """One row if the share of male sides over calls is off a half by more than the tolerance."""
    s = fold_calls(rows).select(F.explode("genders").alias("g")).where("g in ('male', 'female')").agg(F.avg((F.col("g") == "male").cast("double")).alias("p"))
    return violations(s.where(F.abs(F.col("p") - 0.5) > tolerance), "gender", F.lit("all"), F.format_string("%.3f male", "p"))


def verdict(checks: list[DataFrame]) -> DataFrame:
    """All problems of all checks."""
    return reduce(DataFrame.unionByName, checks)
