"""Banks of rooms and noise that degraded variants draw from: which are missing, which are fit, who needs what."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def missing_rooms(spark: SparkSession, count: int, have: DataFrame | None = None) -> DataFrame:
    """(index, name) of the simulated rooms up to ``count`` that aren't there; a room's index alone decides what it is."""
    every = spark.range(count).select(F.col("id").alias("index"), F.format_string("rir%05d", "id").alias("name"))
    return every if have is None else every.join(have.select("name"), "name", "left_anti").select("index", "name")


def seeded_sample(clips: DataFrame, key: str, seed: int, limit: int | None) -> DataFrame:
    """``limit`` clips in the order of a seeded digest of their key; all for None or 0."""
    return clips.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), key).limit(limit) if limit else clips


def quiet(clips: DataFrame, most: float) -> DataFrame:
    """Clips (seconds, speech) of some length in which speech takes at most the share ``most``."""
    return clips.where((F.col("seconds") > 0) & (F.col("speech") / F.col("seconds") <= most))


def attach(calls: DataFrame, needs: DataFrame, bank: DataFrame) -> DataFrame:
    """``calls`` with ``recordings``, the (kind, name, pcm) that each one's rows (call, kind, name) in ``needs`` ask for.

    A recording goes to the calls that drew it by a join on its name, so no worker holds a whole bank.
    """
    drawn = needs.join(bank.select("kind", "name", "pcm"), ["kind", "name"])
    per = drawn.groupBy("call").agg(F.collect_list(F.struct("kind", "name", "pcm")).alias("recordings"))
    return calls.join(per, "call", "left")


def names_by_kind(bank: DataFrame, bound: int = 1_000_000) -> dict[str, list[str]]:
    """All names, sorted, for drawing from; a bank of more than ``bound`` recordings is refused."""
    rows = bank.select("kind", "name").orderBy("kind", "name").limit(bound + 1).collect()
    if len(rows) > bound:
        raise ValueError(f"a bank of more than {bound} recordings")
    out: dict[str, list[str]] = {}
    for r in rows:
        out.setdefault(r.kind, []).append(r.name)
    return out


def usable_kinds(wanted: Sequence[str], available: Sequence[str]) -> tuple[list[str], list[str]]:
    """(usable, missing) of the wanted codecs, in their order."""
    return [k for k in wanted if k in available], sorted(set(wanted) - set(available))
