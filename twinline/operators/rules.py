"""First-match rule cascades and the two the engine is built around."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import intervals


def first_match(rules: Sequence[tuple[Column, Column | str]], otherwise: str = "ok") -> Column:
    """The reason of the first rule that holds; null conditions don't hold."""
    start = F
    for test, reason in rules:
        start = start.when(F.coalesce(test, F.lit(False)), F.lit(reason) if isinstance(reason, str) else reason)
    return start.otherwise(F.lit(otherwise))


def label_facts(segments: DataFrame, energy: DataFrame, mode: str = "auto") -> DataFrame:
    """One row per (call, label): speech, channel it is assigned to, share of its energy there, in which mode.

    ``segments`` has (call, label, channel, start, end), ``energy`` (call, label,
    channel, energy). With more than one channel in a call's segments each label
    stays on its own; otherwise it goes where its energy is largest (lowest
    channel in a tie).
    """
    speech = intervals.total(segments, ["call", "label"])
    own = segments.groupBy("call", "label").agg(F.countDistinct("channel").alias("n_own"), F.min("channel").alias("own_channel"))
    modes = segments.groupBy("call").agg(F.countDistinct("channel").alias("n_seen"))
    chosen = F.when(F.col("n_seen") > 1, "channel").otherwise("energy") if mode == "auto" else F.lit(mode)
    total = F.sum("energy").over(Window.partitionBy("call", "label"))
    share = energy.withColumn("share", F.when(total > 0, F.col("energy") / total).otherwise(0.0))
    best = share.groupBy("call", "label").agg(
        F.max_by("channel", F.struct("share", -F.col("channel"))).alias("loud_channel"),
        F.map_from_entries(F.collect_list(F.struct("channel", "share"))).alias("shares"),
    )
    out = speech.join(own, ["call", "label"]).join(best, ["call", "label"], "left").join(modes.withColumn("mode", chosen), "call")
    out = out.withColumn("assigned", F.when(F.col("mode") == "channel", F.col("own_channel")).otherwise(F.col("loud_channel")))
    return out.withColumn("purity", F.coalesce(F.element_at("shares", F.col("assigned")), F.lit(0.0))).drop("shares", "loud_channel", "own_channel", "n_seen")


def suitability(
    facts: DataFrame, calls: DataFrame, expected: int = 2, min_speech: float = 3000, min_label_speech: float = 2000,
    min_label_share: float = 0.1, purity_energy: float = 0.9, purity_channel: float = 0.5,
) -> DataFrame:
    """(call, reason, detail): 'suitable', or the first of the reasons that holds, in their fixed priority.

    ``calls`` lists every recording: (call, n_channels), null channels for one
    without audio. A label beside the longest of its channel is a second person
    only if it speaks both long enough and for a large enough share.
    """
    per_channel = Window.partitionBy("call", "assigned").orderBy(F.desc("speech"), "label")
    ranked = facts.withColumn("rn", F.row_number().over(per_channel)).withColumn("main", F.first("speech").over(per_channel))
    share = F.when(F.col("main") > 0, F.col("speech") / F.col("main")).otherwise(1.0)
    person = (F.col("rn") > 1) & (F.col("speech") >= min_label_speech) & (share >= min_label_share)
    main = F.col("rn") == 1
    per = ranked.groupBy("call").agg(
        F.max((F.col("n_own") > 1) & (F.col("mode") == "channel")).alias("spans"),
        F.countDistinct("assigned").alias("n_assigned"),
        F.min("assigned").alias("lowest"),
        F.max("assigned").alias("highest"),
        F.max(person).alias("second"),
        F.min(F.when(main, F.col("purity"))).alias("purity"),
        F.min(F.when(main, F.col("speech"))).alias("least_speech"),
        F.first("mode").alias("mode"),
        F.count("*").alias("labels"),
    )
    floor = F.when(F.col("mode") == "energy", purity_energy).otherwise(purity_channel)
    reason = first_match(
        [
            (F.col("n_channels").isNull(), "no_audio"),
            (F.col("labels").isNull(), "empty_rttm"),
            (F.col("n_channels") != expected, "wrong_channel_count"),
            (F.col("spans"), "speaker_spans_channels"),
            ((F.col("lowest") < 1) | (F.col("highest") > F.col("n_channels")), "channel_out_of_range"),
            (F.col("n_assigned") != expected, F.concat(F.lit("n_channels="), F.col("n_assigned").cast("string"))),
            (F.col("second"), "two_speakers_one_channel"),
            (F.col("purity") < floor, "low_purity"),
            (F.col("least_speech") < min_speech, "channel_silent"),
        ],
        "suitable",
    )
    return calls.join(per, "call", "left").select("call", reason.alias("reason"), "mode", "labels", "purity", "least_speech")


def minor_spans(segments: DataFrame, facts: DataFrame) -> DataFrame:
    """(call, channel, start, end): merged time of labels beside the longest of their channel, to be cut from sources."""
    order = Window.partitionBy("call", "assigned").orderBy(F.desc("speech"), "label")
    minor = facts.withColumn("rn", F.row_number().over(order)).where("rn > 1").select("call", "label", F.col("assigned").alias("to"))
    spans = segments.join(minor, ["call", "label"]).select("call", F.col("to").alias("channel"), "start", "end")
    return intervals.merge(spans, ["call", "channel"])


def candidates(sides: DataFrame, min_speech: float, keys: int = 2) -> DataFrame:
    """One row per call with ``reason`` ('ok' or why it is dropped) from rows (call, pos, speaker, speech, source_speech).

    Priority: a side without speaker, one speaker on both sides, too little
    speech on the quieter side, a side whose own speech wasn't measured.
    """
    per = sides.groupBy("call").agg(
        F.count("*").alias("n"),
        F.count("speaker").alias("known"),
        F.countDistinct("speaker").alias("speakers"),
        F.min(F.coalesce(F.col("speech"), F.lit(0))).alias("quality"),
        F.count("source_speech").alias("measured"),
    )
    reason = first_match(
        [
            ((F.col("known") < F.col("n")) | (F.col("n") < keys), "no_speaker_id"),
            (F.col("speakers") < F.col("n"), "same_speaker_both_sides"),
            (F.col("quality") < min_speech, "too_little_speech"),
            (F.col("measured") < F.col("n"), "no_vad_rttm"),
        ]
    )
    return per.select("call", reason.alias("reason"), "quality")


def histogram(df: DataFrame, column: str) -> DataFrame:
    """(column, n, share in percent)."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()), 4))


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
