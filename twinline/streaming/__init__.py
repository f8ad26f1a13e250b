"""Streaming forms of interval merging, window counts and resume (an extension beyond the batch operators)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_stream(segments: DataFrame, keys: Sequence[str], gap_ms: int, late: str) -> DataFrame:
    """Union of intervals of a stream with a ``ts`` timestamp and ``length_ms``, as sessions that close after the watermark."""
    length = F.concat((F.col("length_ms") + gap_ms).cast("string"), F.lit(" milliseconds"))
    w = segments.withWatermark("ts", late).groupBy(*keys, F.session_window("ts", length).alias("w"))
    end = F.max(F.unix_millis("ts") + F.col("length_ms"))
    return w.agg(F.min(F.unix_millis("ts")).alias("start"), end.alias("end")).drop("w")


def window_stream(segments: DataFrame, keys: Sequence[str], size: str, hop: str, late: str) -> DataFrame:
    """Segments and their total length in sliding windows."""
    w = segments.withWatermark("ts", late).groupBy(*keys, F.window("ts", size, hop).alias("w"))
    return w.agg(F.count("*").alias("n"), F.sum("length_ms").alias("ms")).select(*keys, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n", "ms")


def follow_folder(spark, path: str, schema: str, per_batch: int = 100) -> DataFrame:
    """New files of a folder, each once: the checkpoint replaces asking whether an output exists."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(path)
