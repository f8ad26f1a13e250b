"""RTTM segments: read, parse, write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def stem(path: Column) -> Column:
    """File name without its last extension."""
    return F.regexp_extract(path, r"([^/]+?)(\.[^./]+)?$", 1)


def parse(lines: DataFrame, line: str = "value") -> DataFrame:
    """(call, channel, start, end, label) of SPEAKER lines; others and blank ones are dropped."""
    f = F.split(F.trim(line), r"\s+")
    rows = lines.withColumn("f", f).where((F.size("f") >= 8) & (F.col("f")[0] == "SPEAKER"))
    start, length = F.col("f")[3].cast("double"), F.col("f")[4].cast("double")
    keep = [c for c in lines.columns if c != line]
    return rows.select(*keep, F.col("f")[1].alias("call"), F.col("f")[2].cast("int").alias("channel"), start.alias("start"), F.round(start + length, 3).alias("end"), F.col("f")[7].alias("label"))


def format_line(call="call", channel="channel", start="start", end="end", label="label") -> Column:
    """The line of a segment, times in seconds with three decimals."""
    three = lambda c: c.cast("decimal(18,3)").cast("string")
    return F.concat_ws(
        " ", F.lit("SPEAKER"), F.col(call).cast("string"), F.col(channel).cast("string"), three(F.col(start)), three(F.col(end) - F.col(start)), F.lit("<NA> <NA>"), F.col(label), F.lit("<NA> <NA>")
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """Segments of every .rttm file under a folder; the key is the file's name."""
    text = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.rttm").text(path)
    return parse(text.withColumn("path", F.col("_metadata.file_path"))).withColumn("call", stem(F.col("path"))).drop("path")


def write(segments: DataFrame, path: str) -> None:
    """One folder per call with its lines in order of start and channel."""
    rows = segments.select("call", "start", "channel", format_line().alias("value"))
    rows.repartition("call").sortWithinPartitions("call", "start", "channel").select(F.col("call").alias("part"), "value").write.partitionBy("part").mode("overwrite").text(path)
