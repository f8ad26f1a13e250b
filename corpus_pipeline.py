"""A corpus pipeline of five stages over the ``documents`` table.

Each stage works on all that its predecessor kept and returns the columns of
documents; the last emits the mixed corpus, a row for every copy taken. Stages
are written as Parquet in the shared folder and read again, so a lost executor
costs tasks of one stage; what a stage wrote on its way is deleted when its result is stored.

Defined results: a null text counts as an empty one and stays null; repeated rows
are one document from the third stage on; a null doc_id sorts first, a null source is
one of its own; extra columns pass through all stages; without labels nothing is rejected,
without a benchmark nothing is contaminated; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from twinline.llm import decontam, lines, mixing, neardup, toxicity
from twinline.llm.common import clear, mark, materialize


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the chain, fitted on labelled rows among them, rejects."""
    return toxicity.remove_toxic(docs, toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes later repeated runs of lines."""
    return lines.dedup_lines(docs)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first document of each class of near duplicates."""
    return neardup.keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item."""
    return decontam.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Emits each document as often as its source's rate says."""
    return mixing.mix_sources(docs)


STAGES = [("toxicity", remove_toxic), ("lines", dedup_lines), ("near_duplicates", dedup_near), ("decontaminate", decontaminate), ("mix", mix)]

#: The first and third stage are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        since = mark()
        docs = materialize(stage(spark, docs, sf_dir), name)
        clear(spark, since, keep=docs)
    return docs
