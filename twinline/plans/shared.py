"""Tables written once to the cluster's shared folder.

A written table cuts lineage, survives lost executors, and has a size that
Catalyst knows, so the choice between broadcast and shuffle joins stays its own.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, the folder that the driver and all executors share; in local mode Spark's own scratch folder will do."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir names no folder; a cluster's executors share none without it")
        folder = f"file://{spark.conf.get('spark.local.dir', '/tmp').split(',')[0]}/twinline-{spark.sparkContext.applicationId}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


#: Removes a query's shuffle files when the query ends, so they don't pile up from table to table.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Tables that this process has written, for ``clear``.
_WRITTEN: list[str] = []


def _delete(spark: SparkSession, name: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))


def clear(spark: SparkSession, since: int = 0, keep: DataFrame | None = None) -> int:
    """Deletes the tables written so far (those after the first ``since``, but for ``keep``); for when all results that read them are stored."""
    kept = None if keep is None else keep.written_to
    gone = [x for x in _WRITTEN[since:] if x != kept]
    _WRITTEN[since:] = [x for x in _WRITTEN[since:] if x == kept]
    return sum(_delete(spark, x) for x in gone)


def discard(*tables: DataFrame) -> None:
    """Deletes tables that ``materialize`` made and nothing reads any more."""
    for t in tables:
        _WRITTEN.remove(t.written_to)
        _delete(t.sparkSession, t.written_to)


def mark() -> int:
    """How many tables are written now, for ``clear``."""
    return len(_WRITTEN)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` once to the shared folder and reads it back."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/twinline-{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out
