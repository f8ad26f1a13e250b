"""JSON lines, keyed JSON, split manifests and failure tables, by Spark's own committers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a JSON-lines folder; blank lines are skipped."""
    return spark.read.schema(schema).json(path)


def read_keyed_json(spark: SparkSession, path: str, value: str, key: str = "call") -> DataFrame:
    """A JSON object of key -> record as rows."""
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", f"map<string,{value}>").alias("m"))
    rows = whole.select(F.explode("m").alias(key, "__v"))
    return rows.select(key, "__v.*")


def write_splits(rows: DataFrame, path: str, splits: Sequence[str]) -> dict[str, int]:
    """Rows by split as JSON lines, counts returned; every configured split gets a folder, even without rows."""
    if "manifest" in splits or rows.where("split = 'manifest'").limit(1).count():
        raise ValueError("'manifest' is the combined table's name, not a split's")
    rows.repartition("split").write.partitionBy("split").mode("overwrite").json(path)
    counts = {r["split"]: r["count"] for r in rows.groupBy("split").count().collect()}
    for s in splits:
        if s not in counts:
            counts[s] = 0
            rows.limit(0).drop("split").write.mode("overwrite").json(f"{path}/split={s}")
    return counts


def write_failures(failures: DataFrame, path: str, stage: str) -> None:
    """(item, error) of one stage; replaces that stage's earlier rows."""
    failures.select("item", "error").coalesce(1).write.mode("overwrite").option("sep", "\t").csv(f"{path}/stage={stage}")
