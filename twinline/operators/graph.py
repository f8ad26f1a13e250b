"""Connected components by shrinking labels, with pointer jumping."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.shared import materialize


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the least node that each node of ``edges`` can reach.

    Each round a node takes the least label among its own and its neighbours',
    and from the third round on the label of that label, so that long paths
    halve (stars are done before); it ends when no label changes. Each round is written to the shared folder; nothing is collected
    but one count. A node with very many edges costs one row per task (minima
    combine before the shuffle). Null ends are left out.
    """
    ends = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).alias("x"), F.col(b).alias("y"))
    both = materialize(ends.unionByName(ends.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "edges")
    labels = materialize(both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("c")), "labels")
    for turn in count():
        near = both.join(labels.select(F.col("x").alias("y"), "c"), "y").groupBy("x").agg(F.min("c").alias("m"))
        step = materialize(labels.join(near, "x").select("x", F.col("c").alias("was"), F.least("c", "m").alias("c")), "labels")
        if not step.where("c <> was").limit(1).count():
            return labels.select(F.col("x").alias("node"), F.col("c").alias("component"))
        labels = step.select("x", "c")
        if turn > 1:
            up = step.select(F.col("x").alias("c"), F.col("c").alias("up"))
            labels = materialize(step.join(up, "c").select("x", F.col("up").alias("c")), "labels")
