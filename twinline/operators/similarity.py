"""Cosine similarity of all pairs, block against block, and what is said about it.

Vectors are dealt into blocks of a bounded size; a task multiplies two blocks
and keeps what is asked for: pairs above a threshold, or counts by class and
rounded similarity. The n x n matrix exists nowhere.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 4096


def _paired(vectors: DataFrame, block: int) -> DataFrame:
    n = max(1, -(-vectors.count() // block))
    dealt = vectors.withColumn("__b", F.pmod(F.xxhash64("key"), F.lit(n)).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = dealt.withColumn("__o", other).withColumns({"__lo": F.least("__b", "__o"), "__hi": F.greatest("__b", "__o")})
    return dealt.repartition("__lo", "__hi")


def _blocks(vectors: DataFrame, schema: str, keep, block: int) -> DataFrame:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        lo, hi = pdf["__lo"].iloc[0], pdf["__hi"].iloc[0]
        a, b = pdf[pdf["__b"] == lo], pdf[pdf["__b"] == hi]
        x, y = (np.array(p["vec"].tolist(), np.float64) for p in (a, b))
        sim = (x @ y.T + 1) / 2
        pair = a["key"].to_numpy()[:, None] < b["key"].to_numpy()[None, :]
        if lo != hi:
            pair = np.ones_like(pair)
        i, j = np.nonzero(pair)
        return keep(a, b, i, j, sim[i, j])

    return _paired(vectors, block).groupBy("__lo", "__hi").applyInPandas(run, schema)


def edges(vectors: DataFrame, threshold: float, block: int = BLOCK) -> DataFrame:
    """(a, b, sim) with a < b: pairs of different groups whose (cos + 1) / 2 is above the threshold, from (key, grp, vec)."""

    def keep(a, b, i, j, sim):
        ok = (sim > threshold) & (a["grp"].to_numpy()[i] != b["grp"].to_numpy()[j])
        x, y = a["key"].to_numpy()[i[ok]], b["key"].to_numpy()[j[ok]]
        return pd.DataFrame({"a": np.minimum(x, y), "b": np.maximum(x, y), "sim": sim[ok]})

    kind = dict(vectors.dtypes)["key"]
    return _blocks(vectors, f"a {kind}, b {kind}, sim double", keep, block)


def histogram(vectors: DataFrame, digits: int = 6, block: int = BLOCK) -> DataFrame:
    """(kind, sim, n): pairs by class and rounded similarity; a bounded number of rows, whatever the number of pairs."""

    def keep(a, b, i, j, sim):
        same = a["grp"].to_numpy()[i] == b["grp"].to_numpy()[j]
        channel = a["channel"].to_numpy()[i] == b["channel"].to_numpy()[j]
        kind = np.where(same, 0, np.where(channel, 1, 2))
        # half up, as SQL rounds; sims lie between 0 and 1
        at = np.floor(sim * 10**digits + 0.5).astype(np.int64)
        got = pd.DataFrame({"kind": kind, "at": at}).groupby(["kind", "at"]).size().reset_index(name="n")
        return got

    counts = _blocks(vectors, "kind long, at long, n long", keep, block)
    names = F.element_at(F.array(F.lit("same_call"), F.lit("cross_call_same_channel"), F.lit("cross_call_diff_channel")), F.col("kind").cast("int") + 1)
    return counts.groupBy("kind", "at").agg(F.sum("n").alias("n")).select(names.alias("kind"), (F.col("at") / 10**digits).alias("sim"), "n")


def diagnostics(hist: DataFrame, threshold: float) -> DataFrame:
    """n, mean, p95, p99, max and share above the threshold for each class of pairs."""
    n, sim = F.col("n"), F.col("sim")
    q = lambda p: F.round(F.percentile(sim, F.lit(p), n), 5)
    return hist.groupBy("kind").agg(
        F.sum(n).alias("n"),
        F.round(F.sum(sim * n) / F.sum(n), 5).alias("mean"),
        q(0.95).alias("p95"),
        q(0.99).alias("p99"),
        F.round(F.max(sim), 5).alias("max"),
        F.round(100.0 * F.sum(F.when(sim > threshold, n).otherwise(0)) / F.sum(n), 4).alias("above_pct"),
    )


def threshold_sweep(hist: DataFrame, cuts=(0.76, 0.78, 0.80, 0.82, 0.85, 0.88)) -> DataFrame:
    """(cut, pct): share of same-call pairs above each cut."""
    same = hist.where("kind = 'same_call'").withColumn("cut", F.explode(F.array(*[F.lit(c) for c in cuts])))
    return same.groupBy("cut").agg(F.round(100.0 * F.sum(F.when(F.col("sim") > F.col("cut"), F.col("n")).otherwise(0)) / F.sum("n"), 4).alias("pct"))
