"""Mixing sources to target weights by whole repetitions and one seeded coin.

Tokens are summed per source, a source's rate is target / size, and each
document comes floor(rate) times plus once more with the remaining fraction as
probability. The coin is a hash of seed and document id, so reruns, other
partitionings and lost executors change nothing.

Defined results: a null text has size 0; a null source is a source of its own,
last in order; rows that share a doc_id share their coin; a source without
words has rate 0 (its documents are not taken); an empty table gives an empty
result; extra columns pass through, and the number of a copy is named ``copy``, or
``copy_`` (and so on) beside a column of that name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, n_words

#: A table of rates is broadcast only up to this many sources.
BROADCAST_SOURCES = 100_000
SALTS = 64
WEIGHTS = (5, 2, 1)


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = 3) -> DataFrame:
    """(source, source_size, target, rate) from rows (source, size).

    Targets share the total by weight, none above ``cap`` times its source's
    size. Sources fill up in order of cap * size / weight; the level of the
    first that is not full is everyone's words per unit of weight. The windows
    run over one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.pmod(F.col("rn") - 1, F.lit(len(weights))) + 1)
    per = per.withColumn("rn", F.row_number().over(order)).withColumn("weight", weight.cast("long"))
    everything = Window.partitionBy()
    fill = Window.orderBy("fill_at", "rn")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("fill_at", F.col("source_size") * cap / F.col("weight"))
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum(F.col("source_size") * cap).over(before), F.lit(0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    per = per.withColumn("level", left.cast("double") / open_weight.cast("double")).withColumn("pos", F.row_number().over(fill))
    per = per.withColumn("full", F.col("fill_at") <= F.col("level"))
    first_open = F.min(F.when(~F.col("full"), F.struct("pos", "level"))).over(everything)
    target = F.when(F.col("full"), (F.col("source_size") * cap).cast("double")).otherwise(F.col("weight") * first_open["level"])
    per = per.withColumn("target", target)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return per.select("source", "source_size", "target", rate.alias("rate"))


def with_copies(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = 3, seed: str = "mix-1", broadcast_sources: int = BROADCAST_SOURCES
) -> DataFrame:
    """``docs`` plus struct __mix(size, source_size, target, copies)."""
    sized = docs.withColumn("__size", n_words(F.col("text")))
    targets = materialize(source_targets(sized.select("source", F.col("__size").alias("size")), weights, cap), "targets")
    rates = targets.select(F.col("source").alias("__source"), F.struct("source_size", "target", "rate").alias("__rate"))
    match = F.col("source").eqNullSafe(F.col("__source"))
    if rates.limit(broadcast_sources + 1).count() <= broadcast_sources:
        joined = sized.join(F.broadcast(rates), match, "left")
    else:  # one source may hold a third of all rows: deal each over SALTS tasks
        rates = rates.withColumn("__at", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        sized = sized.withColumn("__salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
        joined = sized.join(rates, match & (F.col("__salt") == F.col("__at")), "left").drop("__salt", "__at")
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    coin = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))
    rate = F.col("__rate.rate")
    copies = (F.floor(rate) + F.when(coin < rate - F.floor(rate), 1).otherwise(0)).cast("long")
    mix = F.struct(F.col("__size").alias("size"), F.col("__rate.source_size"), F.col("__rate.target"), copies.alias("copies"))
    return joined.withColumn("__mix", mix).drop("__size", "__source", "__rate")


def mix_sources(docs: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = 3, seed: str = "mix-1") -> DataFrame:
    """The mixed corpus: every row as often as it is taken, with its ``copy`` number."""
    name = "copy"
    while name in docs.columns:
        name += "_"
    taken = with_copies(docs, weights, cap, seed).where(F.col("__mix.copies") > 0)
    return taken.withColumn(name, F.explode(F.sequence(F.lit(1), F.col("__mix.copies").cast("int")))).drop("__mix")


def op4_mix(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    m = F.col("__mix")
    return with_copies(docs).select(
        "doc_id", m["size"].alias("size"), m["source_size"].alias("source_size"), m["target"].alias("target"), (m["size"] * m["copies"]).alias("taken")
    )


SQL = """
with d as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as size from documents
), s as (
  select source, sum(size)::bigint as source_size from d group by source
), n as (
  select *, row_number() over (order by source asc nulls last) as rn from s
), w as (
  select *, case (rn - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as weight from n
), f as (
  select *, (source_size * 3)::double / weight::double as fill_at, sum(source_size) over () as total, sum(weight) over () as weights from w
), l as (
  select *, row_number() over o as pos,
    (total - coalesce(sum(source_size * 3) over (o rows between unbounded preceding and 1 preceding), 0))::double
    / (weights - coalesce(sum(weight) over (o rows between unbounded preceding and 1 preceding), 0))::double as level
  from f window o as (order by fill_at, rn)
), lam as (
  select level from l where fill_at > level order by pos limit 1
), t as (
  select source, source_size, case when fill_at <= level then (source_size * 3)::double else weight * (select level from lam) end as target from l
), r as (
  select d.doc_id, d.size, t.source_size, t.target, case when t.source_size > 0 then t.target / t.source_size else 0.0 end as rate,
    ('0x' || substr(md5('mix-1:' || coalesce(d.doc_id::varchar, 'null')), 1, 13))::bigint::double / 4503599627370496.0 as coin
  from d join t on d.source is not distinct from t.source
)
select doc_id, size, source_size, target,
  (size * (floor(rate)::bigint + case when coin < rate - floor(rate) then 1 else 0 end))::bigint as taken
from r
"""
