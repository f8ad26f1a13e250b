"""Domain tables derived from the driver's star schema, in Spark and as SQL text for the oracle.

segments    events: call = user_id, label = event_type, milliseconds since 2024
sides       embeddings: call = vec_id div 2, channel = vec_id % 2
call graph  lineitem with orders: speakers s<suppkey> and c<custkey>
turns       conversations
manifest    documents with labels and an md5 split
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPLITS = {"train": 0.9, "dev": 0.05, "test": 0.05}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def md5_uniform(text: Column) -> Column:
    """A uniform number from the first eight hex digits of md5, the same in any engine."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(call, label, channel, start, end) in whole milliseconds."""
    start = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'2024-01-01 00:00:00', ts) div 1000")
    channel = F.when(F.col("event_type").isin("click", "view"), 1).otherwise(2).cast("long")
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("call"), F.col("event_type").alias("label"), channel.alias("channel"), start.alias("start"), "value")
    return e.withColumn("end", F.col("start") + F.floor(F.col("value") * 600000).cast("long") + 1).drop("value")


SEG = """seg as (
  select user_id as call, event_type as label, case when event_type in ('click', 'view') then 1 else 2 end::bigint as channel,
    (epoch_us(ts) - epoch_us(timestamp '2024-01-01')) // 1000 as s,
    (epoch_us(ts) - epoch_us(timestamp '2024-01-01')) // 1000 + floor(value * 600000)::bigint + 1 as e
  from events
)"""


def islands(name: str, source: str, keys: str, gap: int = 0) -> str:
    """SQL text of a CTE with the union of intervals (s, e) of ``source`` by keys."""
    return f"""{name}_m as (
  select *, max(e) over (partition by {keys} order by s, e rows between unbounded preceding and 1 preceding) as pm from {source}
), {name}_g as (
  select *, sum(case when pm is null or s - pm > {gap} then 1 else 0 end) over (partition by {keys} order by s, e rows unbounded preceding) as g from {name}_m
), {name} as (
  select {keys}, min(s) as s, max(e) as e from {name}_g group by {keys}, g
)"""


def cells(name: str, a: str, b: str, keys: str) -> str:
    """SQL text of a CTE of elementary cells (s, e) with in_a, in_b found by EXISTS: no logic shared with the sweep."""
    on = lambda t: " and ".join(f"{t}.{k} = c.{k}" for k in keys.split(", "))
    return f"""{name}_t as (
  select {keys}, s as t from {a} union select {keys}, e from {a} union select {keys}, s from {b} union select {keys}, e from {b}
), {name}_c as (
  select {keys}, t as s, lead(t) over (partition by {keys} order by t) as e from {name}_t
), {name} as (
  select c.*, exists (select 1 from {a} x where {on('x')} and x.s <= c.s and x.e >= c.e) as in_a,
    exists (select 1 from {b} y where {on('y')} and y.s <= c.s and y.e >= c.e) as in_b
  from {name}_c c where c.e is not null
)"""


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, grp, channel, vec, label)."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").alias("key"), F.expr("vec_id div 2").alias("grp"), (F.col("vec_id") % 2).alias("channel"), F.col("embedding").alias("vec"), F.col("label").cast("long").alias("label")
    )


VEC = "vec as (select vec_id as key, vec_id // 2 as grp, vec_id % 2 as channel, embedding::double[] as v, label::bigint as label from embeddings)"


def call_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(call, pos, speaker, ms, quality): two sides of each lineitem row."""
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    both = line.join(orders, line["l_orderkey"] == orders["o_orderkey"])
    call = (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("call")
    speakers = F.array(F.concat(F.lit("s"), "l_suppkey"), F.concat(F.lit("c"), "o_custkey"))
    return both.select(call, F.posexplode(speakers).alias("pos", "speaker"), (F.col("l_quantity") * 1000).cast("long").alias("ms"), F.col("l_quantity").alias("quality"))


SIDES = """sides as (
  select l_orderkey * 8 + l_linenumber as call, 0 as pos, 's' || l_suppkey as speaker, (l_quantity * 1000)::bigint as ms, l_quantity as quality
  from lineitem join orders on l_orderkey = o_orderkey
  union all
  select l_orderkey * 8 + l_linenumber, 1, 'c' || o_custkey, (l_quantity * 1000)::bigint, l_quantity from lineitem join orders on l_orderkey = o_orderkey
)"""


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(call, variant, split, duration, speakers, genders): a clean row of each document, and variants of those with an even id."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars")
    u = md5_uniform(F.concat(F.lit("split:"), F.col("doc_id").cast("string")))
    split = F.when(u < 0.9, "train").when(u < 0.95, "dev").otherwise("test")
    speakers = F.array("source", F.concat(F.lit("v"), (F.col("doc_id") % 97).cast("string")))
    genders = F.array(F.when(F.col("lang") == "en", "male").otherwise("female"), F.when(F.col("doc_id") % 3 == 0, "female").otherwise("male"))
    variants = F.when(F.col("doc_id") % 2 == 0, F.array(F.lit(None).cast("int"), F.lit(0), F.lit(1))).otherwise(F.array(F.lit(None).cast("int")))
    out = d.select(F.col("doc_id").alias("call"), split.alias("split"), (F.col("n_chars") / 16.0).alias("duration"), speakers.alias("speakers"), genders.alias("genders"), variants.alias("v"))
    return out.select("call", F.explode("v").alias("variant"), "split", "duration", "speakers", "genders")


MANIFEST = """base as (
  select doc_id as call, ('0x' || substr(md5('split:' || doc_id), 1, 8))::bigint::double / 4294967296.0 as u, n_chars / 16.0::double as duration,
    [source, 'v' || (doc_id % 97)] as speakers,
    [case when lang = 'en' then 'male' else 'female' end, case when doc_id % 3 = 0 then 'female' else 'male' end] as genders
  from documents
), man as (
  select call, v.variant, case when u < 0.9 then 'train' when u < 0.95 then 'dev' else 'test' end as split, duration, speakers, genders
  from base, (values (null::int), (0), (1)) v(variant) where v.variant is null or call % 2 = 0
)"""
