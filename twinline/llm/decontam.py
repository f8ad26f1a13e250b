"""Benchmark decontamination: prefix-filtered set join with exact verification.

A window is ``size`` consecutive words of a benchmark item (the whole of a
shorter one). Its tokens are its shingles of ``SHINGLE`` consecutive words (the
whole of a shorter window), ordered by rarity over all documents. For full
containment a prefix of one token is necessary and enough: a document that holds
the window holds its rarest shingle. The texts are split once, and only places of shingles
that the benchmark has are kept; rarity, candidates and verification all
come from that table. A place of a prefix gives a candidate start; starts
before the document or too near to its end (position and length bounds) go. A
candidate is verified if all shingles of the window stand where they should.

Documents and windows meet through shingles only, by joins of two plain sides
or with a table whose size was counted; items come in at the very end,
once for each different set of windows, so an instruction that all items share costs
one row for an item and not one for each document or place.

Defined results: A-Z are lower-cased, nothing else; null and texts without
words have no words, no hits and no windows; a null item_id counts as ''; items
that share an item_id are one; rows that share doc_id and text are one document
and get the same result each; an empty benchmark hits nothing; an empty table
gives an empty result; extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, id_key, materialize, text_of

SIZE, SHINGLE = 10, 3
#: Rows of shingles that are broadcast; about 60 bytes each.
BROADCAST_ROWS = 200_000
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(col: Column) -> Column:
    """Words of a text as an array."""
    return F.array_remove(F.split(ascii_lower(col), NOT_WORD, -1), "")


def bounded(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``limit`` rows, else as it is."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def shingles(w: Column, size: int) -> Column:
    """Array of the shingles of ``size`` words, in order; none of a shorter array."""
    rest = [lambda i, k=k: F.get(w, i + k) for k in range(1, size)]
    made = F.transform(w, lambda x, i: F.concat_ws(" ", x, *[r(i) for r in rest]))
    return F.slice(made, 1, F.greatest(F.size(w) - (size - 1), F.lit(0))) if size > 1 else w


def item_windows(benchmark: DataFrame, size: int = SIZE) -> tuple[DataFrame, DataFrame]:
    """(different windows (win, len, q), their items (win, item)); win is a digest of the words, q the words of a shingle."""
    w = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words(text_of()).alias("w")).where(F.size("w") > 0)
    cut = F.transform(F.sequence(F.lit(0), F.greatest(F.size("w") - size, F.lit(0))), lambda i: F.slice("w", i + 1, F.lit(size)))
    each = w.select("item", F.explode(cut).alias("words"))
    each = materialize(each.select(F.md5(F.array_join("words", " ")).alias("win"), "words", "item"), "windows")
    wins = each.groupBy("win").agg(F.first("words").alias("words")).withColumn("len", F.size("words"))
    return wins.withColumn("q", F.least("len", F.lit(SHINGLE))), each.select("win", "item").distinct()


def window_shingles(wins: DataFrame) -> DataFrame:
    """(win, len, off, shingle)."""
    by_size = F.array(*[F.when(F.col("q") == k, shingles(F.col("words"), k)) for k in range(1, SHINGLE + 1)])
    return wins.select("win", "len", F.posexplode(F.element_at(by_size, F.col("q"))).alias("off", "shingle"))


def places(docs: DataFrame, known: DataFrame, sizes: list[int], limit: int) -> DataFrame:
    """(d, h, n, pos, shingle): where documents of n words have shingles of the benchmark."""
    base = docs.select(id_key().alias("d"), F.xxhash64("text").alias("h"), F.explode(F.array(words(text_of()))).alias("w"))
    several = [base.select("d", "h", F.size("w").alias("n"), F.posexplode(shingles(F.col("w"), k)).alias("pos", "shingle")) for k in sizes]
    known = bounded(known, limit)
    out = None
    for each in several:
        found = each.join(known, "shingle", "left_semi")
        out = found if out is None else out.unionByName(found)
    return out.select("d", "h", "n", "pos", "shingle").distinct()  # repeated rows are one document


def occurrences(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, limit: int = BROADCAST_ROWS) -> tuple[DataFrame, DataFrame]:
    """((d, h, start, len, win) of every window in every document, items (win, item))."""
    wins, items = item_windows(benchmark, size)
    wins = materialize(window_shingles(wins), "shingles")
    sizes = sorted(r.q for r in wins.select(F.least("len", F.lit(SHINGLE)).alias("q")).distinct().collect())
    if not sizes:
        none = docs.sparkSession.createDataFrame([], "d long, h long, start int, len int, win string")
        return none, items
    hits = materialize(places(docs, wins.select("shingle").distinct(), sizes, limit), "places")
    counts = materialize(hits.groupBy("shingle").agg(F.count("*").alias("c")), "rarity")
    rated = wins.join(counts, "shingle", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    rarest = rated.groupBy("win", "len").agg(F.min(F.struct("c", "shingle", "off")).alias("m")).where("m.c > 0")
    prefix = materialize(rarest.select("win", "len", F.col("m.shingle").alias("shingle"), F.col("m.off").alias("off")), "prefixes")
    tries = hits.join(bounded(prefix, limit), "shingle").withColumn("start", F.col("pos") - F.col("off")).where("start >= 0 and start + len <= n")
    tries = materialize(tries.select("d", "h", "win", "len", "start"), "candidates")
    # every shingle of a candidate's window has to stand in its place
    wanted = tries.join(bounded(wins.select("win", "off", "shingle"), limit), "win").withColumn("pos", F.col("start") + F.col("off"))
    met = wanted.join(hits.select("d", "h", "pos", "shingle"), ["d", "h", "pos", "shingle"])
    met = met.groupBy("d", "h", "win", "len", "start").agg(F.count("*").alias("found"))
    return materialize(met.where(f"found = greatest(len - {SHINGLE} + 1, 1)").drop("found"), "occurrences"), items


def hit_words(found: DataFrame) -> DataFrame:
    """(d, h, n_hit): words inside occurrences; those of one document are gathered, at most one for each word and length."""
    starts = found.groupBy("d", "h").agg(F.collect_set(F.struct("start", "len")).alias("s"))
    inside = F.flatten(F.transform("s", lambda t: F.sequence(t["start"], t["start"] + t["len"] - 1)))
    return starts.select("d", "h", F.size(F.array_distinct(inside)).cast("long").alias("n_hit"))


def hit_items(found: DataFrame, items: DataFrame) -> DataFrame:
    """(d, h, items): sorted ids of the items with occurring windows, made once for each different set of windows."""
    sets = found.groupBy("d", "h").agg(F.array_sort(F.collect_set("win")).alias("wins"))
    sets = materialize(sets.withColumn("set", F.md5(F.array_join("wins", ""))), "sets")
    each = sets.groupBy("set").agg(F.first("wins").alias("wins")).select("set", F.explode("wins").alias("win")).join(items, "win")
    ids = materialize(each.select("set", "item").distinct().groupBy("set").agg(F.array_sort(F.collect_list("item")).alias("items")), "items")
    return sets.select("d", "h", "set").join(ids, "set").select("d", "h", "items")


def marked(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``docs`` plus struct __hit(n_words, n_hit, items)."""
    found, items = occurrences(docs, benchmark, size, limit)
    hit = materialize(hit_words(found).join(hit_items(found, items), ["d", "h"]), "hit")
    keyed = docs.withColumns({"__dk": id_key(), "__hk": F.xxhash64("text"), "__n": F.size(words(text_of())).cast("long")})
    hit = hit.select(F.col("d").alias("__d"), F.col("h").alias("__h"), F.col("n_hit").alias("__m"), F.col("items").alias("__items"))
    out = keyed.join(hit, (F.col("__dk") == F.col("__d")) & (F.col("__hk") == F.col("__h")), "left")
    none = F.array().cast("array<string>")
    result = F.struct(F.col("__n").alias("n_words"), F.coalesce("__m", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("__items", none).alias("items"))
    return out.withColumn("__hit", result).drop("__dk", "__hk", "__n", "__d", "__h", "__m", "__items")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """The rows of ``docs`` that hold no window of the benchmark."""
    found, _ = occurrences(docs, benchmark, size)
    bad = materialize(found.select("d", "h").distinct(), "contaminated").select(F.col("d").alias("__d"), F.col("h").alias("__h"))
    keyed = docs.withColumns({"__dk": id_key(), "__hk": F.xxhash64("text")})
    return keyed.join(bad, (F.col("__dk") == F.col("__d")) & (F.col("__hk") == F.col("__h")), "left_anti").drop("__dk", "__hk")


def op6_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found, items = occurrences(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))
    ids = hit_items(found, items).select("d", "h", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("sha"))
    hit = materialize(hit_words(found).join(ids, ["d", "h"]), "hit")
    # texts aren't shuffled: their size and key are made in the scan
    base = docs.select("doc_id", id_key().alias("d"), F.xxhash64("text").alias("h"), F.size(words(text_of())).cast("long").alias("n_words"))
    zero = F.lit(0).cast("long")
    return base.join(hit, ["d", "h"], "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", zero).alias("n_hit"),
        F.coalesce("n_items", zero).alias("n_items"),
        F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        (F.coalesce("n_hit", zero) > 0).alias("contaminated"),
    )


_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+')"
SQL = f"""
with b as (
  select coalesce(item_id::varchar, '') as item, {_WORDS} as w from benchmark
), i as (
  select item, w, unnest(generate_series(1, greatest(len(w) - {SIZE} + 1, 1))) as s from b where len(w) > 0
), wins as (
  select array_to_string(w[s:s + {SIZE} - 1], ' ') as win, least(len(w), {SIZE}) as n, item from i
), lens as (
  select distinct n from wins
), d as (
  select doc_id, {_WORDS} as w from documents
), p as (
  select doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) as s from d, lens where len(w) >= n
), h as (
  select p.doc_id, p.s, p.n, wins.item from p join wins on wins.n = p.n and wins.win = array_to_string(p.w[p.s:p.s + p.n - 1], ' ')
), m as (
  select doc_id, count(distinct k) as n_hit from (select doc_id, unnest(generate_series(s, s + n - 1)) as k from h) group by doc_id
), t as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct doc_id, item from h) group by doc_id
)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join m using (doc_id) left join t using (doc_id)
"""
