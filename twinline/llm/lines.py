"""Line dedup by winnowing over line hashes.

A run of lines weighs what its lines weigh: a blank line nothing, any other its
words, ``FLOOR`` at least. A repeated run of weight ``LEAST`` or more is a
repeat: one line of eight words, or two short ones; blank lines alone never are.

A window is the shortest run of that weight from a line on, or up to a line. Its
fingerprint is its line with the least hash (the rightmost of equals): a repeated run
holds a whole window, and equal windows choose the same line, so a repeat always
shares a fingerprint. Windows whose fingerprint stands once in the corpus are done. The others meet
at their fingerprints: a window that equals an earlier one (smaller doc_id, or same
document, earlier line) is a match, joined with the place of the first. A match is
extended line by line both ways as far as the two documents agree, and the whole run of
the later place is deleted. So every non-blank line of a repeat goes; blank lines at
its rims go where the first copy of the window next to them has them too.

All joins are on keys of many values and follow a table written to the shared
folder, so the optimizer sees sizes and can split a hot key; texts are read once for hashes
and once for the result; nothing gathers a group but the matches of one document.

Defined results: null text is one empty line and stays null; an empty text is
one empty line; a null doc_id sorts first; rows that share doc_id and text are
one document; a document of less weight than a window keeps all; one of whose
lines nothing is left gets an empty text; an empty table gives an empty result;
extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_key, materialize, n_words, text_of

#: Weight of a run that counts as a repeat, and of a line that isn't blank, in words.
LEAST, FLOOR = 8, 4


def _lines() -> Column:
    return F.split(text_of(), "\n", -1)


def _hashes(seed: int) -> Column:
    return F.transform("lines", lambda x: F.xxhash64(F.lit(seed), x))


def hashed(docs: DataFrame, floor: int = FLOOR) -> DataFrame:
    """(d, h, a, b, w): two hashes and the weight of every line of each document."""
    base = docs.select(id_key().alias("d"), F.xxhash64("text").alias("h"), _lines().alias("lines"))
    weight = lambda x: F.when(n_words(x) > 0, F.greatest(n_words(x), F.lit(floor))).otherwise(0).cast("int")
    first, second = (_hashes(k) for k in (1, 2))
    return base.select("d", "h", first.alias("a"), second.alias("b"), F.transform("lines", weight).alias("w")).dropDuplicates(["d", "h"])


def windows(lines: DataFrame, least: int = LEAST, floor: int = FLOOR) -> DataFrame:
    """(f, w1, w2, d, h, s, e): fingerprint, key, document, first and last line of every window."""
    at = F.filter(F.transform("w", lambda w, i: F.when(w > 0, i)), lambda i: i.isNotNull())
    full = lines.select("d", "h", "a", "b", "w", at.alias("at"))  # places of the lines that aren't blank
    most = -(-least // max(1, floor))  # lines of a window that aren't blank

    def edge(k: Column, step: int) -> Column:
        """The line at which the weight from the k-th line on reaches ``least``, going forward (1) or back (-1)."""
        total, out = F.lit(0), []
        for j in range(most):
            place = F.get("at", k + step * j)
            total = total + F.get("w", place)
            out.append(F.when(total >= least, place))
        return F.coalesce(*out)

    def both(s: Column, k: Column) -> Column:
        return F.array(F.struct(s.alias("s"), edge(k, 1).alias("e")), F.struct(edge(k, -1).alias("s"), s.alias("e")))

    each = F.array_distinct(F.filter(F.flatten(F.transform("at", both)), lambda x: x["s"].isNotNull() & x["e"].isNotNull()))

    def keyed(x: Column) -> Column:
        a, b = (F.slice(c, x["s"] + 1, x["e"] - x["s"] + 1) for c in ("a", "b"))
        return F.struct(F.array_min(a).alias("f"), F.xxhash64(a).alias("w1"), F.xxhash64(b).alias("w2"), x["s"].alias("s"), x["e"].alias("e"))

    made = full.select("d", "h", "a", "b", each.alias("each")).select("d", "h", F.explode(F.transform("each", keyed)).alias("x"))
    return made.select("x.f", "x.w1", "x.w2", "d", "h", "x.s", "x.e")


def matches(lines: DataFrame, least: int = LEAST, floor: int = FLOOR) -> DataFrame:
    """(d, h, fd, fh, by, starts): windows of a document that the document f has first, ``by`` lines earlier."""
    found = materialize(windows(lines, least, floor), "windows")
    # a fingerprint's places, not its windows: lines that several windows of a document choose count once
    shared = found.groupBy("f").agg(F.min(F.struct("d", "h", "s")).alias("lo"), F.max(F.struct("d", "h", "s")).alias("hi")).where("lo <> hi").select("f")
    met = found.join(materialize(shared, "fingerprints"), "f", "left_semi")
    place = F.struct("d", "h", "s")
    first = met.groupBy("f", "w1", "w2").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    later = found.join(materialize(first, "first"), ["f", "w1", "w2"]).where(place > F.col("first"))
    later = later.select("d", "h", F.col("first.d").alias("fd"), F.col("first.h").alias("fh"), (F.col("s") - F.col("first.s")).alias("by"), "s")
    return later.groupBy("d", "h", "fd", "fh", "by").agg(F.collect_set("s").alias("starts"))


def extended(found: DataFrame, lines: DataFrame) -> DataFrame:
    """(d, h, runs): first and last line of every match, extended both ways as far as the documents agree."""
    own = lines.select("d", "h", "a")
    other = lines.select(F.col("d").alias("fd"), F.col("h").alias("fh"), F.col("a").alias("fa"))
    both = found.join(own, ["d", "h"]).join(other, ["fd", "fh"])
    lo = F.greatest(F.lit(0), F.col("by"))
    hi = F.least(F.size("a"), F.size("fa") + F.col("by")) - 1
    differ = F.filter(F.sequence(lo, hi), lambda i: F.get("a", i) != F.get("fa", i - F.col("by")))
    both = both.withColumn("differ", F.concat(F.array(lo - 1), differ, F.array(hi + 1)))

    def run(s: Column) -> Column:
        start = F.array_max(F.filter("differ", lambda i: i < s)) + 1
        return F.struct(start.alias("s"), (F.array_min(F.filter("differ", lambda i: i > s)) - 1).alias("e"))

    runs = both.select("d", "h", F.array_distinct(F.transform("starts", run)).alias("runs"))
    return runs.groupBy("d", "h").agg(F.flatten(F.collect_list("runs")).alias("runs"))


def marked(docs: DataFrame, least: int = LEAST, floor: int = FLOOR) -> DataFrame:
    """``docs`` plus struct __lines(all, removed): the lines, and the indexes of those deleted."""
    lines = materialize(hashed(docs, floor), "hashed")
    gone = materialize(extended(materialize(matches(lines, least, floor), "matches"), lines), "runs")
    gone = gone.select(F.col("d").alias("__d"), F.col("h").alias("__h"), F.col("runs").alias("__runs"))
    keyed = docs.withColumn("__dk", id_key()).withColumn("__hk", F.xxhash64("text"))
    out = keyed.join(gone, (F.col("__dk") == F.col("__d")) & (F.col("__hk") == F.col("__h")), "left")
    removed = F.array_distinct(F.flatten(F.transform("__runs", lambda r: F.sequence(r["s"], r["e"]))))
    none = F.array().cast("array<int>")
    out = out.withColumn("__lines", F.struct(_lines().alias("all"), F.coalesce(removed, none).alias("removed")))
    return out.drop("__dk", "__hk", "__d", "__h", "__runs")


def kept_text() -> Column:
    lines = F.col("__lines")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines["all"]) - 1), lines["removed"])
    text = F.array_join(F.transform(kept, lambda i: F.element_at(lines["all"], i + 1)), "\n")
    return F.when(F.size(lines["removed"]) > 0, text).otherwise(F.col("text"))


def dedup_lines(docs: DataFrame, least: int = LEAST, floor: int = FLOOR) -> DataFrame:
    """``docs`` with later repeated runs of lines deleted; n_chars, where there is one, follows the text."""
    out = marked(docs, least, floor).withColumn("text", kept_text())
    if "n_chars" in docs.columns:
        n = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.size("__lines.removed") > 0, n).otherwise(F.col("n_chars")))
    return out.drop("__lines")


def op2_lines(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    n = F.size("__lines.all").cast("long")
    return marked(docs).select("doc_id", n.alias("n_lines"), F.size("__lines.removed").cast("long").alias("n_removed"), kept_text().alias("text"))


#: LEAST is twice FLOOR at most here, so a window has one or two lines that aren't blank.
SQL = f"""
with d as (
  select doc_id, string_split(coalesce(text, ''), chr(10)) as lines, text from documents
), l as (
  select doc_id, unnest(generate_series(1, len(lines))) as i, unnest(lines) as line from d
), n as (
  select doc_id, i, greatest(len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')), {FLOOR}) as w from l where regexp_matches(line, '[^\\x20\\x09-\\x0D]')
), o as (
  select doc_id, i, w, lead(i) over p as after, lag(i) over p as before from n window p as (partition by doc_id order by i)
), v as (
  select doc_id, i as s, case when w >= {LEAST} then i else after end as e from o
  union select doc_id, case when w >= {LEAST} then i else before end as s, i as e from o
), k as (
  select doc_id, s, array_to_string(lines[s:e], chr(10)) as key from v join d using (doc_id) where s is not null and e is not null
), f as (
  select doc_id, s, first_value(doc_id) over q as fd, s - first_value(s) over q as back, row_number() over q as rn
  from k window q as (partition by key order by doc_id, s)
), m as (
  select distinct doc_id, fd, back, s from f where rn > 1
), eq as (
  select m.doc_id, m.fd, m.back, x.i from (select distinct doc_id, fd, back from m) m
  join l x on x.doc_id = m.doc_id join l y on y.doc_id = m.fd and y.i = x.i - m.back where x.line = y.line
), g as (
  select *, i - row_number() over (partition by doc_id, fd, back order by i) as run from eq
), c as (
  select distinct g.doc_id, g.fd, g.back, g.run from g join m on m.doc_id = g.doc_id and m.fd = g.fd and m.back = g.back and m.s = g.i
), z as (
  select doc_id, list(distinct i) as gone from g join c using (doc_id, fd, back, run) group by doc_id
)
select doc_id, len(lines)::bigint as n_lines, coalesce(len(gone), 0)::bigint as n_removed,
  case when gone is null then text
    else coalesce(array_to_string([lines[i] for i in generate_series(1, len(lines)) if not list_contains(gone, i)], chr(10)), '') end as text
from d left join z using (doc_id)
"""
