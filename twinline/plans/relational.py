"""Queries over intervals, rules, votes, similarity, selection: (Spark, oracle SQL) by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import clustering, graph, intervals, manifest, rules, selection, similarity, votes, windows
from . import standins as t
from .standins import MANIFEST, SEG, SIDES, VEC, cells, islands

QUERIES: dict = {}
SQL: dict[str, str] = {}
ERROR = "error"


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return keep


def _named(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("start", "start_ms").withColumnRenamed("end", "end_ms")


# --- intervals


@query("interval_merge", f"with {SEG}, {islands('m', 'seg', 'call')} select call, s as start_ms, e as end_ms from m")
def interval_merge(spark, sf):
    return _named(intervals.merge(t.segments(spark, sf), ["call"]))


@query("interval_merge_gap", f"with {SEG}, {islands('m', 'seg', 'call', 500)} select call, s as start_ms, e as end_ms from m")
def interval_merge_gap(spark, sf):
    return _named(intervals.merge(t.segments(spark, sf), ["call"], 500))


@query("interval_merge_session", f"with {SEG}, {islands('m', 'seg', 'call', 500)} select call, s as start_ms, e as end_ms from m")
def interval_merge_session(spark, sf):
    return _named(intervals.merge_by_session(t.segments(spark, sf), ["call"], 500))


_AB = f"{SEG}, a as (select * from seg where label <> 'error'), b as (select * from seg where label = 'error'), {cells('k', 'a', 'b', 'call')}"


@query("interval_subtract", f"with {_AB}, p as (select call, s, e from k where in_a and not in_b), {islands('m', 'p', 'call')} select call, s as start_ms, e as end_ms from m")
def interval_subtract(spark, sf):
    s = t.segments(spark, sf)
    return _named(intervals.subtract(s.where(F.col("label") != ERROR), s.where(F.col("label") == ERROR), ["call"]))


@query("interval_intersect", f"with {_AB}, p as (select call, s, e from k where in_a and in_b), {islands('m', 'p', 'call')} select call, s as start_ms, e as end_ms from m")
def interval_intersect(spark, sf):
    s = t.segments(spark, sf)
    return _named(intervals.intersect(s.where(F.col("label") != ERROR), s.where(F.col("label") == ERROR), ["call"]))


@query(
    "interval_split_long",
    f"""with {SEG}, n as (select *, greatest(ceil((e - s) / 7200000.0), 1)::int as n from seg)
select call, label, piece::int as piece, s + piece * ((e - s)::double / n) as start_ms, s + (piece + 1) * ((e - s)::double / n) as end_ms
from (select *, unnest(range(n)) as piece from n)""",
)
def interval_split_long(spark, sf):
    out = intervals.split_long(t.segments(spark, sf), 7_200_000)
    return out.select("call", "label", "piece", F.col("start").alias("start_ms"), F.col("end").alias("end_ms"))


@query("total_speech", f"with {SEG}, {islands('m', 'seg', 'call, label')} select call, label, sum(e - s)::bigint as speech_ms from m group by call, label")
def total_speech(spark, sf):
    return intervals.total(t.segments(spark, sf), ["call", "label"], "speech_ms")


@query(
    "source_speech",
    f"""with {_AB}, q as (select call, sum(e - s)::bigint as ms from k where in_a and not in_b group by call), r as (select distinct call from seg)
select r.call, coalesce(ms, 0)::bigint as source_ms from r left join q using (call)""",
)
def source_speech(spark, sf):
    s = t.segments(spark, sf)
    own = intervals.total(intervals.subtract(s.where(F.col("label") != ERROR), s.where(F.col("label") == ERROR), ["call"]), ["call"], "ms")
    return s.select("call").distinct().join(own, "call", "left").select("call", F.coalesce("ms", F.lit(0)).alias("source_ms"))


_CH = f"{SEG}, a as (select * from seg where channel = 1), b as (select * from seg where channel = 2), {cells('k', 'a', 'b', 'call')}"


@query(
    "overlap_ratio",
    f"""with {_CH} select call, sum(case when in_a and in_b then e - s else 0 end)::bigint as both_ms, sum(case when in_a or in_b then e - s else 0 end)::bigint as either_ms,
  round(sum(case when in_a and in_b then e - s else 0 end) / sum(case when in_a or in_b then e - s else 0 end), 6) as ratio from k group by call""",
)
def overlap_ratio(spark, sf):
    s = t.segments(spark, sf)
    out = intervals.overlap_ratio(s.where("channel = 1"), s.where("channel = 2"), ["call"])
    return out.select("call", F.col("both").alias("both_ms"), F.col("either").alias("either_ms"), F.round("ratio", 6).alias("ratio"))


@query(
    "interval_dilate_erode",
    f"""with {SEG}, w as (select call, s - 60000 as s, e + 60000 as e from seg), {islands('m', 'w', 'call')}
select call, s + 90000 as start_ms, e - 90000 as end_ms from m where e - 90000 > s + 90000""",
)
def interval_dilate_erode(spark, sf):
    return _named(intervals.shrink(intervals.grow(t.segments(spark, sf), ["call"], 60000), ["call"], 90000))


@query(
    "frames_speech",
    f"""with {SEG}, f as (select call, unnest(generate_series(s // 60000, (e + 59999) // 60000 - 1)) as f from seg)
select call, count(distinct f)::bigint as frames, min(f) as first_frame, max(f) as last_frame from f group by call""",
)
def frames_speech(spark, sf):
    """Frames of a minute with any speech: from merged intervals, so no frame is counted twice."""
    m = intervals.merge(t.segments(spark, sf).select("call", F.expr("start div 60000").alias("start"), F.expr("(end + 59999) div 60000").alias("end")), ["call"])
    return m.groupBy("call").agg(F.sum(F.col("end") - F.col("start")).alias("frames"), F.min("start").alias("first_frame"), (F.max("end") - 1).alias("last_frame"))


@query(
    "request_spans",
    f"""with {SEG}, x as (select call, channel, s, e from seg), {islands('m', 'x', 'call, channel', 500)}, p as (
  select call, channel, greatest(0, (s - 500) * 8 ) as a, least(25000000000, (e + 500) * 8) as b, s, e from m where e - s >= 300
), q as (select call, channel, a, b, greatest(a * 3, s * 24) as inner_a, least(b * 3, e * 24) as inner_b from p)
select call, channel, a, b, inner_a, inner_b from q where inner_b > inner_a""",
)
def request_spans(spark, sf):
    return intervals.request_spans(t.segments(spark, sf), ["call", "channel"], F.lit(25_000_000_000), 8000, 24000, 500, 300, 500)


# --- windows


@query(
    "sliding_windows",
    """select doc_id as call, w::bigint as w, w * 2000 as start_ms, w * 2000 + 4000 as end_ms
from (select doc_id, unnest(range(0, (n_chars * 60 - 4000) // 2000 + 1)) as w from documents where n_chars * 60 >= 4000)""",
)
def sliding_windows(spark, sf):
    d = t.table(spark, sf, "documents").select(F.col("doc_id").alias("call"), (F.col("n_chars") * 60).alias("n"))
    return _named(windows.sliding(d, "n", 4000, 2000).select("call", "w", "start", "end"))


_DAY, _HOP = 86_400_000, 43_200_000
_COV = f"""{SEG}, {islands('m', 'seg', 'call, channel')}, r as (select min(s) as lo, max(e) as hi from seg), w as (
  select unnest(generate_series(0::bigint, (select hi // {_HOP} from r))) as w
), c as (
  select m.call, m.channel, w.w, sum(greatest(0, least(m.e, w.w * {_HOP} + {_DAY}) - greatest(m.s, w.w * {_HOP})))::bigint as active
  from m join w on m.s < w.w * {_HOP} + {_DAY} and m.e > w.w * {_HOP} group by m.call, m.channel, w.w
)"""


@query("window_coverage", f"with {_COV} select call, channel, w, active as active_ms from c where active > 0")
def window_coverage(spark, sf):
    m = intervals.merge(t.segments(spark, sf), ["call", "channel"])
    return windows.coverage(m, ["call", "channel"], _DAY, _HOP).where("active > 0").withColumnRenamed("active", "active_ms")


@query(
    "usable_chunks",
    f"""with {_COV}, u as (select call, w, min(active) as least_ms from c where active >= 1200000 group by call, w having count(*) = 2)
select call, w, least_ms, row_number() over (partition by call order by w) - 1 as idx from u""",
)
def usable_chunks(spark, sf):
    """Windows in which both sides speak enough; only those get an index."""
    c = windows.coverage(intervals.merge(t.segments(spark, sf), ["call", "channel"]), ["call", "channel"], _DAY, _HOP).where("active >= 1200000")
    u = c.groupBy("call", "w").agg(F.min("active").alias("least_ms"), F.count("*").alias("n")).where("n = 2").drop("n")
    return u.withColumn("idx", F.row_number().over(Window.partitionBy("call").orderBy("w")).cast("long") - 1)


@query(
    "topk_within_budget",
    f"""with {SEG}, r as (
  select call, label, s, e - s as ms, row_number() over (partition by call, label order by e - s desc, s) as rn from seg where e - s >= 1000
), b as (
  select *, coalesce(sum(ms) over (partition by call, label order by rn rows between unbounded preceding and 1 preceding), 0) as used from r where rn <= 3
) select call, label, s as start_ms, ms, rn::int as rank from b where used < 30000000""",
)
def topk_within_budget(spark, sf):
    s = t.segments(spark, sf).select("call", "label", "start", (F.col("end") - F.col("start")).alias("ms")).where("ms >= 1000")
    out = windows.within_budget(s, ["call", "label"], F.col("ms"), ["start"], 3, 30_000_000)
    return out.select("call", "label", F.col("start").alias("start_ms"), "ms", "rank")


# --- rules

_ENERGY = "en as (select user_id as call, event_type as label, case when event_id % 5 < 3 then (case when event_type in ('click', 'view') then 1 else 2 end) else 1 + event_id % 2 end::bigint as channel, sum(floor(value * 1000)::bigint * floor(value * 1000)::bigint)::bigint as energy from events group by 1, 2, 3)"


def _energy(spark, sf):
    """Squared samples by call, label and channel: most of a label's energy on its own channel."""
    own = F.when(F.col("event_type").isin("click", "view"), 1).otherwise(2)
    channel = F.when(F.col("event_id") % 5 < 3, own).otherwise(1 + F.col("event_id") % 2).cast("long")
    x = F.floor(F.col("value") * 1000).cast("long")
    e = t.table(spark, sf, "events").select(F.col("user_id").alias("call"), F.col("event_type").alias("label"), channel.alias("channel"), (x * x).alias("sq"))
    return e.groupBy("call", "label", "channel").agg(F.sum("sq").alias("energy"))


@query(
    "channel_energy_share",
    f"""with {_ENERGY}, s as (select *, energy / nullif(sum(energy) over (partition by call, label), 0) as share from en)
select call, label, channel, energy, round(coalesce(share, 0), 6) as share, row_number() over (partition by call, label order by coalesce(share, 0) desc, channel) = 1 as loudest from s""",
)
def channel_energy_share(spark, sf):
    e = _energy(spark, sf)
    total = F.sum("energy").over(Window.partitionBy("call", "label"))
    e = e.withColumn("raw", F.when(total > 0, F.col("energy") / total).otherwise(0.0))
    loud = F.row_number().over(Window.partitionBy("call", "label").orderBy(F.desc("raw"), "channel")) == 1
    return e.select("call", "label", "channel", "energy", F.round("raw", 6).alias("share"), loud.alias("loudest"))


def _suitable(spark, sf):
    s = t.segments(spark, sf).where("call % 13 <> 0")
    facts = rules.label_facts(s, _energy(spark, sf))
    users = t.table(spark, sf, "events").select(F.col("user_id").alias("call")).distinct()
    n = F.when(F.col("call") % 17 == 0, None).when(F.col("call") % 11 == 0, 1).otherwise(2)
    return rules.suitability(
        facts, users.withColumn("n_channels", n), min_speech=15_000_000, min_label_speech=9_000_000, min_label_share=0.55, purity_energy=0.9, purity_channel=0.62
    )


_CASCADE = f"""{SEG}, sg as (select * from seg where call % 13 <> 0), {islands('m', 'sg', 'call, label')}, {_ENERGY}, sp as (
  select call, label, sum(e - s)::bigint as speech from m group by call, label
), ch as (select call, label, min(channel) as assigned from sg group by call, label), sh as (
  select sp.call, sp.label, speech, assigned, coalesce(en.energy / (select sum(energy) from en x where x.call = sp.call and x.label = sp.label), 0) as purity
  from sp join ch using (call, label) left join en on en.call = sp.call and en.label = sp.label and en.channel = ch.assigned
), rk as (
  select *, row_number() over (partition by call, assigned order by speech desc, label) as rn, max(speech) over (partition by call, assigned) as main from sh
), md as (select call, case when count(distinct channel) > 1 then 'channel' else 'energy' end as mode from sg group by call), f as (
  select call, count(distinct assigned) as n_assigned, count(*) as labels, max(case when rn > 1 and speech >= 9000000 and speech >= 0.55 * main then 1 else 0 end) as second,
    min(case when rn = 1 then purity end) as purity, min(case when rn = 1 then speech end) as least_speech from rk group by call
), u as (select distinct user_id as call from events)
"""


@query(
    "suitability_cascade",
    f"""with {_CASCADE} select u.call, case when u.call % 17 = 0 then 'no_audio' when labels is null then 'empty_rttm' when u.call % 11 = 0 then 'wrong_channel_count'
  when n_assigned <> 2 then 'n_channels=' || n_assigned when second = 1 then 'two_speakers_one_channel'
  when purity < case when mode = 'energy' then 0.9 else 0.62 end then 'low_purity' when least_speech < 15000000 then 'channel_silent' else 'suitable' end as reason,
  mode, labels, round(purity, 6) as purity, least_speech as least_speech_ms
from u left join f using (call) left join md using (call)""",
)
def suitability_cascade(spark, sf):
    return _suitable(spark, sf).select("call", "reason", "mode", "labels", F.round("purity", 6).alias("purity"), F.col("least_speech").alias("least_speech_ms"))


@query(
    "reason_histogram",
    "with r as (" + SQL["suitability_cascade"] + ") select reason, count(*) as n, round(100.0 * count(*) / sum(count(*)) over (), 4) as share from r group by reason",
)
def reason_histogram(spark, sf):
    return rules.histogram(_suitable(spark, sf), "reason")


@query(
    "minor_label_spans",
    f"""with {_CASCADE}, mi as (select call, label, assigned from rk where rn > 1), x as (
  select sg.call, mi.assigned as channel, s, e from sg join mi on sg.call = mi.call and sg.label = mi.label
), {islands('mm', 'x', 'call, channel')} select call, channel, s as start_ms, e as end_ms from mm""",
)
def minor_label_spans(spark, sf):
    s = t.segments(spark, sf).where("call % 13 <> 0")
    return _named(rules.minor_spans(s, rules.label_facts(s, _energy(spark, sf))))


@query(
    "candidate_cascade",
    f"""with {SIDES}, x as (
  select call, pos, case when call % 29 = 0 then null when call % 31 = 0 then 'same' else speaker end as speaker, ms, case when call % 37 = 0 and pos = 1 then null else ms end as src from sides
), p as (select call, count(*) as n, count(speaker) as known, count(distinct speaker) as spk, min(ms) as quality, count(src) as measured from x group by call)
select call, case when known < n or n < 2 then 'no_speaker_id' when spk < n then 'same_speaker_both_sides' when quality < 5000 then 'too_little_speech'
  when measured < n then 'no_vad_rttm' else 'ok' end as reason, quality from p""",
)
def candidate_cascade(spark, sf):
    s = t.call_sides(spark, sf)
    s = s.withColumn("speaker", F.when(F.col("call") % 29 == 0, None).when(F.col("call") % 31 == 0, "same").otherwise(F.col("speaker")))
    s = s.withColumn("source_speech", F.when((F.col("call") % 37 == 0) & (F.col("pos") == 1), None).otherwise(F.col("ms"))).withColumnRenamed("ms", "speech")
    return rules.candidates(s, 5000)


@query(
    "keep_first_by_key",
    """with r as (select source as key, doc_id, n_chars, row_number() over (partition by source order by n_chars, doc_id) as rn, count(*) over (partition by source) as n from documents)
select key, doc_id, n_chars, n - 1 as duplicates from r where rn = 1""",
)
def keep_first_by_key(spark, sf):
    """First row of each key in a fixed order; minima combine before the shuffle."""
    d = t.table(spark, sf, "documents").select("source", "doc_id", "n_chars")
    g = d.groupBy("source").agg(F.min(F.struct("n_chars", "doc_id")).alias("m"), (F.count("*") - 1).alias("duplicates"))
    return g.select(F.col("source").alias("key"), "m.doc_id", "m.n_chars", "duplicates")


@query(
    "pending_antijoin",
    "select doc_id from documents where doc_id not in (select doc_id from labels where doc_id is not null)",
)
def pending_antijoin(spark, sf):
    return manifest.pending(t.table(spark, sf, "documents").select("doc_id"), t.table(spark, sf, "labels"), "doc_id")


@query(
    "completeness",
    """with s as (select distinct conv_id as call, role from conversations where length(text) >= 20)
select call, count(*) as sides, count(*) >= 3 as complete from s group by call""",
)
def completeness(spark, sf):
    c = t.table(spark, sf, "conversations").where(F.length("text") >= 20)
    g = c.groupBy(F.col("conv_id").alias("call")).agg(F.countDistinct("role").alias("sides"))
    return g.withColumn("complete", F.col("sides") >= 3)


# --- votes and statistics

_VOTES = "v as (select l_suppkey as side, l_orderkey % 200 as speaker, case when (l_partkey + l_linenumber) % 5 < 2 then 'female' else 'male' end as label, round(l_extendedprice * 100)::bigint as w from lineitem)"


def _votes(spark, sf):
    label = F.when((F.col("l_partkey") + F.col("l_linenumber")) % 5 < 2, "female").otherwise("male")
    return t.table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("side"), (F.col("l_orderkey") % 200).alias("speaker"), label.alias("label"), F.round(F.col("l_extendedprice") * 100).cast("long").alias("w")
    )


def _vote_sql(key: str) -> str:
    return f"""with {_VOTES}, g as (select {key}, label, sum(w) as w, count(*) as c from v group by {key}, label), r as (
  select *, row_number() over (partition by {key} order by w desc, label) as rn, sum(w) over (partition by {key}) as tw, sum(c) over (partition by {key}) as n,
    count(*) over (partition by {key}) > 1 as mixed from g
) select {key}, label, round(w / tw, 4) as confidence, n::bigint as n, mixed from r where rn = 1"""


@query("weighted_vote_side", _vote_sql("side"))
def weighted_vote_side(spark, sf):
    return votes.vote(_votes(spark, sf), ["side"], "label", F.col("w"))


@query("weighted_vote_speaker", _vote_sql("speaker"))
def weighted_vote_speaker(spark, sf):
    return votes.vote(_votes(spark, sf), ["speaker"], "label", F.col("w"))


@query(
    "weighted_mean_vector",
    f"""with {VEC}, p as (select label, (1 + key % 7)::double as w, unnest(v) as x, unnest(generate_series(0, len(v) - 1)) as pos from vec),
m as (select label, pos, sum(x * w) / sum(w) as m from p group by label, pos)
select label, pos::int as pos, round(m / sqrt(sum(m * m) over (partition by label)), 5) as x from m""",
)
def weighted_mean_vector(spark, sf):
    v = t.vectors(spark, sf)
    return votes.mean_vectors(v, ["label"], "vec", 1 + F.col("key") % 7).withColumn("x", F.round("x", 5))


@query(
    "describe_stats",
    f"with {MANIFEST} select split, count(duration) as n, round(avg(duration), 4) as mean, round(quantile_cont(duration, 0.5), 4) as p50, round(quantile_cont(duration, 0.9), 4) as p90, round(max(duration), 4) as max from man group by split",
)
def describe_stats(spark, sf):
    return votes.describe(t.manifest(spark, sf), "duration", ["split"])


# --- similarity, graph, clusters


def _threshold(sf: str) -> float:
    return 0.70


_PAIRS = f"{VEC}, pr as (select a.key as a, b.key as b, a.grp as ga, b.grp as gb, a.channel as ca, b.channel as cb, (list_inner_product(a.v, b.v) + 1) / 2 as sim from vec a join vec b on a.key < b.key)"


@query("pair_similarity", f"with {_PAIRS} select a, b, round(sim, 6) as sim from pr where sim > 0.70 and ga <> gb")
def pair_similarity(spark, sf):
    return similarity.edges(t.vectors(spark, sf), _threshold(sf)).withColumn("sim", F.round("sim", 6))


_KIND = "case when ga = gb then 'same_call' when ca = cb then 'cross_call_same_channel' else 'cross_call_diff_channel' end"


@query(
    "similarity_diagnostics",
    f"""with {_PAIRS}, k as (select {_KIND} as kind, floor(sim * 1000000 + 0.5) / 1000000 as sim from pr)
select kind, count(*) as n, round(avg(sim), 5) as mean, round(quantile_cont(sim, 0.95), 5) as p95, round(quantile_cont(sim, 0.99), 5) as p99, round(max(sim), 5) as max,
  round(100.0 * sum(case when sim > 0.6 then 1 else 0 end) / count(*), 4) as above_pct from k group by kind""",
)
def similarity_diagnostics(spark, sf):
    return similarity.diagnostics(similarity.histogram(t.vectors(spark, sf)), 0.6)


@query(
    "threshold_sweep",
    f"""with {_PAIRS}, k as (select floor(sim * 1000000 + 0.5) / 1000000 as sim from pr where ga = gb), c as (select unnest([0.4, 0.45, 0.5, 0.55, 0.6]::double[]) as cut)
select cut, round(100.0 * sum(case when sim > cut then 1 else 0 end) / count(*), 4) as pct from k, c group by cut""",
)
def threshold_sweep(spark, sf):
    return similarity.threshold_sweep(similarity.histogram(t.vectors(spark, sf)), (0.4, 0.45, 0.5, 0.55, 0.6))


@query(
    "threshold_components",
    f"""with recursive {_PAIRS}, ed as (select a, b from pr where sim > 0.70 and ga <> gb union select b, a from pr where sim > 0.70 and ga <> gb), wk as (
  select a as node, a as root from ed union select ed.b, wk.root from wk join ed on ed.a = wk.node
) select node, min(root) as component from wk group by node""",
)
def threshold_components(spark, sf):
    return graph.connected_components(similarity.edges(t.vectors(spark, sf), _threshold(sf)))


@query("constrained_ahc")
def constrained_ahc(spark, sf):
    """Sequential by nature: checked against a global clustering in the tests."""
    return clustering.constrained_clusters(t.vectors(spark, sf), _threshold(sf))


# --- selection


def _calls(spark, sf):
    s = t.call_sides(spark, sf)
    g = s.groupBy("call", "quality").agg(F.sort_array(F.collect_list(F.struct("pos", "speaker", "ms"))).alias("x"))
    return g.select("call", "quality", F.col("x.speaker").alias("speakers"), F.col("x.ms").alias("times"))


@query("cap_admission")
def cap_admission(spark, sf):
    """Sequential by nature: checked against a plain loop in the tests."""
    return selection.cap_admission(_calls(spark, sf), 40, 1_200_000)


_GENDERS = """g as (select doc_id as call, n_chars as quality, [case when (doc_id * 7) % 10 < 7 then 'male' else 'female' end, case when (doc_id * 3) % 11 < 7 then 'male' else 'female' end] as genders from documents)"""


def _genders(spark, sf):
    d = t.table(spark, sf, "documents")
    pick = lambda k, m: F.when((F.col("doc_id") * k) % m < 7, "male").otherwise("female")
    return d.select(F.col("doc_id").alias("call"), F.col("n_chars").alias("quality"), F.array(pick(7, 10), pick(3, 11)).alias("genders"))


@query(
    "gender_balance",
    f"""with {_GENDERS}, c as (
  select count(*) * 2 as total, sum(len(list_filter(genders, lambda x: x = 'male'))) as male from g
), r as (
  select call, quality, row_number() over (order by quality, call) as rn from g where genders[1] = 'male' and genders[2] = 'male'
), k as (
  select coalesce(min(rn), 0) as k from r, c where abs((male - 2 * rn)::double / (total - 2 * rn) - 0.5) <= 0.02 and abs(male::double / total - 0.5) > 0.02
) select g.call, g.quality from g where g.call not in (select call from r, k where rn <= k)""",
)
def gender_balance(spark, sf):
    return selection.balance_gender(_genders(spark, sf), 0.02).select("call", "quality")


def _edges_as_calls(spark, sf):
    """Calls between the sides of similar vectors: many components."""
    e = similarity.edges(t.vectors(spark, sf), _threshold(sf))
    return e.select((F.col("a") * 1_000_000 + F.col("b")).alias("call"), F.array("a", "b").alias("speakers"))


@query("split_assignment")
def split_assignment(spark, sf):
    """The order of equal components is drawn from the seed: shares and leaks are checked in the tests."""
    return selection.split_by_component(_edges_as_calls(spark, sf), t.SPLITS)


@query(
    "split_leak_audit",
    f"""with {MANIFEST}, x as (select distinct call, split, unnest(speakers) as speaker from man)
select speaker, count(distinct split) as splits, count(distinct call) as calls from x group by speaker having count(distinct split) > 1""",
)
def split_leak_audit(spark, sf):
    x = t.manifest(spark, sf).select("call", "split", F.explode("speakers").alias("speaker"))
    return x.groupBy("speaker").agg(F.countDistinct("split").alias("splits"), F.countDistinct("call").alias("calls")).where("splits > 1")


@query(
    "exposure_summary",
    f"""with {SIDES}, p as (select speaker, sum(ms) as ms from sides group by speaker), r as (select *, row_number() over (order by ms desc, speaker) as rn, count(*) over () as n from p)
select count(*) as speakers, max(ms)::bigint as max_ms, max(case when rn = round_even(0.01 * (n - 1), 0) + 1 then ms end)::bigint as p99_ms,
  round(sum(case when rn <= 10 then ms end) / sum(ms), 4) as top10_share, round(sum(ms) / 3.6e6, 3) as hours from r""",
)
def exposure_summary(spark, sf):
    return selection.exposure(t.call_sides(spark, sf), F.col("ms"))
