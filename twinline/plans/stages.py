"""The curation pipeline on tables: audio to a split, mixed and checked dataset.

Each stage reads tables that earlier ones wrote and writes its own; a stage
whose table is there is skipped. ``run`` takes names or a first stage.
"""

from __future__ import annotations

import argparse
import json
import random
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import degrade, models  # noqa: F401  the built-in models register on import
from ..functions import signal as sig
from ..functions.registry import TABLE, by_kind, model
from ..operators import audit, banks, intervals, manifest, rules, selection, votes
from ..sources import audio as audio_source
from ..sources import tables
from . import config as configs

MS = 1000


class Store:
    """Tables of one run, by name."""

    def __init__(self, spark: SparkSession, cfg: configs.Config, limit: int | None = None, overwrite: bool = False):
        self.spark, self.cfg, self.limit, self.overwrite = spark, cfg, limit, overwrite

    def path(self, name: str) -> str:
        return f"{self.cfg.paths.work_dir}/{name}"

    def has(self, name: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path(name)}/_SUCCESS")
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def require(self, names: list[str], stage: str) -> None:
        if missing := [n for n in names if not self.has(n)]:
            raise SystemExit(f"{stage} needs {', '.join(missing)}")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def write(self, name: str, df: DataFrame, mode: str = "overwrite") -> None:
        df.write.mode(mode).parquet(self.path(name))

    def failed(self, stage: str, rows: DataFrame) -> None:
        """(item, error) of a stage, as text for people."""
        tables.write_failures(rows, self.path("failures"), stage)


def _as_ms(df: DataFrame) -> DataFrame:
    ms = lambda c: F.rint(F.col(c) * MS).cast("long")
    return df.withColumns({"start": ms("start"), "end": ms("end")})


def _audio(s: Store) -> DataFrame:
    return s.read("audio").where("error is null").select("call", "channel", "sr", "n_samples", "pcm")


def diarize(s: Store) -> None:
    c = s.cfg
    found = [audio_source.read(s.spark, d, c.paths.pattern) for d in c.paths.audio_dirs]
    s.write("audio", rules.union_all(found))
    s.failed("diarize", s.read("audio").where("error is not null").select(F.col("path").alias("item"), "error"))
    s.write("segments", _as_ms(model("diarizer", c.diarize.backend, **c.diarize.options)(_audio(s))).select("call", "label", "channel", "start", "end"))


def filter_calls(s: Store) -> None:
    f, sound = s.cfg.filter, _audio(s)
    seg = s.read("segments")
    parts = seg.select("call", "label", F.struct("start", "end").alias("span")).groupBy("call", "label").agg(F.collect_list("span").alias("spans"))

    @F.pandas_udf("double")
    def energy(pcm: pd.Series, sr: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([sum(float(np.square(np.asarray(x[int(p["start"] * r / MS) : int(p["end"] * r / MS)], float)).sum()) for p in ps) for x, r, ps in zip(pcm, sr, spans, strict=True)])

    loud = sound.join(parts, "call").select("call", "label", (F.col("channel") + 1).cast("int").alias("channel"), energy("pcm", "sr", "spans").alias("energy"))
    facts = rules.label_facts(seg, loud, f.channel_mode)
    calls = sound.groupBy("call").agg(F.count("*").alias("n_channels"), F.max(F.col("n_samples") / F.col("sr")).alias("duration"))
    verdicts = rules.suitability(
        facts, calls, f.expected_channels, f.min_speech_sec * MS, f.min_label_speech_sec * MS, f.min_label_share, f.purity_min, f.purity_min_channel_mode
    )
    s.write("suitability", verdicts.join(calls.select("call", "duration"), "call", "left"))
    s.write("excluded", rules.minor_spans(seg, facts))


def vad(s: Store) -> None:
    good = s.read("suitability").where("reason = 'suitable'").select("call")
    found = model("vad", s.cfg.vad.backend, **s.cfg.vad.options)(_audio(s).join(good, "call", "left_semi")).where("error is null")
    spans = found.select("call", (F.col("channel") + 1).alias("channel"), F.explode("value").alias("v")).select("call", "channel", "v.start", "v.end")
    s.write("speech", intervals.subtract(_as_ms(spans), s.read("excluded"), ["call", "channel"]))


def _sides(s: Store) -> DataFrame:
    return _audio(s).withColumn("channel", (F.col("channel") + 1).cast("int"))


def _cut(pieces: DataFrame, sides: DataFrame) -> DataFrame:
    """Rows (call, channel, start, end) with the samples between."""
    at = lambda c: (F.col(c) * F.col("sr") / MS).cast("int")
    return pieces.join(sides, ["call", "channel"]).withColumn("pcm", F.slice("pcm", at("start") + 1, F.greatest(at("end") - at("start"), F.lit(0))))


def embed(s: Store) -> None:
    e = s.cfg.embed
    long = s.read("speech").where(F.col("end") - F.col("start") >= e.min_speech_duration * MS)
    cut = _cut(intervals.split_long(long, e.longest_chunk_duration * MS), _sides(s)).withColumn("w", F.col("end") - F.col("start"))
    got = model("embedder", e.backend, **e.options)(cut.withColumn("call", F.concat_ws("\t", "call", "w"))).where("error is null")
    got = got.withColumn("p", F.split("call", "\t")).select(F.col("p")[0].alias("call"), "channel", F.col("p")[1].cast("double").alias("w"), "value")
    mean = votes.mean_vectors(got, ["call", "channel"], "value", F.col("w"))
    vec = mean.groupBy("call", "channel").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "x"))), lambda r: r["x"]).alias("vec"))
    whole = vec.groupBy("call").agg(F.count("*").alias("n")).where(F.col("n") >= e.expected_speakers).select("call")
    key = F.concat_ws("_speaker_", "call", "channel").alias("key")
    s.write("sides", vec.join(whole, "call", "left_semi").select(key, F.col("call").alias("grp"), "channel", "vec"))


def cluster(s: Store) -> None:
    c = s.cfg.cluster
    s.write("speakers", model("clusterer", c.backend, threshold=c.threshold)(s.read("sides").select("key", "grp", "vec")))


def gender(s: Store) -> None:
    from ..operators import windows

    g = s.cfg.gender
    spoken = s.read("speech").where(F.col("end") - F.col("start") >= g.min_segment_sec * MS)
    some = windows.within_budget(spoken, ["call", "channel"], F.col("end") - F.col("start"), ["start"], g.segments_per_speaker, g.max_total_sec * MS)
    cut = _cut(some.select("call", "channel", "start", "end"), _sides(s)).withColumn("call", F.concat_ws("\t", "call", F.col("end") - F.col("start")))
    got = model("gender", g.backend, **g.options)(cut).where("error is null").withColumn("p", F.split("call", "\t"))
    rows = got.select(F.concat_ws("_speaker_", F.col("p")[0], "channel").alias("key"), "value.label", (F.col("value.confidence") * F.col("p")[1].cast("double")).alias("w"))
    per_side = votes.vote(rows, ["key"], "label", F.col("w"))
    s.write("genders", votes.vote(per_side.join(s.read("speakers"), "key").select("speaker", "label", "confidence"), ["speaker"], "label", F.col("confidence")))


def select(s: Store) -> None:
    c = s.cfg.select
    length = s.read("speech").groupBy("call", "channel").agg(F.sum(F.col("end") - F.col("start")).alias("ms"))
    named = s.read("sides").select("key", F.col("grp").alias("call"), "channel").join(s.read("speakers"), "key", "left")
    sides = named.join(length, ["call", "channel"], "left").join(s.read("genders").select("speaker", F.col("label").alias("gender")), "speaker", "left")
    sides = sides.withColumns({"speech": F.col("ms"), "source_speech": F.col("ms")})
    judged = rules.candidates(sides, c.min_speech_sec * MS)
    rows = sides.groupBy("call").agg(F.sort_array(F.collect_list(F.struct("channel", "speaker", "ms", "gender"))).alias("x"))
    cand = judged.where("reason = 'ok'").join(rows, "call").select("call", "quality", F.col("x.speaker").alias("speakers"), F.col("x.ms").alias("times"), F.col("x.gender").alias("genders"))
    limit = selection.enabled(c.max_duration_per_speaker)
    capped = selection.cap_admission(cand, c.max_calls_per_speaker, None if limit is None else int(limit * MS))
    kept = cand.join(capped.where("reason = 'kept'").select("call"), "call", "left_semi")
    if c.balance_gender:
        kept = selection.balance_gender(kept, c.gender_tolerance)
    split = selection.split_by_component(kept.select("call", "speakers"), c.splits, s.cfg.seed)
    s.write("dropped", judged.where("reason <> 'ok'").select("call", "reason").unionByName(capped.where("reason <> 'kept'")))
    s.write("selection", kept.join(split.select("call", "split"), "call"))


def cache_settings(cfg: configs.Config) -> dict[str, str]:
    """What enhanced copies are made with; copies that differ in any of it don't belong in one cache."""
    e = cfg.enhance
    made = {"backend": e.backend, "input_rate": cfg.sample_rate, "output_rate": e.output_sample_rate, "regions": e.regions}
    return {k: str(v) for k, v in (made | {"merge_gap": e.merge_gap, "context_sec": e.context_sec, "min_span_sec": e.min_span_sec, "options": json.dumps(e.options, sort_keys=True)}).items()}


def _ratio(cfg: configs.Config) -> int:
    k, rest = divmod(cfg.enhance.output_sample_rate, cfg.sample_rate)
    if rest or not k:
        raise SystemExit(f"{cfg.enhance.output_sample_rate} Hz is no whole multiple of {cfg.sample_rate} Hz")
    return k


def _claim(s: Store) -> None:
    """Refuses to add to copies that were made otherwise, and notes what they are made with."""
    asked = s.spark.createDataFrame(list(cache_settings(s.cfg).items()), "name string, value string")
    if s.has("enhanced_settings") and not s.overwrite:
        if changed := manifest.settings_diff(s.read("enhanced_settings"), asked).collect():
            raise SystemExit("enhanced copies were made differently: " + ", ".join(f"{r.name} {r.recorded} -> {r.requested}" for r in changed))
    elif s.has("enhanced") and not s.overwrite:
        raise SystemExit("enhanced copies without their settings")
    else:
        s.write("enhanced_settings", asked)


def enhance(s: Store) -> None:
    """Restored copies of the selected calls' channels, at a multiple of the rate, call by call: those that are there stay.

    Only requests around speech go to the model; the rest of a channel is resampled as it is. A call with a request
    that fails has no copy, and is tried again by the next run.
    """
    e, c = s.cfg.enhance, s.cfg
    k = _ratio(c)
    _claim(s)
    calls = s.read("selection").select("call")
    again = s.overwrite or not s.has("enhanced")
    todo = calls.orderBy("call").limit(s.limit) if again and s.limit else calls if again else manifest.pending(calls, s.read("enhanced").select("call").distinct(), "call", s.limit)
    todo = s.spark.createDataFrame([], calls.schema) if todo.isEmpty() else todo
    sides = _sides(s).join(todo, "call", "left_semi")
    if e.regions == "full":
        spans = sides.select("call", "channel", F.lit(0).cast("long").alias("a"), F.col("n_samples").alias("b"), F.lit(0).cast("long").alias("inner_a"), (F.col("n_samples") * k).alias("inner_b"))
    else:
        speech = s.read("speech").join(sides.select("call", "channel", "n_samples"), ["call", "channel"])
        ms = lambda x: int(x * MS)
        spans = intervals.request_spans(speech, ["call", "channel", "n_samples"], F.col("n_samples"), c.sample_rate, c.sample_rate * k, ms(e.merge_gap), ms(e.min_span_sec), ms(e.context_sec)).drop("n_samples")
    cut = spans.join(sides, ["call", "channel"]).withColumn("pcm", F.slice("pcm", F.col("a").cast("int") + 1, (F.col("b") - F.col("a")).cast("int")))
    options = e.options | ({"k": k} if "k" in TABLE["enhancer", e.backend].options else {})
    got = model("enhancer", e.backend, **options)(cut.withColumn("call", F.concat_ws("\t", "call", "a", "b", "inner_a", "inner_b")))
    p = F.split("call", "\t")
    got = got.select(p[0].alias("call"), "channel", *[p[i + 1].cast("long").alias(n) for i, n in enumerate(("a", "b", "inner_a", "inner_b"))], "value", "error")
    short = F.size("value") != (F.col("b") - F.col("a")) * k
    s.write("requests", got.withColumn("error", F.coalesce("error", F.when(F.col("value").isNull() | short, "other length than asked for"))))
    got = s.read("requests")
    bad = got.where("error is not null").groupBy("call").agg(F.min("error").alias("error"))
    pieces = got.groupBy("call", "channel").agg(F.sort_array(F.collect_list(F.struct("inner_a", "inner_b", "a", "value"))).alias("pieces"))

    @F.pandas_udf("array<float>")
    def spliced(pcm: pd.Series, sr: pd.Series, parts: pd.Series) -> pd.Series:
        inner = lambda r: (r["inner_a"], r["inner_b"], np.asarray(r["value"], np.float32)[r["inner_a"] - r["a"] * k : r["inner_b"] - r["a"] * k])
        return pd.Series([sig.splice(np.asarray(x, np.float32), [inner(r) for r in (ps if ps is not None else [])], k, int(rate)) for x, rate, ps in zip(pcm, sr, parts, strict=True)])

    whole = sides.join(bad, "call", "left_anti").join(pieces, ["call", "channel"], "left")
    rate = (F.col("sr") * k).alias("rate")
    s.write("enhanced", whole.select("call", "channel", rate, spliced("pcm", "sr", "pieces").alias("pcm")), "overwrite" if again else "append")
    s.failed("enhance", bad.select(F.col("call").alias("item"), "error"))


def _rooms(s: Store, have: DataFrame | None) -> DataFrame:
    a, sr, seed = s.cfg.augment, s.cfg.sample_rate, s.cfg.seed

    def run(batches):
        for b in batches:
            made = [sig.shoebox_response(random.Random(f"{seed}:rir:{i}"), sr, tuple(a.rt60), tuple(a.room_dim), longest_s=a.ir_max_sec) for i in b["index"]]
            yield pd.DataFrame({"kind": "simulated", "name": b["name"], "pcm": [ir for ir, _ in made], "drawn": [json.dumps(d) for _, d in made]})

    todo = banks.missing_rooms(s.spark, a.simulated_rooms, have)
    return todo.repartition(s.spark.sparkContext.defaultParallelism, "index").mapInPandas(run, "kind string, name string, pcm array<float>, drawn string")


def _mono(s: Store, folder: str) -> DataFrame:
    """The first channel of every readable file under a folder, at the pipeline's rate; others have an error."""
    to = s.cfg.sample_rate
    rows = audio_source.read(s.spark, folder).where("channel is null or channel = 0").withColumn("channel", F.lit(0))
    read = rows.where("error is null").select("call", "channel", "sr", "pcm")
    got = models.per_row(read, lambda: lambda x, sr: sig.resample(x, sr, to), models.SAMPLES)
    return got.select("call", "value", "error").unionByName(rows.where("error is not null").select("call", F.lit(None).cast("array<float>").alias("value"), "error"))


def augment(s: Store) -> None:
    """Fills the bank: simulated rooms by their index, measured responses aligned anew, noise with little speech in it."""
    a, sr = s.cfg.augment, s.cfg.sample_rate
    have = s.read("bank").where("kind = 'simulated'") if s.has("bank") and not s.overwrite else None
    none = s.spark.createDataFrame([], "kind string, name string, pcm array<float>, drawn string")
    parts, bad = [_rooms(s, have), *([] if have is None else [have])], none.select(F.col("name").alias("item"), F.col("drawn").alias("error"))
    row = lambda kind, df: df.select(F.lit(kind).alias("kind"), F.col("call").alias("name"), F.col("value").alias("pcm"), F.lit(None).cast("string").alias("drawn"))
    if a.ir_dir:
        found = _mono(s, a.ir_dir)

        @F.pandas_udf("array<float>")
        def aligned(pcm: pd.Series) -> pd.Series:
            return pd.Series([sig.align_response(np.asarray(x, np.float32), sr, a.ir_max_sec) for x in pcm])

        good = found.where("error is null").withColumn("value", aligned("value")).where(F.size("value") > 1)
        parts.append(row("measured", good))
        bad = bad.unionByName(found.where("error is not null").select(F.col("call").alias("item"), "error"))
    if a.noise_dir:
        clips = _mono(s, a.noise_dir)
        bad = bad.unionByName(clips.where("error is not null").select(F.col("call").alias("item"), "error"))
        clips = clips.where("error is null").select("call", "value")
        if a.screen:
            some = banks.seeded_sample(clips, "call", s.cfg.seed, a.screen_limit)
            heard = model("vad", s.cfg.vad.backend, **s.cfg.vad.options)(some.select("call", F.lit(0).alias("channel"), F.lit(sr).alias("sr"), F.col("value").alias("pcm")))
            speech = F.aggregate("value", F.lit(0.0), lambda t, v: t + v["end"] - v["start"])
            judged = heard.where("error is null").select("call", speech.alias("speech"))
            fit = banks.quiet(some.join(judged, "call").withColumn("seconds", F.size("value") / F.lit(float(sr))), a.max_noise_speech_frac)
            clips = fit.select("call", "value")
        parts.append(row("noise", clips))
    s.write("bank_new", rules.union_all(parts))  # beside the old one, which it still reads
    s.write("bank", s.read("bank_new"))
    s.failed("augment", bad)
    usable, missing = banks.usable_kinds(degrade.Settings().codecs, sig.available_codecs())
    counts = s.read("bank").groupBy("kind").agg(F.count("*").alias("n"))
    codecs = s.spark.createDataFrame([(f"codec {c}", n) for names, n in ((usable, 1), (missing, 0)) for c in names], "kind string, n long")
    s.write("bank_index", counts.unionByName(codecs))


def _targets(s: Store, chosen: DataFrame) -> tuple[DataFrame, int]:
    """Enhanced copies (call, channel, target) that the build takes, and their rate over the recordings'.

    A dataset has targets of one rate: with copies at another rate than the recordings', each call needs one.
    """
    b, c = s.cfg.build, s.cfg
    none = s.spark.createDataFrame([], "call string, channel int, target array<float>")
    if b.use_enhanced == "never" or not (s.has("enhanced") or b.use_enhanced == "always"):
        return none, 1
    s.require(["enhanced", "enhanced_settings"], "build")
    kept, k = s.read("enhanced"), _ratio(c)
    marked = {r.name: r.value for r in s.read("enhanced_settings").collect()}.get("output_rate")
    cached = kept.groupBy("call").agg(F.min("rate").alias("rate"))
    faults = manifest.rate_faults(chosen.select("call"), cached, c.sample_rate * k, c.sample_rate, int(marked) if marked else None, b.zerofy_mix).collect()
    if faults:
        raise SystemExit("targets would be mixed: " + ", ".join(f"{r.fault} ({r.n} calls, such as {r.example})" for r in faults))
    taken = manifest.resolve_targets(chosen.select("call"), cached, b.use_enhanced).where("enhanced").select("call")
    return kept.join(taken, "call", "left_semi").select("call", "channel", F.col("pcm").alias("target")), k


def _build_settings(cfg: configs.Config) -> degrade.Build:
    b = cfg.build
    return degrade.Build(cfg.seed, b.fade_ms, b.sir_db, b.peak_ceiling, b.shuffle, b.natural_frac, b.target_overlap, b.seam_guard_ms / MS, b.zerofy_mix, b.variants, degrade.Settings(b.degrade_prob))


def _bank_of(names: dict[str, list[str]], recordings=()) -> degrade.Banks:
    """All names to draw from, with the samples of those given."""
    full = {kind: dict.fromkeys(ns) for kind, ns in names.items()}
    for r in recordings if recordings is not None else ():
        full[r["kind"]][r["name"]] = np.asarray(r["pcm"], np.float32)
    noise = full.pop("noise", {})
    return degrade.Banks(full, noise)


BUILT = "call string, sr int, k int, mix array<float>, s1 array<float>, s2 array<float>, meta string, variants array<struct<index:int,samples:array<float>,recipes:string,rms:double,correlation:double>>, chunks array<long>"


def build(s: Store) -> None:
    b, how = s.cfg.build, _build_settings(s.cfg)
    chosen = s.read("selection").select("call", "split", "speakers", "genders")
    targets, k = _targets(s, chosen)
    bank = s.read("bank") if s.has("bank") else None
    names = banks.names_by_kind(bank) if bank is not None and b.variants else {}
    spans = s.read("speech").groupBy("call", "channel").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    cuts = s.read("excluded").groupBy("call", "channel").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("cuts"))
    sides = _sides(s).join(chosen, "call", "left_semi").join(spans, ["call", "channel"]).join(cuts, ["call", "channel"], "left").join(targets, ["call", "channel"], "left")
    rows = sides.groupBy("call").agg(F.sort_array(F.collect_list(F.struct("channel", "sr", "pcm", "spans", "cuts", "target"))).alias("x")).where(F.size("x") == 2)
    if names:

        @F.pandas_udf("array<struct<kind:string,name:string>>")
        def wanted(call: pd.Series) -> pd.Series:
            known = _bank_of(names)
            return pd.Series([[{"kind": kind, "name": n} for kind, n in sorted(degrade.needed(f"{how.seed}:{c}", how.variants, how.degrade, known))] for c in call])

        needs = chosen.select("call", F.explode(wanted("call")).alias("r")).select("call", "r.kind", "r.name")
        rows = banks.attach(rows, needs, bank)
    else:
        rows = rows.withColumn("recordings", F.lit(None).cast("array<struct<kind:string,name:string,pcm:array<float>>>"))

    def run(batches):
        sec = lambda spans: [(p["start"] / MS, p["end"] / MS) for p in spans] if spans is not None else []
        for batch in batches:
            out = []
            for call, x, recordings in zip(batch["call"], batch["x"], batch["recordings"], strict=True):
                sr, given = int(x[0]["sr"]), [c["target"] for c in x]
                restored = None if any(t is None for t in given) else [np.asarray(t, np.float32) for t in given]
                ratio = 1 if restored is None else k
                r = degrade.build_call(call, [np.asarray(c["pcm"], np.float32) for c in x], [sec(c["spans"]) for c in x], sr, how, [sec(c["cuts"]) for c in x], restored, ratio, _bank_of(names, recordings))
                meta = {n: v for n, v in r.items() if n not in ("mix", "s1", "s2", "variants")}
                vs = [{**v, "recipes": json.dumps(v["recipes"])} for v in r["variants"]]
                chunks = degrade.usable_windows(r["s1"], r["s2"], sr, b.chunk_sec, b.chunk_hop, b.min_active_per_src)
                out.append((call, sr, ratio, r["mix"], r["s1"], r["s2"], json.dumps(meta), vs, chunks))
            yield pd.DataFrame(out, columns=["call", "sr", "k", "mix", "s1", "s2", "meta", "variants", "chunks"])

    s.write("built", rows.select("call", "x", "recordings").mapInPandas(run, BUILT))
    made = s.read("built")
    variant = F.explode(F.concat(F.array(F.lit(None).cast("int")), F.col("variants.index")))
    listed = made.select("call", (F.size("mix") / F.col("sr")).alias("duration"), variant.alias("variant")).join(chosen, "call")
    s.write("manifest", listed)
    # whole windows in which both sources are active; w counts hops
    at = F.col("w") * b.chunk_hop
    chunks = made.select("call", F.explode("chunks").alias("w")).join(chosen.select("call", "split"), "call")
    s.write("chunks", chunks.withColumns({"start": at, "end": at + b.chunk_sec}))
    s.write("stats", manifest.split_rollup(listed, s.read("chunks"), list(s.cfg.select.splits)))


def _signal_problems(s: Store) -> DataFrame:
    """(call, problems) by measuring what is stored anew, against what the build noted."""
    how = _build_settings(s.cfg)

    def run(batches):
        for batch in batches:
            out = []
            for call, sr, k, mix, s1, s2, meta, vs in batch.itertuples(index=False, name=None):
                noted = json.loads(meta) | {n: np.asarray(x, np.float32) for n, x in (("mix", mix), ("s1", s1), ("s2", s2))}
                noted["variants"] = [{**v, "samples": np.asarray(v["samples"], np.float32)} for v in vs]
                out.append((call, degrade.check_call(noted, int(sr), how, int(k))))
            yield pd.DataFrame(out, columns=["call", "problems"])

    return s.read("built").select("call", "sr", "k", "mix", "s1", "s2", "meta", "variants").mapInPandas(run, "call string, problems array<string>")


def verify(s: Store) -> None:
    m = s.read("manifest")
    c, chosen, built = s.cfg.select, s.read("selection"), s.read("built")
    signal = audit.violations(_signal_problems(s).select("call", F.explode("problems").alias("p")), "signal", "call", F.col("p"))
    sides = chosen.select("call", F.explode(F.arrays_zip("speakers", "times")).alias("x")).select("call", F.col("x.speakers").alias("speaker"), F.col("x.times").alias("ms"))
    limit = selection.enabled(c.max_duration_per_speaker)
    variants = built.select("call", F.explode("variants.index").alias("variant"))
    trios = built.select("call", "sr", F.size("mix").alias("n"), (F.col("sr") * F.col("k")).alias("target_sr"), F.size("s1").alias("n1"), F.size("s2").alias("n2"))
    checks = [
        audit.leaks(m), audit.orphans(m.select("call").distinct(), chosen.select("call"), "call"), audit.gender_share(m), signal,
        audit.caps(m, sides, selection.enabled(c.max_calls_per_speaker), None if limit is None else int(limit * MS)),
        audit.chunk_splits(s.read("chunks"), m), audit.variants_agree(m.where("variant is not null").select("call", "variant"), variants),
        audit.partition_of(chosen.select("call", "split"), m.where("variant is null").select("call", "split"), "call"),
        audit.formats(trios, s.cfg.sample_rate),
    ]
    s.write("problems", audit.verdict(checks))


STAGES: dict[str, tuple[Callable[[Store], None], list[str], str]] = {
    "diarize": (diarize, [], "segments"), "filter": (filter_calls, ["segments"], "suitability"), "vad": (vad, ["suitability"], "speech"), "embed": (embed, ["speech"], "sides"),
    "cluster": (cluster, ["sides"], "speakers"), "gender": (gender, ["speakers"], "genders"), "select": (select, ["speakers", "genders"], "selection"),
    "enhance": (enhance, ["selection", "speech"], "enhanced"), "augment": (augment, [], "bank_index"), "build": (build, ["selection"], "stats"), "verify": (verify, ["manifest"], "problems"),
}


#: Stages that add to their table call by call, and so run again where it is there.
GROWING = ("enhance",)


def planned(cfg: configs.Config, start: str | None = None) -> list[str]:
    """The stages of a whole run: copies are enhanced if the build demands them, banks filled if it makes variants."""
    idle = {"enhance": cfg.build.use_enhanced != "always", "augment": not cfg.build.variants}
    names = [n for n in STAGES if not idle.get(n) or n == start]
    return names[names.index(start) if start else 0 :]


def run(spark: SparkSession, cfg: configs.Config, stages: list[str] | None = None, start: str | None = None, overwrite: bool = False, limit: int | None = None) -> Store:
    """Runs the named stages, or all from ``start`` on; those whose table is there are skipped unless overwritten.

    ``limit`` bounds the calls that one run of the enhance stage takes on.
    """
    if start and start not in STAGES:
        raise SystemExit(f"no stage {start}; there are {', '.join(STAGES)}")
    names = stages or planned(cfg, start)
    if unknown := [n for n in names if n not in STAGES]:
        raise SystemExit(f"no stage {unknown[0]}; there are {', '.join(STAGES)}")
    store = Store(spark, cfg, limit, overwrite)
    for n in names:
        work, needs, makes = STAGES[n]
        store.require(needs, n)
        if overwrite or n in GROWING or not store.has(makes):
            work(store)
    return store


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="twinline")
    p.add_argument("command", choices=["run", "backends", "config", *STAGES])
    p.add_argument("--config")
    p.add_argument("--set", action="append", default=[], metavar="NAME=VALUE")
    p.add_argument("--stages", help="comma-separated")
    p.add_argument("--from", dest="start")
    p.add_argument("--overwrite", action="store_true")
    p.add_argument("--limit", type=int, help="calls that one run of enhance takes on")
    a = p.parse_args(argv)
    cfg = configs.load(a.config, a.set)
    if a.command == "backends":
        print("\n".join(f"{kind}: {', '.join(names)}" for kind, names in by_kind().items()))
    elif a.command == "config":
        print(json.dumps(cfg.as_dict(), default=str, indent=2))
    else:
        spark = SparkSession.builder.appName("twinline").getOrCreate()
        store = run(spark, cfg, a.stages.split(",") if a.stages else None if a.command == "run" else [a.command], a.start, a.overwrite, a.limit)
        if store.has("problems") and (n := store.read("problems").count()):
            store.read("problems").show(40, False)
            print(f"{n} problems")
            return 1
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
