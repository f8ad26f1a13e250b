"""The planted corpus through all stages; files, streams, and the driver's contract."""

import datetime as dt

import numpy as np
import pytest
from twinline import streaming
from twinline.functions import degrade, models
from twinline.functions import signal as sig
from twinline.operators import intervals
from twinline.plans import config, stages
from twinline.sources import audio, rttm, tables

SR = 8000
VOICES = {"A": 200, "B": 250, "C": 400, "D": 450, "E": 300, "F": 500, "G": 350, "H": 550}
SPANS = [[(1, 3.5), (8, 10.5), (15, 17.5), (22, 24.5)], [(4.5, 7), (11.5, 14), (18.5, 21), (25.5, 28)]]


def recording(seed, voices):
    t = np.arange(30 * SR) / SR
    rng = np.random.default_rng(seed)
    out = []
    for v, spans in zip(voices, SPANS, strict=True):
        f = VOICES[v] if v else 0
        tone = 0.3 * (np.sin(2 * np.pi * f * t) + 0.3 * np.sin(4 * np.pi * f * t)) * sig.speech_mask(spans, len(t), SR) if v else 0 * t
        out.append(tone + rng.normal(0, 0.004, len(t)))
    return np.stack(out, 1).astype(np.float32)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("corpus")
    (root / "audio").mkdir()
    pairs = ["AB", "CD", "EF", "GH"]
    for i in range(8):
        (root / f"audio/call0{i + 1}.wav").write_bytes(audio.encode_wav(recording(i, pairs[i // 2]), SR))
    (root / "audio/silent.wav").write_bytes(audio.encode_wav(recording(90, ["A", None]), SR))
    (root / "audio/broken.wav").write_bytes(b"RIFF____WAVE")
    cfg = config.load(None, ["select.splits={train: 0.5, dev: 0.25, test: 0.25}", "build.variants=1", "cluster.threshold=0.9", "select.balance_gender=false", "augment.simulated_rooms=12"], root)
    return stages.run(spark, cfg)


def test_every_stage_gives_the_planted_answer(built):
    reasons = {r.call: r.reason for r in built.read("suitability").collect()}
    good = {f"call0{i}" for i in range(1, 9)}
    assert {c for c, r in reasons.items() if r == "suitable"} == good and reasons["silent"] == "n_channels=1"
    assert built.read("audio").where("error is not null").count() == 1
    sides = built.read("sides").collect()
    assert len(sides) == 16 and all(abs(np.linalg.norm(s.vec) - 1) < 1e-6 for s in sides)
    speakers = {}
    for r in built.read("speakers").collect():
        speakers.setdefault(r.speaker, set()).add(r.key)
    assert sorted(len(v) for v in speakers.values()) == [2] * 8
    assert all({k[:6] for k in v} in ({"call01", "call02"}, {"call03", "call04"}, {"call05", "call06"}, {"call07", "call08"}) for v in speakers.values())
    genders = {r.speaker: r.label for r in built.read("genders").collect()}
    key_of = {k: s for s, ks in speakers.items() for k in ks}
    assert [genders[key_of[f"call01_speaker_{c}"]] for c in (1, 2)] == ["male", "male"] and genders[key_of["call03_speaker_1"]] == "female"
    split = {r.call: r.split for r in built.read("selection").collect()}
    assert set(split) == good and all(split[f"call0{i}"] == split[f"call0{i + 1}"] for i in (1, 3, 5, 7)) and len(set(split.values())) == 3
    assert built.read("manifest").count() == 16
    assert [r.check for r in built.read("problems").collect()] in ([], ["gender"])
    stats = {r.split: (r.rows, r.calls) for r in built.read("stats").collect()}
    chunks = built.read("chunks").collect()
    assert chunks and all(r.split == split[r.call] and r.end - r.start == 4.0 and r.start == 2.0 * r.w for r in chunks)
    assert sum(r.chunks for r in built.read("stats").collect()) == len(chunks)
    assert sum(v[0] for v in stats.values()) == 16 and sum(v[1] for v in stats.values()) == 8


def test_restored_targets_banks_and_their_checks(built, spark):
    root = built.cfg.paths.root
    for folder in ("noise", "irs"):
        (root / folder).mkdir()
    rng = np.random.default_rng(3)
    for i in range(3):
        (root / f"noise/clip{i}.wav").write_bytes(audio.encode_wav(rng.normal(0, 0.004, 2 * SR), SR))
        (root / f"irs/hall{i}.wav").write_bytes(audio.encode_wav(rng.normal(0, 0.2, 600) * 0.99 ** np.arange(600), SR))
    (root / "noise/voice.wav").write_bytes(audio.encode_wav(recording(1, "AB")[:, 0], SR))
    (root / "noise/broken.wav").write_bytes(b"RIFF")
    more = ["build.use_enhanced=always", "build.variants=2", "augment.simulated_rooms=20", f"augment.ir_dir={root / 'irs'}", f"augment.noise_dir={root / 'noise'}"]
    cfg = config.load(None, ["select.splits={train: 0.5, dev: 0.25, test: 0.25}", "cluster.threshold=0.9", "select.balance_gender=false", *more], root)
    old = {r.name: list(r.pcm) for r in built.read("bank").collect()}
    s = stages.run(spark, cfg, ["enhance"], limit=3)
    first = s.read("enhanced")
    assert first.select("call").distinct().count() == 3 and {r.rate for r in first.collect()} == {24000}
    with pytest.raises(SystemExit, match="not cached"):
        stages.run(spark, cfg, ["build"], overwrite=True)
    stages.run(spark, cfg, ["enhance"])
    assert s.read("enhanced").groupBy("call", "channel").count().where("count = 1").count() == 16
    with pytest.raises(SystemExit, match="merge_gap"):
        stages.run(spark, config.load(None, [*more, "enhance.merge_gap=0.25"], root), ["enhance"])
    stages.augment(s)
    bank = {(r.kind, r.name): list(r.pcm) for r in s.read("bank").collect()}
    kinds = [k for k, _ in bank]
    assert (kinds.count("simulated"), kinds.count("measured")) == (20, 3) and {n for k, n in bank if k == "noise"} == {"clip0", "clip1", "clip2"}
    assert all(bank["simulated", n] == pcm for n, pcm in old.items())  # a bank that grows keeps what it had
    assert {r.kind: r.n for r in s.read("bank_index").collect()}["codec opus"] == 0
    stages.run(spark, cfg, ["build", "verify"], overwrite=True)
    rows = s.read("built").collect()
    assert len(rows) == 8 and all(r.k == 3 and len(r.s1) == 3 * len(r.mix) and len(r.variants) == 2 for r in rows)
    recipes = "".join(v.recipes for r in rows for v in r.variants)
    assert '"noise": {' in recipes and '"reverb": {' in recipes
    assert [r.check for r in s.read("problems").collect()] in ([], ["gender"])
    r = rows[0].asDict(recursive=True)
    other = rows[2].asDict(recursive=True)
    wrong = {**r, "enhanced": True, "variants": [], **{n: np.asarray(r[n], np.float32) for n in ("mix", "s1")}, "s2": np.asarray(other["s2"], np.float32)}
    assert "s2_not_aligned" in degrade.check_call(wrong, SR, degrade.Build(), 3)
    probed = audio.read(spark, str(root / "audio"), samples=False).collect()
    assert {(p.call, p.channel, p.sr, p.n_samples) for p in probed if p.error is None} == {(f, c, SR, 30 * SR) for f in (*[f"call0{i}" for i in range(1, 9)], "silent") for c in (0, 1)}
    assert [p.call for p in probed if p.error] == ["broken"]


def test_stages_skip_and_refuse(built, spark):
    before = built.read("selection").inputFiles()
    stages.run(spark, built.cfg, ["select"])
    assert built.read("selection").inputFiles() == before
    with pytest.raises(SystemExit):
        stages.run(spark, config.load(None, [], built.cfg.paths.root / "elsewhere"), ["select"])
    with pytest.raises(SystemExit):
        stages.run(spark, built.cfg, ["nope"])


def test_a_failing_model_costs_one_row(spark):
    rows = [("a", 0, 8000, [0.1] * 10), ("b", 0, 8000, [])]
    df = spark.createDataFrame(rows, "call string, channel int, sr int, pcm array<float>")
    got = {r.call: (r.value, r.error) for r in models.per_row(df, lambda: lambda x, sr: float(x[0]), "double").collect()}
    assert got["a"][1] is None and got["b"][0] is None and "IndexError" in got["b"][1]


def test_rttm_files(spark, tmp_path):
    rows = [("c1", 1, 0.5, 1.25, "a"), ("c1", 2, 2.0, 3.125, "b"), ("c2", 1, 0.0, 0.001, "a")]
    df = spark.createDataFrame(rows, "call string, channel int, start double, end double, label string")
    for c in ("c1", "c2"):
        lines = [r.v for r in df.where(f"call = '{c}'").select(rttm.format_line().alias("v")).collect()]
        (tmp_path / f"{c}.rttm").write_text("\n".join([*lines, "", "; comment"]) + "\n")
    assert sorted(map(tuple, rttm.read(spark, str(tmp_path)).select("call", "channel", "start", "end", "label").collect())) == rows
    rttm.write(df, str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).count() == 3


def test_split_manifests(spark, tmp_path):
    rows = spark.createDataFrame([(1, "train"), (2, "odd")], "call int, split string")
    assert tables.write_splits(rows, str(tmp_path / "m"), ["train", "dev"]) == {"train": 1, "odd": 1, "dev": 0}
    with pytest.raises(ValueError):
        tables.write_splits(rows, str(tmp_path / "n"), ["manifest"])
    (tmp_path / "k.json").write_text('{"a": {"x": 1}, "b": {"x": 2}}')
    assert sorted(map(tuple, tables.read_keyed_json(spark, str(tmp_path / "k.json"), "struct<x:int>").collect())) == [("a", 1), ("b", 2)]


def test_streams_equal_batches(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(k, t0 + dt.timedelta(milliseconds=s), 1000 + 37 * (s % 11)) for k in (1, 2) for s in range(0, 60000, 1700)]
    schema = "k int, ts timestamp, length_ms long"
    df = spark.createDataFrame(rows, schema)
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    end = spark.createDataFrame([(9, t0 + dt.timedelta(hours=1), 1)], schema)
    end.write.mode("append").parquet(str(tmp_path / "in"))
    live = streaming.merge_stream(streaming.follow_folder(spark, str(tmp_path / "in"), schema), ["k"], 500, "10 seconds")
    q = live.writeStream.format("memory").queryName("merged").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    batch = df.selectExpr("k", "unix_millis(ts) as start", "unix_millis(ts) + length_ms as end")
    want = sorted(map(tuple, intervals.merge(batch, ["k"], 500).collect()))
    assert sorted(map(tuple, spark.table("merged").select("k", "start", "end").where("k < 9").collect())) == want


def test_shared_tables_survive_and_clear(spark):
    from twinline.plans import shared

    made = shared.materialize(spark.range(10).selectExpr("id", "id % 3 as k"), "test")
    assert made.groupBy("k").count().count() == 3 and "twinline-test" in made.inputFiles()[0]
    assert shared.clear(spark) >= 1 and shared.clear(spark) == 0


def test_contract(spark):
    import __spark_entry__ as e

    q, s = e.queries(), e.oracle_sql()
    assert set(s) <= set(q) and len(q) > 60
    rows = e.entry(spark).collect()
    assert rows and {"reason", "n", "share"} == set(rows[0].asDict())


def test_everything_else_works_without_the_training_data_folders(tmp_path):
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    here, there = Path(__file__).resolve().parents[1], tmp_path / "repo"
    shutil.copytree(here, there, ignore=lambda d, names: {".git"} | ({"llm"} if Path(d).name in ("tests", "twinline") else set()))
    say = "import __spark_entry__ as e, bench; q = e.queries(); print(len(q), len(e.oracle_sql()), sum(n == 'pipeline' or n.startswith('op') and n[2].isdigit() for n in q))"
    out = subprocess.run([sys.executable, "-c", say], cwd=there, capture_output=True, text=True, timeout=120)
    n, sql, llm = map(int, out.stdout.split())
    assert n > 60 and sql > 50 and llm == 0
