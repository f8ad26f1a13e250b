import random

import numpy as np
import pytest
from twinline.functions import degrade, models, registry
from twinline.functions import signal as sig
from twinline.plans import config
from twinline.sources import audio


def masks(seed, seconds=60, sr=800):
    rng = random.Random(seed)
    out = []
    for c in (0, 1):
        spans, at = [], 1.0 + 3 * c
        while at < seconds - 4:
            spans.append((at, at + rng.uniform(0.5, 2.5)))
            at += rng.uniform(4, 8)
        out.append(sig.speech_mask(spans, seconds * sr, sr))
    return out


def test_overlap_of_every_shift_by_rolling():
    a, b = (sig.to_frames(m, 800) for m in masks(1, 20))
    want = [sig.overlap_ratio(a, np.roll(b, k)) for k in range(len(a))]
    assert np.allclose(sig.overlaps_of_all_shifts(a, b), want)


def test_rolls_leave_seams_silent():
    _, b = (sig.to_frames(m, 800) for m in masks(2, 20))
    cuts = sig.silent_cuts(b, 20)
    wide = sig.dilate(b, 20)
    assert len(cuts) > 1 and (cuts == np.flatnonzero(~wide)).all()
    edge = b.copy()
    edge[0] = True
    assert sig.silent_cuts(edge, 5).tolist() == [0]
    assert sig.silent_cuts(np.zeros(5, bool), 2).tolist() == [0, 1, 2, 3, 4] and sig.silent_cuts(np.ones(5, bool), 0).tolist() == [0]


def test_rolls_reach_the_band():
    got = []
    for seed in range(25):
        a, b = masks(seed)
        fa, fb = sig.to_frames(a, 800), sig.to_frames(b, 800)
        want = 0.1 + 0.15 * degrade.unit(seed)
        r = sig.roll_for_overlap(a, b, 800, want, degrade.unit(seed, "tie"))
        allowed = [k for k in range(len(fb)) if not sig.dilate(np.roll(fb, k), 20)[0] and not sig.dilate(fb, 20)[-k % len(fb)]]
        best = min(abs(sig.overlap_ratio(fa, np.roll(fb, k)) - want) for k in allowed)
        assert r.reason == "ok" and abs(sig.overlap_ratio(fa, np.roll(fb, r.samples // 8)) - r.overlap) < 1e-12
        assert abs(abs(r.overlap - want) - best) < 1e-8
        got.append(r.overlap)
    assert np.mean([(0.05 <= r <= 0.3) for r in got]) > 0.9 and np.ptp(got) > 0.05
    assert sig.roll_for_overlap(a, np.zeros_like(b), 800, 0.15).reason == "silent_source"


def test_dilate_and_erode_by_definition():
    rng = np.random.default_rng(1)
    m = rng.random(200) < 0.7
    want = np.zeros(200, bool)
    for i in np.flatnonzero(m):
        want[np.arange(i - 3, i + 4) % 200] = True
    assert (sig.dilate(m, 3) == want).all()
    assert (sig.erode(m, 2) == [all(0 <= j < 200 and m[j] for j in range(i - 2, i + 3)) for i in range(200)]).all()


def test_fades_levels_and_peaks():
    mask = np.zeros(1000, bool)
    mask[200:600] = True
    env = sig.fade_envelope(mask, 8000, 10)
    assert (env[:200] == 0).all() and (env[600:] == 0).all() and (env[290:510] == 1).all() and 0 < env[200] < 0.01 and np.all(np.diff(env[200:280]) > 0)
    rng = np.random.default_rng(1)
    x, y = rng.normal(0, 0.1, (2, 8000)).astype(np.float32)
    on = np.ones(8000, bool)
    for db in (-5, 0, 5):
        z, _ = sig.scale_to_sir(x, y, on, on, db)
        assert abs(20 * np.log10(sig.rms(x) / sig.rms(z)) - db) < 0.01
    hot = np.full(10, 2.0, np.float32)
    (m, a, b), gain = sig.guard_peaks([hot - hot, hot, -hot])
    assert abs(gain - 0.495) < 1e-9 and np.abs(a).max() <= 0.99 and np.allclose(m, a + b)
    assert sig.background(x + y, x, y, on)[0] < 1e-7 and abs(sig.background(x, x * 0.5, x * 0.4, on)[1] - 20 * np.log10(9)) < 1e-3


def test_degradations():
    rng = np.random.default_rng(3)
    t = np.arange(16000) / 8000
    x = (0.3 * np.sin(2 * np.pi * 300 * t) + 0.3 * np.sin(2 * np.pi * 3600 * t)).astype(np.float32)
    low = sig.band_limit(x, 8000, 2500)
    spec = np.abs(np.fft.rfft(low))
    assert spec[600] > 0.95 * np.abs(np.fft.rfft(x))[600] and spec[7200] < 0.01 * spec[600]
    assert (sig.band_limit(x, 8000, 4000) == x).all()
    assert (sig.clip_percentiles(x, 0, 100) == x).all() and sig.clip_percentiles(x, 10, 90).max() < x.max()
    y, lost = sig.packet_loss(x + 1, 8000, 1)
    assert lost > 0 and 0.02 < (y == 0).mean() < 0.25 and (sig.packet_loss(x, 8000, 1, 0.0)[0] == x).all()
    assert sig.packet_loss(x[:0], 8000, 1)[1] == 0 and not sig.packet_loss(x + 1, 8000, 2, 1.0)[0].any()
    bed = sig.noise_bed(rng.normal(0, 0.1, 3000), 16000, random.Random(1), 500)
    assert len(bed) == 16000 and 0.05 < sig.rms(bed[5000:]) < 0.15
    noisy = sig.add_noise(x, bed, None, 10)
    assert abs(20 * np.log10(sig.rms(x) / sig.rms(noisy - x)) - 10) < 0.5
    wet = sig.reverberate(x, sig.decaying_response(random.Random(2), 8000)[0])
    assert len(wet) == len(x) and abs(sig.rms(wet) - sig.rms(x)) < 1e-4
    for codec in (sig.mu_law, sig.a_law):
        assert 20 * np.log10(sig.rms(x) / sig.rms(codec(x) - x)) > 30
    assert sig.available_codecs() == ["mulaw", "alaw"]
    up = sig.resample(x, 8000, 24000)
    assert len(up) == 48000 and np.abs(sig.resample(up, 24000, 8000) - x)[200:-200].max() < 0.02
    with pytest.raises(ValueError):
        sig.resample(x, 8000, 11025)


def planted(sr=800):
    t = np.arange(30 * sr) / sr
    spans = [[(1, 3.5), (8, 10.5), (15, 17.5), (22, 24.5)], [(4.5, 7), (11.5, 14), (18.5, 21), (25.5, 28)]]
    rng = np.random.default_rng(1)
    return [(0.3 * np.sin(2 * np.pi * f * t) * sig.speech_mask(s, len(t), sr) + rng.normal(0, 0.004, len(t))).astype(np.float32) for f, s in zip((100, 170), spans, strict=True)], spans


def test_built_calls_pass_and_broken_ones_fail():
    x, spans = planted()
    for how in (degrade.Build(variants=2), degrade.Build(shuffle=True, natural_frac=0.0), degrade.Build(zerofy_mix=True)):
        r = degrade.build_call("c1", x, spans, 800, how)
        assert degrade.check_call(r, 800, how) == []
        again = degrade.build_call("c1", x, spans, 800, how)
        assert (again["mix"] == r["mix"]).all() and all((a["samples"] == b["samples"]).all() for a, b in zip(again["variants"], r["variants"], strict=True))
    how = degrade.Build()
    r = degrade.build_call("c1", x, spans, 800, how)
    assert degrade.check_call({**r, "mix": r["mix"] * 0.5}, 800, how)
    assert degrade.check_call({**r, "mix": np.roll(r["mix"], 403)}, 800, how)
    assert degrade.check_call({**r, "s1": r["s1"] * 0}, 800, how)
    k = degrade.build_call("c1", x, spans, 800, how, targets=[sig.resample(t, 800, 2400) for t in x], k=3)
    assert len(k["s1"]) == 3 * len(k["mix"]) and degrade.check_call(k, 800, how, 3) == []
    with pytest.raises(ValueError):
        degrade.build_call("c1", x, spans, 800, how, targets=[t[:-1] for t in x])
    solo = sig.speech_mask(spans[0], len(x[0]), 800)
    good = sig.spectral_alignment(r["mix"], r["s1"], solo)
    other = np.random.default_rng(9).normal(0, 0.1, len(r["s1"]))
    assert good > 0.65 > sig.spectral_alignment(r["mix"], other, solo)
    assert sig.spectral_alignment(r["mix"], r["s1"], np.zeros(len(solo), bool)) is None


def test_recipes_toss_every_coin():
    s = degrade.Settings()
    rooms = degrade.Banks({"simulated": {"r": np.ones(4, np.float32)}}, {"n": np.ones(100, np.float32)})
    n = [degrade.draw(f"call{i}", s, rooms) for i in range(2000)]
    for step in degrade.STEPS:
        assert abs(np.mean([step in r for r in n]) - 0.5) < 0.05
    assert all(not {"reverb", "noise"} & set(degrade.draw(str(i), s, degrade.Banks())) for i in range(50))
    assert all(2500 <= r["band_limit"]["cutoff_hz"] <= 3800 for r in n if "band_limit" in r) and len({r["packet_loss"]["seed"] for r in n if "packet_loss" in r}) > 900


def test_wav_round_trip():
    x = np.random.default_rng(1).uniform(-0.9, 0.9, (500, 2)).astype(np.float32)
    y, sr = audio.decode_wav(audio.encode_wav(x, 8000))
    assert sr == 8000 and np.abs(x - y).max() <= 1 / 65536 + 1e-7
    assert (audio.decode_wav(audio.encode_wav(x, 8000, floating=True))[0] == x).all()
    with pytest.raises(ValueError):
        audio.decode_wav(b"RIFFxxxxJUNK")


def test_models_by_name(spark):
    made = lambda column: lambda factor: lambda df: df.selectExpr(f"id * {factor} as {column}")
    registry.provides("thing", "a", "x long", factor=2)(made("x"))
    registry.provides("thing", "b", "x long", factor=...)(made("y"))
    assert [r.x for r in registry.model("thing", "a", factor=3)(spark.range(3)).collect()] == [0, 3, 6]
    assert registry.by_kind()["thing"] == ["a", "b"] and registry.by_kind()["vad"] == ["energy", "http"]
    with pytest.raises(ValueError, match="two models"):
        registry.provides("thing", "a", "x long")(made("x"))
    with pytest.raises(LookupError, match="a, b, not c"):
        registry.model("thing", "c")
    with pytest.raises(ValueError, match="no option speed"):
        registry.model("thing", "a", speed=1)
    with pytest.raises(ValueError, match="needs factor"):
        registry.model("thing", "b")
    with pytest.raises(TypeError, match="no proper x"):
        registry.model("thing", "b", factor=1)(spark.range(3))


def test_retries():
    class Down(Exception):
        status = 503

    left = [2]

    def post(v):
        if left[0]:
            left[0] -= 1
            raise Down
        return v

    assert models.retrying(post, 3, 0)(7) == 7
    left[0] = 9
    with pytest.raises(Down):
        models.retrying(post, 2, 0)(7)


def test_config(tmp_path):
    f = tmp_path / "c.yaml"
    f.write_text("seed: 7\nselect:\n  max_calls_per_speaker: 3\n")
    c = config.load(f, ["build.sir_db=[-1, 1]", "select.balance_gender=false"], tmp_path)
    assert c.seed == 7 and c.select.max_calls_per_speaker == 3 and c.build.sir_db == (-1.0, 1.0) and c.select.balance_gender is False
    assert c.paths.work_dir == tmp_path / "work" and c.filter.min_speech_sec == 3.0
    for bad in ("nope=1", "build.nope=1", "seed", "select.balance_gender=2", "build=3", "seed=[1]"):
        with pytest.raises(ValueError):
            config.load(None, [bad])


@pytest.mark.parametrize("name, rows", [("shift_search", 1), ("degrade_variants", 2), ("build_call", 1)])
def test_signal_queries_take_every_call(spark, tmp_path, name, rows):
    from twinline.plans import catalog

    spark.range(7, 14).withColumnRenamed("id", "p_partkey").write.parquet(f"{tmp_path}/part.parquet")
    got = [r.call for r in catalog.QUERIES[name](spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted([*range(7, 14)] * rows)


def test_usable_windows_by_hand():
    on = lambda *spans: np.concatenate([np.full(n, v, np.float32) for v, n in spans])
    a, b = on((1, 30), (0, 30), (1, 40)), on((0, 15), (1, 85))
    want = [k for k in range(7) if a[10 * k : 10 * k + 40].sum() >= 15 and b[10 * k : 10 * k + 40].sum() >= 15]
    assert degrade.usable_windows(a, b, 10, 4, 1, 1.5) == want and want
    assert degrade.usable_windows(np.repeat(a, 3), b, 10, 4, 1, 1.5) == want
    assert degrade.usable_windows(a[:20], b[:20], 10, 4, 1, 0.1) == []


def test_banks_and_masks_are_made_once_for_all_calls(monkeypatch):
    """What no call decides isn't made again for each variant; beds and spectra that are kept give the same signal."""
    from twinline.plans import records

    made, rows = [], []
    monkeypatch.setattr(records.sig, "decaying_response", lambda *a, f=sig.decaying_response: made.append(1) or f(*a))
    monkeypatch.setattr(records, "_per_call", lambda spark, sf, row, schema: rows.append(row))
    records.degrade_variants(None, None)
    first = [rows[0](call) for call in range(4)]
    assert len(made) <= 3 and [rows[0](call) for call in range(4)] == first
    banks = records._banks()
    fresh = degrade.Banks(banks.responses, banks.noise)
    x, _ = records._synthetic(3)
    recipe = {"reverb": {"kind": "simulated", "ir": "room1"}, "noise": {"clip": "clip2", "snr_db": 3.0, "seed": 5}}
    mask = records._masks()[0]
    by_hand = sig.add_noise(sig.reverberate(x[0], banks.responses["simulated"]["room1"]), sig.noise_bed(banks.noise["clip2"], len(x[0]), random.Random(9), 200), mask, 3.0)
    for b in (banks, fresh, fresh):
        assert (degrade.apply(x[0], recipe, 800, b, mask) == by_hand).all()
    fresh.kept.clear()
    fresh.kept.update({k: None for k in range(degrade.KEPT)})
    assert (degrade.apply(x[0], recipe, 800, fresh, mask) == by_hand).all() and len(fresh.kept) <= degrade.KEPT


def test_smooth_lengths_and_quantiles():
    for n in (1, 2, 7, 101, 16160, 16799, 32768, 99991):
        got = next(m for m in range(n, 2 * n + 1) if 30**40 % m == 0)
        assert sig.smooth(n) == got
    rng = np.random.default_rng(3)
    for n in (1, 2, 5, 800):
        x = rng.normal(size=n).astype(np.float32)
        assert (sig.quantiles(x, [0.031, 0.9]) == np.quantile(x, [0.031, 0.9])).all()
    assert np.isnan(sig.quantiles(np.array([1, np.nan], np.float32), [0.1, 0.9])).all()
    x = rng.normal(size=16000).astype(np.float32)
    h = sig.decaying_response(random.Random(1), 800)[0]
    assert np.allclose(sig.convolve(x, h), np.convolve(x.astype(float), h), atol=1e-4)
