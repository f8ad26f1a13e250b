import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from twinline.operators import audit, clustering, graph, intervals, manifest, rules, selection, similarity, votes, windows


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def random_spans(seed, keys=40, span=60):
    rng = random.Random(seed)
    return [(k, s, s + rng.randrange(1, 12)) for k in range(keys) for s in [rng.randrange(span) for _ in range(rng.randrange(6))]]


def painted(rows, span=90):
    out = {}
    for k, s, e in rows:
        out.setdefault(k, np.zeros(span, bool))[s:e] = True
    return out


def pieces(grid):
    edge = np.diff(np.concatenate([[0], grid.astype(int), [0]]))
    return list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True))


@pytest.fixture(scope="module")
def spans(spark):
    a, b = random_spans(1), random_spans(2)
    make = lambda r: spark.createDataFrame(r, "k int, start long, end long")
    return a, b, make(a), make(b)


def test_interval_algebra_against_painting(spans):
    a, b, da, db = spans
    pa, pb = painted(a), painted(b)
    none = np.zeros(90, bool)
    want = lambda f: sorted((k, s, e) for k in {*pa, *pb} for s, e in pieces(f(pa.get(k, none), pb.get(k, none))))
    assert rows_of(intervals.merge(da, ["k"])) == want(lambda x, y: x)
    assert rows_of(intervals.subtract(da, db, ["k"])) == want(lambda x, y: x & ~y)
    assert rows_of(intervals.intersect(da, db, ["k"])) == want(lambda x, y: x & y)
    got = {r.k: (r.both, r.either) for r in intervals.overlap_ratio(da, db, ["k"]).collect()}
    assert got == {k: (int((pa.get(k, none) & pb.get(k, none)).sum()), int((pa.get(k, none) | pb.get(k, none)).sum())) for k in {*pa, *pb}}


def test_merge_forms_agree_and_gap_is_inclusive(spark, spans):
    _, _, da, _ = spans
    for gap in (0, 2):
        assert rows_of(intervals.merge(da, ["k"], gap)) == rows_of(intervals.merge_by_session(da, ["k"], gap).select("k", "start", "end"))
    d = spark.createDataFrame([(1, 0, 5), (1, 7, 9), (1, 12, 13)], "k int, start long, end long")
    assert rows_of(intervals.merge(d, ["k"], 2)) == [(1, 0, 9), (1, 12, 13)]


def test_split_long_and_erosion(spark):
    d = spark.createDataFrame([(1, 0.0, 1.0), (2, 0.0, 20.0), (3, 0.0, 20.1), (4, 0.0, 55.0)], "k int, start double, end double")
    got = intervals.split_long(d, 20.0).groupBy("k").count().collect()
    assert {r.k: r["count"] for r in got} == {1: 1, 2: 1, 3: 2, 4: 3}
    e = spark.createDataFrame([(1, 0, 10), (1, 8, 20), (2, 0, 3)], "k int, start long, end long")
    assert rows_of(intervals.shrink(e, ["k"], 2)) == [(1, 2, 18)]


def test_coverage_and_windows(spark, spans):
    a, _, da, _ = spans
    got = {(r.k, r.w): r.active for r in windows.coverage(intervals.merge(da, ["k"]), ["k"], 8, 4).collect() if r.active}
    want = {(k, w): int(g[4 * w : 4 * w + 8].sum()) for k, g in painted(a).items() for w in range(20) if g[4 * w : 4 * w + 8].any()}
    assert got == want
    n = spark.createDataFrame([(10000,), (3999,), (4000,)], "n long")
    assert windows.sliding(n, "n", 4000, 2000).groupBy("n").count().orderBy("n").collect() == [(4000, 1), (10000, 4)]


def test_partitioning_changes_nothing(spark, spans):
    _, _, da, db = spans
    before = spark.conf.get("spark.sql.shuffle.partitions")
    got = []
    for n in ("1", "8", "64"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        got.append(rows_of(intervals.subtract(da, db, ["k"])))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got[0] == got[1] == got[2]


def test_suitability_planted(spark):
    seg, energy, calls = [], [], []

    def call(name, labels, channels=2, purity=1.0):
        calls.append((name, channels))
        for label, ch, ms in labels:
            seg.append((name, label, ch, 0, ms))
            energy.append((name, label, ch, purity))
            energy.append((name, label, 3 - ch, 1 - purity))

    call("good", [("a", 1, 9000), ("b", 2, 9000)])
    call("minor", [("a", 1, 9000), ("x", 1, 500), ("b", 2, 9000)])
    call("second", [("a", 1, 9000), ("x", 1, 5000), ("b", 2, 9000)])
    call("one", [("a", 1, 9000)])
    call("quiet", [("a", 1, 9000), ("b", 2, 1000)])
    call("impure", [("a", 1, 9000), ("b", 2, 9000)], purity=0.4)
    call("mono", [("a", 1, 9000)], channels=1)
    call("lost", [("a", 1, 9000)], channels=None)
    calls.append(("empty", 2))
    seg += [("span", "a", 1, 0, 9000), ("span", "a", 2, 0, 9000)]
    calls.append(("span", 2))
    s = spark.createDataFrame(seg, "call string, label string, channel int, start long, end long")
    e = spark.createDataFrame(energy, "call string, label string, channel int, energy double")
    facts = rules.label_facts(s, e)
    got = {r.call: r.reason for r in rules.suitability(facts, spark.createDataFrame(calls, "call string, n_channels int")).collect()}
    assert got == {
        "good": "suitable", "minor": "suitable", "second": "two_speakers_one_channel", "one": "n_channels=1", "quiet": "channel_silent", "impure": "low_purity",
        "mono": "wrong_channel_count", "lost": "no_audio", "empty": "empty_rttm", "span": "speaker_spans_channels",
    }
    cut = rules.minor_spans(s, facts).where("call = 'minor'").collect()
    assert [(r.channel, r.start, r.end) for r in cut] == [(1, 0, 500)]


def test_caps_are_strict_and_refused_calls_do_not_count(spark):
    assert selection.admit([(["a", "b"], [5, 5]), (["a", "c"], [5, 5]), (["a", "d"], [1, 1])], None, 10) == ["kept", "kept", "speaker_duration_cap"]
    assert selection.admit([(["a", "b"], [11, 1]), (["b", "c"], [1, 1])], None, 10) == ["longer_than_duration_cap", "kept"]
    assert selection.admit([(["a", "b"], [1, 1]), (["a", "c"], [1, 1]), (["c", "d"], [1, 1])], 1, None) == ["kept", "speaker_cap", "kept"]
    rng = random.Random(1)
    rows = [(i, [f"a{rng.randrange(9)}", f"b{rng.randrange(30)}"], [rng.randrange(1, 9)] * 2, rng.randrange(50)) for i in range(300)]
    df = spark.createDataFrame(rows, "call int, speakers array<string>, times array<long>, quality long")
    got = {r.call: r.reason for r in selection.cap_admission(df, 20, 60).collect()}
    order = sorted(rows, key=lambda r: (-r[3], r[0]))
    assert got == dict(zip([r[0] for r in order], selection.admit([(r[1], r[2]) for r in order], 20, 60), strict=True))
    assert set(got.values()) >= {"kept", "speaker_duration_cap"}
    assert selection.enabled(0) is None and selection.enabled(-1) is None and selection.enabled(3) == 3


def loop_balance(rows, tol):
    kept = sorted(rows, key=lambda r: (r[2], r[0]))
    while True:
        m, f = (sum(g == x for r in kept for g in r[1]) for x in ("male", "female"))
        if not m + f or abs(m / (m + f) - 0.5) <= tol:
            return {r[0] for r in kept}
        side = "male" if m / (m + f) > 0.5 else "female"
        own = [r for r in kept if all(g == side for g in r[1])]
        if not own:
            return {r[0] for r in kept}
        kept.remove(own[0])


def test_balance_follows_the_loop(spark):
    rng = random.Random(3)
    for n, tol in ((10, 0.02), (40, 0.005), (200, 0.02), (37, 0.001)):
        rows = [(i, [rng.choice(["male", "male", "female", None]) for _ in range(2)], rng.randrange(20)) for i in range(n)]
        df = spark.createDataFrame(rows, "call int, genders array<string>, quality int")
        assert {r.call for r in selection.balance_gender(df, tol).collect()} == loop_balance(rows, tol), (n, tol)


def test_splits_do_not_leak(spark):
    rng = random.Random(4)
    rows = [(i, [f"s{rng.randrange(300)}", f"s{rng.randrange(300)}"]) for i in range(250)]
    df = spark.createDataFrame(rows, "call int, speakers array<string>")
    got = selection.split_by_component(df, {"train": 0.5, "dev": 0.25, "test": 0.25}).collect()
    of = {r.call: r.split for r in got}
    where = {}
    for call, speakers in rows:
        for s in speakers:
            where.setdefault(s, set()).add(of[call])
    assert len(of) == 250 and all(len(x) == 1 for x in where.values())
    made = selection.assign_splits([(i, 1) for i in range(100)], {"train": 0.5, "dev": 0.25, "test": 0.25})
    assert [list(made.values()).count(s) for s in ("train", "dev", "test")] == [50, 25, 25]


def test_components_of_a_chain_and_empty(spark):
    rows = [(i, i + 1) for i in range(60)] + [(100, 101), (None, 5), (7, 7)]
    got = {r.node: r.component for r in graph.connected_components(spark.createDataFrame(rows, "a int, b int")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    assert graph.connected_components(spark.createDataFrame([], "a int, b int")).count() == 0


def test_clusters_by_component_equal_the_global_ones(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(12, 16))
    x = base[rng.integers(0, 12, 60)] + rng.normal(size=(60, 16)) * 0.5
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    groups = np.arange(60) // 2
    for linkage in ("complete", "average"):
        label = clustering.agglomerate((x @ x.T + 1) / 2, groups, 0.8, linkage)
        want = sorted(sorted(np.flatnonzero(label == k).tolist()) for k in set(label))
        df = spark.createDataFrame([(i, int(groups[i]), x[i].tolist()) for i in range(60)], "key int, grp int, vec array<double>")
        got = {}
        for r in clustering.constrained_clusters(df, 0.8, linkage).collect():
            got.setdefault(r.speaker, []).append(r.key)
        assert sorted(sorted(v) for v in got.values()) == want
        assert got["spk00001"] and len(got["spk00001"]) == max(map(len, want))


def test_blocks_give_all_pairs(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(50, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, i // 2, i % 2, x[i].tolist()) for i in range(50)], "key int, grp int, channel int, vec array<double>")
    sim = (x @ x.T + 1) / 2
    want = sorted((i, j) for i in range(50) for j in range(i + 1, 50) if sim[i, j] > 0.7 and i // 2 != j // 2)
    for block in (7, 4096):
        assert sorted((r.a, r.b) for r in similarity.edges(df, 0.7, block).collect()) == want
        assert similarity.histogram(df, 6, block).agg({"n": "sum"}).first()[0] == 50 * 49 // 2


def test_votes_and_rollup(spark):
    v = spark.createDataFrame([(1, "m", 2.0), (1, "f", 2.0), (2, "m", 0.0)], "k int, label string, w double")
    got = {r.k: (r.label, r.confidence, r.mixed) for r in votes.vote(v, ["k"], "label", v["w"]).collect()}
    assert got == {1: ("f", 0.5, True), 2: ("m", 0.0, False)}
    rows = spark.createDataFrame([(1, None, "train", 3600.0, ["a", "b"]), (1, 0, "train", 3600.0, ["a", "b"]), (2, None, "odd", 3600.0, ["c", "d"])], "call int, variant int, split string, duration double, speakers array<string>")
    chunks = spark.createDataFrame([("train",)], "split string")
    got = {r.split: (r.rows, r.calls, r.hours, r.clean_hours, r.speakers, r.chunks) for r in manifest.split_rollup(rows, chunks, ["train", "dev"]).collect()}
    assert got == {"train": (2, 1, 2.0, 1.0, 2, 1), "dev": (0, 0, 0.0, 0.0, 0, 0), "odd": (1, 1, 1.0, 1.0, 2, 0)}


def test_audits_find_what_is_planted(spark):
    rows = spark.createDataFrame([(1, None, "train", ["a", "b"], ["male", "male"]), (2, None, "dev", ["a", "c"], ["male", "male"]), (2, 0, "dev", ["a", "c"], ["male", "male"])], "call int, variant int, split string, speakers array<string>, genders array<string>")
    assert [r.key for r in audit.leaks(rows).collect()] == ["a"]
    sides = spark.createDataFrame([(1, "a", 5), (1, "b", 5), (2, "a", 5), (2, "c", 5)], "call int, speaker string, ms long")
    assert [(r.check, r.key) for r in audit.caps(rows, sides, 2, 9).collect()] == [("duration_cap", "a")]
    assert audit.gender_share(rows).count() == 1
    full = rows.where("variant is null").select("call", "split")
    assert audit.partition_of(full, full, "call").count() == 0


def test_numbers_are_dense_in_order(spark):
    from twinline.operators import windows

    df = spark.range(500).selectExpr("id", "id % 7 as k").repartition(6)
    got = sorted((r.rn, -r.k, r.id) for r in windows.numbered(df, [F.desc("k"), F.col("id")]).collect())
    assert [g[0] for g in got] == list(range(1, 501)) and [g[1:] for g in got] == sorted(g[1:] for g in got)


def test_many_small_components_follow_the_targets(spark):
    calls = spark.range(30000).selectExpr("id as call", "array(id, id + 1000000) as speakers")
    n = {r.split: r["count"] for r in selection.split_by_component(calls, {"train": 0.6, "dev": 0.3, "test": 0.1}).groupBy("split").count().collect()}
    assert abs(n["train"] - 18000) < 400 and abs(n["dev"] - 9000) < 400 and abs(n["test"] - 3000) < 300


def test_stale_files_are_told_by_the_selection(spark):
    from twinline.operators import manifest

    found = spark.createDataFrame([("train", 1, None), ("train", 1, 0), ("train", 1, 2), ("dev", 2, None), ("dev", 2, 0), ("chunks", 9, None)], "split string, call long, variant int")
    selected = spark.createDataFrame([(1,), (1,), (3,)], "call long")
    kept = spark.createDataFrame([(1, None), (1, 0)], "call long, variant int")
    got = {(r.split, r.call, r.variant, r.what) for r in manifest.stale(found, selected, kept).collect()}
    assert got == {("train", 1, 2, "variant"), ("dev", 2, None, "call"), ("dev", 2, 0, "call")}


def test_guards_before_work(spark):
    from twinline.operators import manifest

    calls = spark.createDataFrame([(1, 10.0, [2.0, None], 2), (2, 8.0, [0.0, 0.0], 2), (3, None, None, 1)], "call long, duration double, speech array<double>, channels int")
    assert manifest.work_estimate(calls, 4.0).first()[:] == (3, 10.0, 2.5)
    assert manifest.work_estimate(calls, 4.0, full=True).first()[:] == (3, 36.0, 9.0)
    assert manifest.work_estimate(calls.limit(0), 4.0).first()[:] == (0, 0.0, 0.0)
    cached = spark.createDataFrame([(1, 24000), (2, 8000)], "call long, rate int")
    faults = lambda *a, **k: {(r.fault, r.n, r.example) for r in manifest.rate_faults(calls, cached, *a, **k).collect()}
    assert faults(24000, 8000, 24000) == {("not cached", 1, 3), ("other rate", 1, 2)}
    assert faults(24000, 8000, None, summed=True) >= {("marked otherwise", 3, 1), ("sum of targets", 3, 1)}
    assert faults(8000, 8000, None) == set()


def test_clusters_from_pairs_equal_those_from_a_matrix():
    rng = np.random.default_rng(8)
    for trial in range(60):
        n = int(rng.integers(0, 40))
        x = rng.normal(size=(n, 3))
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
        groups = rng.integers(0, max(1, n // 2), n)
        sim = np.round((x @ x.T + 1) / 2, 1 if trial % 2 else 12)  # every other time full of ties
        i, j = np.nonzero(np.triu(sim > 0.65, 1) & (groups[:, None] != groups[None, :]))
        got = clustering.agglomerate_pairs(n, iter([(i, j, sim[i, j])]))
        assert got.tolist() == clustering.agglomerate(sim, groups, 0.65).tolist()
        found = sorted((a, b) for p in clustering.close_pairs(x, groups, 0.65, 7) for a, b in zip(p[0].tolist(), p[1].tolist(), strict=True))
        exact = (x @ x.T + 1) / 2
        assert found == sorted((a, b) for a in range(n) for b in range(a + 1, n) if exact[a, b] > 0.65 and groups[a] != groups[b])


def test_caps_in_rounds_follow_the_loop(spark):
    """Hubs, chains, ties, speakers that stand twice in a call and calls longer than the cap: the same with rounds, some rounds or none."""
    rng = random.Random(8)
    rows = [(i, [f"a{rng.randrange(5)}", f"b{rng.randrange(40)}"], [rng.randrange(1, 12) for _ in range(2)], float(rng.randrange(20))) for i in range(400)]
    rows += [(1000 + i, [f"c{i}", f"c{i + 1}"], [5, 5], 90.0 - i) for i in range(40)]
    rows += [(2000 + i, ["a1", "a2", "d", "d"], [rng.randrange(1, 14) for _ in range(4)], float(rng.randrange(20))) for i in range(30)]
    order = sorted(rows, key=lambda r: (-r[3], r[0]))
    df = spark.createDataFrame(rows, "call int, speakers array<string>, times array<long>, quality double")
    for caps in ((20, 10), (1, None), (6, 40), (None, 60)):
        want = dict(zip([r[0] for r in order], selection.admit([(r[1], r[2]) for r in order], *caps), strict=True))
        for how in ({"few": 0, "turns": 100} if caps == (6, 40) else {"few": 0, "turns": 3}, {}):
            assert {r.call: r.reason for r in selection.cap_admission(df, *caps, **how).collect()} == want


def test_caps_need_no_group_in_memory(spark, monkeypatch):
    """No step takes all calls of a component as one pandas table."""
    monkeypatch.setattr(type(spark.range(1).groupBy()), "applyInPandas", lambda *a: 1 / 0)
    df = spark.createDataFrame([(1, ["a", "b"], [5, 5], 2), (2, ["a", "c"], [6, 6], 1)], "call int, speakers array<string>, times array<long>, quality long")
    assert {r.call: r.reason for r in selection.cap_admission(df, 5, 10).collect()} == {1: "kept", 2: "speaker_duration_cap"}
