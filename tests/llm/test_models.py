"""The learned operators: held-out accuracy, exact counts, proper probabilities."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from twinline.llm import lm, toxicity


def test_chain_on_held_out_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").toPandas()
    rows = rows.sort_values("doc_id").drop_duplicates("text")
    made = [toxicity.features_of(t) for t in rows["text"]]
    ids, surface = [m[0] for m in made], np.array([m[1] for m in made])
    y = np.stack([1 - rows["quality"], rows["toxic"]], 1)
    test = (rows["doc_id"] % 3 == 0).to_numpy()
    pick = lambda x, m: [v for v, ok in zip(x, m, strict=True) if ok]
    chain = toxicity.fit(pick(ids, ~test), surface[~test], y[~test], (rows["doc_id"] % 5).to_numpy()[~test], ("low_quality", "toxic"))
    p = chain.predict(pick(ids, test), surface[test])
    for k in (0, 1):
        said, true = p[:, k] >= 0.5, y[test][:, k] == 1
        assert (said & true).sum() >= 0.9 * true.sum()
        assert (said & ~true).sum() <= 0.02 * (~true).sum()


def test_later_models_see_earlier_categories():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, toxicity.SURFACE))
    first = (x[:, 0] > 0).astype(int)
    chain = toxicity.fit([np.zeros(0, np.int32)] * 400, x, np.stack([first, first], 1), np.arange(400) % 5, ("a", "b"))
    assert len(chain.weights[1]) == len(chain.weights[0]) + 1 and chain.weights[1][-2] > 0
    assert (chain.predict([np.zeros(0, np.int32)] * 400, x).round() == np.stack([first, first], 1)).mean() > 0.95


def test_toxicity_awkward(spark, awkward, empty):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (2, None, None), (None, 1, 1), (77, 0, 1), (7, 1, 0)], "doc_id long, quality int, toxic int")
    chain = toxicity.train(awkward, labels)
    out = toxicity.score(awkward, chain).collect()
    assert len(out) == awkward.count() and all(0 <= r["__tox"].p_toxic <= 1 for r in out)
    none = toxicity.train(awkward, labels.limit(0))
    assert toxicity.remove_toxic(awkward, none).columns == awkward.columns and toxicity.remove_toxic(awkward, none).count() == awkward.count()
    assert toxicity.remove_toxic(empty, chain).count() == 0
    assert toxicity.train(empty, labels).weights == []


def test_folds_see_nothing_of_what_they_hold_out():
    """Random words and labels: out-of-fold probabilities of the first category must not give the second away."""
    rng = np.random.default_rng(4)
    ids = [np.unique(rng.integers(0, 4000, 40)).astype(np.int32) for _ in range(600)]
    y = (rng.random(600) < 0.3).astype(int)
    chain = toxicity.fit(ids, rng.normal(size=(600, toxicity.SURFACE)), np.stack([y, y], 1), np.arange(600) % 5, ("a", "b"))
    assert chain.weights[1][-2] < 1  # of the earlier category; labels that leak through chosen words make it large


def test_rare_label_keeps_its_share_under_the_bound():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(3000, toxicity.SURFACE))
    y = (x[:, 0] + rng.normal(size=3000) > 1.8).astype(int)
    some = np.flatnonzero((y == 1) | (rng.random(3000) < 0.2))
    weight = np.where(y[some] == 1, 1.0, 5.0)
    fit = lambda at, w: toxicity.fit([np.zeros(0, np.int32)] * len(at), x[at], y[at][:, None], np.arange(len(at)) % 5, ("a",), weight=w)
    every, few, plain = fit(np.arange(3000), None), fit(some, weight), fit(some, None)
    none = [np.zeros(0, np.int32)] * 3000
    assert abs(few.predict(none, x).mean() - every.predict(none, x).mean()) < 0.02 < plain.predict(none, x).mean() - every.predict(none, x).mean()


def test_toxicity_query(spark):
    """The registered query catches what the labels call toxic and leaves the rest alone; no row is lost."""
    sf = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in toxicity.op1_toxicity(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id").collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert set(got) == {r.doc_id for r in docs} and all(r.toxic == (r.p_toxic >= 0.5) for r in got.values())
    said = lambda v: [got[d].toxic for d, t in labels.items() if t == v and d in got]
    assert sum(said(1)) >= 0.9 * len(said(1)) and sum(said(0)) <= 0.02 * len(said(0))


@pytest.fixture(scope="module")
def scored(spark, sf):
    return lm.op3_lm(spark, sf).toPandas().set_index("doc_id")


def test_base_scores_are_exact(scored, documents):
    held = lambda d: zlib.crc32(str(d).encode()) % 7 == 2
    words = {r["doc_id"]: [*r["text"].encode().lower().split(), b""] for r in documents}
    c = Counter(w for d, ws in words.items() if not held(d) for w in ws)
    n, v = sum(c.values()), len(c)
    for d, ws in words.items():
        r = scored.loc[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(d), len(ws), sum(c[w] > 0 for w in ws), n)
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)


def test_probabilities_are_normalised_and_learned(scored):
    held = scored[scored.held_out]
    assert np.isfinite(held.score).all() and (held.score < 0).all()
    lex = lm.Lexicon({b"": 0, b"a": 1, b"b": 2}, np.array([5, 9, 4]), 30, 8, 3)
    m = lm.Model.fresh(lex.unigrams())
    assert np.allclose(np.exp(m.log_probs(np.array([4, 1]), np.array([4, 2]))).sum(1), 1)
    n, v = lex.other_mass()
    assert (n, v) == (12, 5)


def test_noise_contrast_finds_a_rule():
    rng = np.random.default_rng(1)
    w1 = rng.integers(0, 20, 60000)
    w = (w1 * 7 + 3) % 20
    p = np.full(20, 1 / 20)
    m = lm.Model.fresh(np.full(20, 100.0), dim=16)
    for i in range(3):
        m = lm.train_share(m, *lm.weighted(w1, np.full(60000, 20), w, 21, often=1), p, 0.1, i)
    lp = m.log_probs(np.arange(20), np.full(20, 20))
    assert (lp.argmax(1) == (np.arange(20) * 7 + 3) % 20).all() and lp.max(1).mean() > -0.7


def test_lm_awkward(spark, awkward, empty):
    rows = lm.score(awkward.select("doc_id", "text")).collect()
    assert len(rows) == awkward.count() and all(r.score <= 0 and math.isfinite(r.score) for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (3, 4, 11)} == {1}
    assert lm.score(empty.select("doc_id", "text")).count() == 0


def test_vocabulary_grows_with_the_corpus(spark):
    rows = [(b"", 1000)] + [(f"w{i}".encode(), 50 if i < 3000 else 1) for i in range(4000)]
    lex = lm.lexicon(spark.createDataFrame(rows, "token binary, c long"))
    assert lm.least_count(lex.total) <= 50 and lex.vocab == 3001 and lex.other_mass() == (1000, 1000)
    assert [lm.least_count(n) for n in (10**4, 10**6, 10**8, 10**10)] == [5, 20, 200, 2000]
    more = lm.lexicon(spark.createDataFrame(rows, "token binary, c long"), head=10)
    assert more.vocab == 3001 and len(more.index) == 3001


def test_classes_and_words_make_one_distribution():
    rng = np.random.default_rng(2)
    for n in (1, 2, 20, 700):
        m = lm.Model.fresh(np.sort(rng.integers(1, 5000, n))[::-1].astype(float))
        m = m.like(m.flat() + rng.normal(0, 0.3, len(m.flat())).astype(np.float32))
        w1, w2, w = rng.integers(0, n + 1, 300), rng.integers(0, n + 1, 300), rng.integers(0, n, 300)
        lp = m.log_probs(w1, w2)
        assert np.allclose(np.exp(lp).sum(1), 1, atol=1e-5)
        assert np.allclose(m.log_prob(w1, w2, w, rows=7), lp[np.arange(300), w], atol=1e-4)


def test_held_out_scores_are_clearly_better_than_the_base(spark):
    """A gain of a tenth of a decade a token and more over the unigrams, on documents that nothing was learned from."""
    rows = lm.op3_lm(spark, "/root/testdata/sf0.01").toPandas()
    held = rows[rows.held_out]
    assert (held.score.sum() - held.base_score.sum()) / held.n_tokens.sum() > 0.1


def test_scores_by_brute_force(spark, documents, monkeypatch):
    """Scores from tables of all words of the fitted model, one token at a time."""
    some = documents[:60]
    kept = {}
    fit = lm.fit
    monkeypatch.setattr(lm, "fit", lambda texts, lex: kept.setdefault("model", (lex, fit(texts, lex)))[1])
    df = spark.createDataFrame([(r["doc_id"], r["text"]) for r in some], "doc_id long, text string")
    got = {r.doc_id: r.score for r in lm.score(df, least=4, head=40).collect()}
    lex, m = kept["model"]
    held = lambda d: zlib.crc32(str(d).encode()) % 7 == 2
    words = {r["doc_id"]: [*r["text"].encode().lower().split(), b""] for r in some}
    c = Counter(w for d, ws in words.items() if not held(d) for w in ws)
    inside = {w: i for w, i in lex.index.items() if i < lex.vocab}
    n = sum(v for w, v in c.items() if w not in inside)
    v = len(c) - len(inside)
    for d, ws in words.items():
        ids, total = [inside.get(w, lex.other) for w in ws], 0.0
        for i, w in enumerate(ws):
            w1, w2 = ids[i - 1] if i > 0 else lex.begin, ids[i - 2] if i > 1 else lex.begin
            q = m.r[w1] @ m.c[0] + m.r[w2] @ m.c[1]
            g = m.groups()
            part = np.flatnonzero(g == g[ids[i]])
            top, low = np.exp(q @ m.u.T + m.a), np.exp(q @ m.q[part].T + m.b[part])
            total += math.log10(top[g[ids[i]]] / top.sum()) + math.log10(low[ids[i] - part[0]] / low.sum())
            total += math.log10((c[w] + 1) / (n + v + 1)) if w not in inside else 0.0
        assert math.isclose(got[d], total, rel_tol=1e-4), d


def test_examples_are_counted_whole():
    rng = np.random.default_rng(7)
    w1, w2, w = (rng.integers(0, 6, 5000) for _ in range(3))
    *parts, weight = lm.weighted(w1, w2, w, 7, often=9)
    assert weight.max() <= 9 and math.isclose(weight.sum(), 5000, rel_tol=1e-6)
    sums = Counter()
    for a, b, c, x in zip(*parts, weight, strict=True):
        sums[int(a), int(b), int(c)] += float(x)
    assert {k: round(v) for k, v in sums.items()} == Counter(zip(w1.tolist(), w2.tolist(), w.tolist(), strict=True))


def test_rounds_share_all_positions():
    d, sizes = np.array([5, -3, 0, 77]), np.array([1, 2, 40, 7])
    for rounds in (1, lm.ROUNDS, 5):
        used = np.concatenate([lm.chosen(d, sizes, i, rounds) for i in range(rounds)])
        assert sorted(used) == list(range(50))


def test_words_counted_and_looked_up_in_arrow(spark):
    """Counts that leave a worker a few words at a time, places in the head, and ids stored as bytes, against Python's own."""
    texts = [None, "", " a  b\tA ", "b\nc \x0b d", "Ünï a É é b", "a " * 50 + "z", "\x0c\r ", "x"] + [f"w{i} w{i % 7} a" for i in range(40)]
    df = spark.createDataFrame([(None if i == 3 else i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    words = lambda t: [w for w in re.split(rb"[\x20\x09-\x0D]+", (t or "").encode().lower()) if w]
    held = lambda i: zlib.crc32(b"" if i == 3 else str(i).encode()) % 7 == 2
    want = Counter(w for i, t in enumerate(texts) if not held(i) for w in [*words(t), b""])
    for flush in (1, 5, 10**6):
        assert {bytes(r.token): r.c for r in lm.word_counts(df, flush).collect()} == want
    assert lm.word_counts(df.where("doc_id = 8").where(lm.held_out())).count() == 0
    lex = lm.lexicon(lm.word_counts(df), least=3, head=4)
    assert list(lex.index.values()) == list(range(len(lex.index))) and len(lex.index) < len(want)
    for index in (lex.index, {}):
        some = lm.Lexicon(index, lex.counts, lex.total, lex.distinct, lex.vocab)
        table = lm.encoded(df, some)
        assert dict(table.dtypes)["ids"] == "binary"
        got = sorted((np.frombuffer(r.ids, np.int32).tolist(), [bytes(w) for w in r.rare]) for r in table.collect())
        assert got == sorted(([index.get(w, -1) for w in [*words(t), b""]], [w for w in words(t) if w not in index]) for t in texts)
