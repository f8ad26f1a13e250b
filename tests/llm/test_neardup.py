import random
from collections import Counter

import numpy as np
from twinline.llm import hashing, neardup


def bag(text, n=5):
    folded = "".join(c if c.isalnum() and c.isascii() or ord(c) > 127 else " " for c in text.lower())
    w = folded.split()
    return Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else Counter([tuple(w)] if w else [])


def jaccard(a, b):
    x, y = bag(a), bag(b)
    return sum((x & y).values()) / max(1, sum((x | y).values()))


def brute_classes(docs):
    """First id of each class: union of all pairs of texts that are equal or similar."""
    bags = [bag(t) for _, t in docs]
    up = list(range(len(docs)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            n, m = sum(bags[i].values()), sum(bags[j].values())
            if docs[i][1] == docs[j][1] or (n and m and min(n, m) >= 0.8 * max(n, m) and sum((bags[i] & bags[j]).values()) >= 0.8 * sum((bags[i] | bags[j]).values())):
                a, b = sorted((top(i), top(j)))
                up[b] = a
    return {d: docs[top(i)][0] for i, (d, _) in enumerate(docs)}


def test_signatures_estimate_weighted_jaccard():
    rng = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    base = [rng.choice(words) for _ in range(600)]
    for swaps in (5, 20, 60):
        other = list(base)
        for _ in range(swaps):
            other[rng.randrange(600)] = "changed"
        texts = [" ".join(base), " ".join(other)]
        el, own = hashing.shingle_elements(texts)
        sig = neardup.signatures(el, own, 2, 2048)
        want = jaccard(*texts)
        assert abs((sig[0] == sig[1]).mean() - want) < 0.05
        assert abs(neardup.similar(texts[:1], texts[1:], 5)[0] - want) < 1e-12


def test_fractional_weights():
    el = np.arange(2000, dtype=np.uint64)
    el = hashing.mix(np.concatenate([el, el]))
    own = np.repeat([0, 1], 2000)
    w = np.concatenate([np.full(2000, 0.9), np.full(2000, 0.45)])
    sig = neardup.signatures(el, own, 2, 2048, w)
    assert abs((sig[0] == sig[1]).mean() - 0.5) < 0.05


def test_op9_matches_brute_force(spark, sf, documents):
    got = {r.doc_id: r.class_id for r in neardup.op9_neardup(spark, sf).collect()}
    assert got == brute_classes([(r["doc_id"], r["text"] or "") for r in documents])


def test_star_and_chain_of_copies(spark, tmp_path):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    base = [word() for _ in range(300)]
    rows = [(0, " ".join(base))]
    for i in range(1, 40):  # each near the centre, few near each other
        t = list(base)
        for _ in range(6):
            t[rng.randrange(300)] = word()
        rows.append((i, " ".join(t)))
    chain = [word() for _ in range(300)]
    for i in range(100, 120):  # each near its neighbours only
        for _ in range(6):
            chain[rng.randrange(300)] = word()
        rows.append((i, " ".join(chain)))
    rows += [(200 + i, " ".join(word() for _ in range(50))) for i in range(20)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.class_id for r in neardup.op9_neardup(spark, str(tmp_path)).collect()}
    assert got == brute_classes(rows)


def test_awkward_table(spark, awkward, empty):
    assert neardup.keep_first(empty).count() == 0
    out = neardup.keep_first(awkward)
    assert out.columns == awkward.columns
    rows = out.collect()
    assert [r.doc_id for r in rows if r.text == "one two three four five six seven"] == [None]
    assert {r.doc_id for r in rows} >= {1, 2, 6, 7, 8, 10, 11, 12, 13}
    assert sum(r.text in (None, "") for r in rows) == 1  # null counts as empty


def test_weights_above_one_are_layers():
    el = hashing.mix(np.arange(600, dtype=np.uint64))
    both, own = np.concatenate([el, el]), np.repeat([0, 1], 600)
    sig = neardup.signatures(both, own, 2, 2048, np.concatenate([np.full(600, 3.0), np.full(600, 1.5)]))
    assert abs((sig[0] == sig[1]).mean() - 0.5) < 0.05


def test_small_tasks_and_differences_lose_no_class(spark, sf, documents):
    """Few members a task, and members dealt by their differences: the same classes as with one task."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    rows = [(r["doc_id"], r["text"] or "") for r in documents]
    for g in range(3):  # groups around a base that is not among them, some members alike
        base = [word() for _ in range(200)]
        for i in range(30):
            t = list(base)
            for _ in range(7):
                t[rng.randrange(200)] = word()
            rows.append((10**6 + 100 * g + i, " ".join(t)))
            if i % 5 == 0:
                t[rng.randrange(200)] = word()
                rows.append((10**6 + 100 * g + 50 + i, " ".join(t)))
    want = brute_classes(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for how in ({}, {"limit": 8}, {"limit": 8, "wide": 8}):
        assert {r.d: r.cd for r in neardup.classes(docs, **how).collect()} == want


def test_links_within_a_group_are_exact():
    rng = np.random.default_rng(3)
    centre = np.unique(rng.integers(0, 2**63, 300, dtype=np.uint64))
    sets = [np.unique(np.concatenate([rng.choice(centre, 260, replace=False), rng.integers(0, 2**63, 20, dtype=np.uint64)])) for _ in range(12)]
    sets += [np.unique(np.append(s[:-3], rng.integers(0, 2**63, 3, dtype=np.uint64))) for s in sets[:6]]
    v = [bytes([i]) for i in range(len(sets))]
    d = [np.setxor1d(centre, s).tobytes() for s in sets]
    want = {(v[i], v[j]) for i in range(len(v)) for j in range(i + 1, len(v)) if len(np.intersect1d(sets[i], sets[j])) >= 0.8 * len(np.union1d(sets[i], sets[j]))}
    assert set(neardup.links_in(v, v, [len(s) for s in sets], d, 0.8, columns=64)) == want and len(want) >= 6
    assert neardup.links_in(v, [b"c"] * len(v), [len(s) for s in sets], d, 0.8) == []


def test_recall_against_all_rows(spark):
    """Every pair at 0.8 or more between documents with ids divisible by 50 and all others: nine of ten share a class."""
    sf = "/root/testdata/sf0.1"
    rows = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    got = {r.doc_id: r.class_id for r in neardup.op9_neardup(spark, sf).collect()}
    el, own = hashing.shingle_elements([t for _, t in rows])
    size = np.bincount(own, minlength=len(rows))
    order = np.argsort(el, kind="stable")
    el, own = el[order], own[order]
    starts = np.searchsorted(el, el, "left")
    ends = np.searchsorted(el, el, "right")
    true = found = 0
    for i in (i for i, (d, _) in enumerate(rows) if d % 50 == 0 and size[i]):
        mine = np.flatnonzero(own == i)
        common = np.bincount(np.concatenate([own[a:b] for a, b in zip(starts[mine], ends[mine], strict=True)]), minlength=len(rows))
        near = np.flatnonzero((common >= 0.8 * (size + size[i] - common)) & (np.arange(len(rows)) != i))
        true += len(near)
        found += sum(got[rows[j][0]] == got[rows[i][0]] for j in near)
    assert true > 50 and found >= 0.9 * true


def test_links_do_not_depend_on_how_many_members_a_centre_has(spark):
    """Members near the centre and far from it, that share next to none of their differences, are linked however they are dealt."""
    rng = np.random.default_rng(6)
    rows, sets = [], []
    centre = np.unique(rng.integers(0, 2**63, 300, dtype=np.uint64))
    for i in range(24):  # y lacks one element of the centre, x that one and 54 others: similar to each other, x not to the centre
        cut = rng.permutation(300)
        y, x = np.delete(centre, cut[:1]), np.delete(centre, cut[:55])
        x = np.union1d(x, rng.integers(0, 2**63, 7, dtype=np.uint64))
        sets += [y, x]
        rows += [(5, bytes([0, i]), b"home", len(y), np.setxor1d(centre, y).tobytes()), (5, bytes([1, i]), bytes([1, i]), len(x), np.setxor1d(centre, x).tobytes())]
    alike = lambda a, b: len(np.intersect1d(a, b)) >= 0.8 * len(np.union1d(a, b))
    want = {(rows[i][1], rows[j][1]) for i in range(48) for j in range(48) if rows[i][1] < rows[j][1] and rows[i][2] != rows[j][2] and alike(sets[i], sets[j])}
    members = spark.createDataFrame(rows, "k long, v binary, c binary, n long, d binary")
    for limit, wide in ((2048, 32768), (8, 100), (8, 8), (8, 1)):
        got = [(bytes(r.a), bytes(r.b)) for r in neardup.links_within(members, 0.8, limit, wide).collect()]
        assert set(got) == want and len(got) == len(want) >= 24
