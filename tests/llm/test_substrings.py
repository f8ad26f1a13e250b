"""Exact substrings and chunks against brute force."""

import hashlib
import random

import numpy as np
import pytest

from twinline.llm import chunks, suffix


def brute_windows(docs, length=100):
    """doc index -> covered byte ranges by the definition, one dictionary over all windows."""
    seen, out = set(), []
    for raw in docs:
        covered = np.zeros(len(raw) + 1, np.int64)
        for i in range(len(raw) - length + 1):
            w = raw[i : i + length]
            if w in seen:
                covered[i] += 1
                covered[i + length] -= 1
            seen.add(w)
        out.append(np.cumsum(covered)[: len(raw)] > 0)
    return out


def digest(raw, mask):
    kept = bytes(np.frombuffer(raw, np.uint8)[~mask])
    edges = np.diff(np.concatenate([[0], mask.astype(int), [0]]))
    return int(mask.sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("alphabet", [1, 2, 5])
@pytest.mark.parametrize("n", [1, 2, 7, 60, 900])
def test_suffix_array_is_sorted(alphabet, n):
    rng = random.Random(n * 10 + alphabet)
    data = np.array([97 + rng.randrange(alphabet) for _ in range(n)], np.uint8)
    raw = data.tobytes()
    assert suffix.suffix_array(data, n + 8).tolist() == sorted(range(n), key=lambda i: raw[i:])
    near = suffix.suffix_array(data, 16)
    assert sorted(near.tolist()) == list(range(n))
    assert all(raw[x : x + 16] <= raw[y : y + 16] for x, y in zip(near, near[1:], strict=False))


def test_equal_windows_have_equal_anchors():
    rng = random.Random(3)
    passage = bytes(rng.randrange(97, 120) for _ in range(180))
    texts = [bytes(rng.randrange(97, 120) for _ in range(rng.randrange(0, 90))) + passage for _ in range(4)]
    owner, start, count, anchor, _, _ = suffix.segments_of(texts)
    by = {}
    for o, s, c, a in zip(owner, start, count, anchor, strict=True):
        for i in range(s, s + c):
            by.setdefault(texts[o][i : i + 100], set()).add(a)
    assert all(len(x) == 1 for x in by.values())
    assert sum(len(t) - 99 for t in texts) == count.sum()


def test_op7_matches_brute_force(spark, sf, documents):
    got = {r.doc_id: r for r in suffix.op7_suffix(spark, sf).collect()}
    raws = [(r["text"] or "").encode() for r in documents]
    assert len(got) == len(documents)
    for r, raw, mask in zip(documents, raws, brute_windows(raws), strict=True):
        g = got[r["doc_id"]]
        assert (g.n_bytes, g.n_removed, g.n_spans, g.kept_sha256) == (len(raw), *digest(raw, mask))


def test_op7_salted_blocks_and_hot_anchor(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(suffix, "BLOCK_SEGMENTS", 3)
    monkeypatch.setattr(suffix, "BLOCK_BYTES", 500)
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    passage = " ".join(word() for _ in range(30))
    rows = [(i, " ".join(word() for _ in range(rng.randrange(0, 12))) + passage + word() * rng.randrange(0, 5)) for i in range(40)]
    rows += [(100 + i, "ab" * 300) for i in range(3)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in suffix.op7_suffix(spark, str(tmp_path)).collect()}
    raws = [t.encode() for _, t in rows]
    for (d, _), raw, mask in zip(rows, raws, brute_windows(raws), strict=True):
        assert (got[d].n_bytes, got[d].n_removed, got[d].n_spans, got[d].kept_sha256) == (len(raw), *digest(raw, mask))


def test_substring_edge_cases(spark, awkward, empty):
    for f in (suffix.dedup_substrings, chunks.dedup_chunks):
        assert f(empty).count() == 0
        out = f(awkward)
        assert out.columns == awkward.columns
        rows = out.collect()
        assert len(rows) == awkward.count()
        by = {(r.doc_id, r.source): r.text for r in rows}
        assert by[3, "s2"] is None and by[4, "s2"] == "" and by[6, "s1"] == "x"
        first = next(r for r in rows if r.doc_id == 1).text
        assert "shared30" in first
        assert "shared30" not in next(r for r in rows if r.doc_id == 2).text
        assert len({r.text for r in rows if r.doc_id == 5 and r.source == "s3"}) == 1


def brute_chunks(texts):
    seen, out = set(), []
    for t in texts:
        raw = t.encode()
        ends = chunks.chunk_ends(raw)
        spans, last = [], 0
        for e in ends:
            if raw[last:e] in seen:
                if spans and spans[-1][1] == last:
                    spans[-1][1] = e
                else:
                    spans.append([last, e])
            seen.add(raw[last:e])
            last = e
        out.append([(a, b) for a, b in spans if b - a >= chunks.RUN])
    return out


def test_op5_matches_brute_force(spark, sf, documents):
    got = {r.doc_id: r for r in chunks.op5_chunks(spark, sf).collect()}
    want = brute_chunks([r["text"] or "" for r in documents])
    for r, spans in zip(documents, want, strict=True):
        assert [(s.start, s.end) for s in got[r["doc_id"]].spans] == spans
        assert got[r["doc_id"]].n_removed == sum(b - a for a, b in spans)


def test_chunks_resist_insertions():
    rng = random.Random(1)
    text = "".join(rng.choice("abcdefghij é") for _ in range(20000))
    pieces = lambda t: [t.encode()[a:b] for a, b in zip([0, *chunks.chunk_ends(t.encode())], chunks.chunk_ends(t.encode()), strict=False)]
    old, new = pieces(text), pieces(text[:777] + "inserted" + text[777:])
    assert b"".join(old) == text.encode()
    assert len(set(old) - set(new)) <= 6
    assert all(chunks.MIN <= len(p) <= chunks.MAX for p in old[:-1])
    assert all(p.decode() is not None for p in old)
