"""Exact repeated substrings by suffix arrays (two-stage sorting) over routed segments.

A byte is removed if it lies in a string of LENGTH bytes that also starts
earlier. No machine sorts the corpus: in every window of LENGTH bytes the least
hash of its GRAM-byte strings is its anchor, so equal windows have equal
anchors. Windows in a row with the same anchor form a segment. Segments whose
anchor is alone are done; equal segments are compared by digest; different
segments with the same anchor meet in one block, whose suffix array finds their
common strings of LENGTH bytes.

The array is built in two stages: suffixes smaller than their successors are
sorted directly (eight bytes at a time), all others are induced by a scan over
the buckets of first bytes. Adjacent prefixes are then compared; neighbours
that share LENGTH bytes form a group, and all but its first start are marked.

An anchor with very many different segments is dealt over salted blocks; the
distinct windows of such blocks are then compared by digest. So no task gets an
unbounded group, and counts and minima combine before each shuffle.

Defined results: null is the empty text; nothing is removed from texts of less
than LENGTH bytes; a null doc_id sorts first; rows that share doc_id and text
are one document; an empty table gives an empty result; extra columns pass
through.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_key, materialize, text_of
from .hashing import batches_of, mix, range_hashes, table

LENGTH, GRAM = 100, 32
#: Different segments of one anchor in a block, and bytes sorted at once.
BLOCK_SEGMENTS, BLOCK_BYTES = 2_000, 400_000
#: Bytes of text hashed at once: arrays of eight times as many stay in a processor's cache.
HASHED_BYTES = 150_000
SEPARATOR = 0xFF  # in no UTF-8 text


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place as a big-endian number; zeros after the end."""
    padded = np.zeros(len(data) + 8, np.uint64)
    padded[: len(data)] = data
    w, width = padded, 1
    while width < 8:
        shifted = np.zeros_like(w)
        shifted[:-width] = w[width:]
        w = (w << np.uint64(8 * width)) | shifted
        width *= 2
    return w[: len(data)]


def smaller_than_successor(data: np.ndarray) -> np.ndarray:
    """For each suffix: is it smaller than the next one? (the last isn't)"""
    n = len(data)
    rising = np.zeros(n, np.int8)
    rising[:-1] = np.sign(data[1:].astype(np.int16) - data[:-1])
    rising[-1] = -1
    settled = np.where(rising != 0, np.arange(n), n)
    settled = np.minimum.accumulate(settled[::-1])[::-1]
    return rising[settled] > 0


def suffix_array(data: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in order of at least their first ``depth`` bytes."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    small = smaller_than_successor(data)
    w = np.concatenate([words_at(data), np.zeros(depth + 16, np.uint64)])
    # stage one: sort those smaller than their successors, eight bytes at a time where tied
    order = np.flatnonzero(small)
    order = order[np.argsort(w[order], kind="stable")]
    group = np.zeros(len(order), np.int64)
    if len(order):
        group[1:] = np.cumsum(w[order][1:] != w[order][:-1])
    tied, at = np.arange(len(order)), 8
    while at < depth and len(tied):
        g = group[tied]
        again = np.zeros(len(tied), bool)
        same = g[1:] == g[:-1]
        again[1:] |= same
        again[:-1] |= same
        tied, g = tied[again], g[again]
        if not len(tied):
            break
        key = w[order[tied] + at]
        by = np.lexsort((key, g))
        order[tied], key = order[tied][by], key[by]
        new = np.ones(len(tied), bool)
        new[1:] = (g[1:] != g[:-1]) | (key[1:] != key[:-1])
        group[tied] = tied[np.maximum.accumulate(np.where(new, np.arange(len(tied)), 0))]
        at += 8
    # stage two: scan buckets of first bytes, inducing the larger suffixes from their successors
    first = data[order]
    bounds = np.searchsorted(first, np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[data[-1]].append(np.array([n - 1]))
    out = []
    for c in range(256):
        bucket = []
        now = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        while len(now):
            bucket.append(now)
            before = now[now > 0] - 1
            now = before[(data[before] == c) & ~small[before]]
        bucket.append(order[bounds[c] : bounds[c + 1]])
        done = np.concatenate(bucket)
        out.append(done)
        before = done[done > 0] - 1
        before = before[data[before] > c]  # larger than their successors, by their first byte
        if len(before):
            chars = data[before]
            by = np.argsort(chars, kind="stable")
            before, chars = before[by], chars[by]
            cuts = np.flatnonzero(np.diff(chars)) + 1
            for part in np.split(before, cuts):
                waiting[data[part[0]]].append(part)
    return np.concatenate(out)


def share_prefix(data: np.ndarray, sa: np.ndarray, length: int) -> np.ndarray:
    """same[i]: suffixes sa[i] and sa[i + 1] share their first ``length`` bytes."""
    w = np.concatenate([words_at(data), np.zeros(length + 8, np.uint64)])
    left = np.arange(len(sa) - 1)
    for at in range(0, length, 8):
        drop = np.uint64(8 * max(0, 8 - (length - at)))
        left = left[(w[sa[left] + at] >> drop) == (w[sa[left + 1] + at] >> drop)]
    same = np.zeros(max(0, len(sa) - 1), bool)
    same[left] = True
    return same


def block_groups(segments: list[bytes], counts: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, offset, group) of all windows: windows are equal if and only if their groups are."""
    sizes = np.array([len(s) + 1 for s in segments])
    base = np.cumsum(sizes) - sizes
    sep = bytes([SEPARATOR])
    data = np.frombuffer(sep.join(segments) + sep, np.uint8)
    sa = suffix_array(data, length)
    owner = np.repeat(np.arange(len(segments)), sizes)[sa]
    offset = sa - base[owner]
    group = np.concatenate([[0], np.cumsum(~share_prefix(data, sa, length))])
    window = offset < counts[owner]
    return owner[window], offset[window], group[window]


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes (a multiple of eight) from each place; the largest number where they don't fit."""
    out = np.full(len(data), np.uint64(2**64 - 1))
    m = len(data) - gram + 1
    if m > 0:
        w, factor = words_at(data), table(23, gram // 8) | np.uint64(1)
        total = w[:m] * factor[0]
        for k in range(1, gram // 8):
            total += w[8 * k : 8 * k + m] * factor[k]
        out[:m] = mix(total)
    return out


def segments_of(texts: list[bytes], length: int = LENGTH, gram: int = GRAM, digests: bool = True):
    """(text index, start, windows, anchor, two digest halves) of every segment of some texts; zeros for unwanted digests."""
    parts = []
    for a, b in batches_of([len(t) for t in texts], HASHED_BYTES):
        data = np.frombuffer(b"".join(texts[a:b]), np.uint8)
        sizes = np.array([len(t) for t in texts[a:b]])
        if len(data) < length:
            continue
        g = gram_hashes(data, gram)
        # the hash's high bits and the place in one number: the least is the leftmost of equals
        low = np.uint64((1 << len(g).bit_length()) - 1)
        least, width, span = (g & ~low) | np.arange(len(g), dtype=np.uint64), 1, length - gram + 1
        while width < span:
            step = min(width, span - width)
            least = np.minimum(least[:-step], least[step:])
            width += step
        ends = np.cumsum(sizes)
        owner = np.repeat(np.arange(b - a), sizes)
        m = len(data) - length + 1
        place = (least[:m] & low).astype(np.int64)
        fits = np.arange(m) + length <= ends[owner[:m]]
        new = np.ones(m, bool)
        new[1:] = (place[1:] != place[:-1]) | (owner[1:m] != owner[: m - 1]) | (fits[1:] != fits[:-1])
        start = np.flatnonzero(new)
        stop = np.append(start[1:], m)
        start, stop = start[fits[start]], stop[fits[start]]
        if not len(start):
            continue
        own, end = owner[start], stop - 1 + length
        both = [range_hashes(data, start, end, seed).view(np.int64) for seed in (5, 6)] if digests else [np.zeros(len(start), np.int64)] * 2
        parts.append((own + a, start - (ends - sizes)[own], stop - start, g[place[start]].view(np.int64), *both))
    if not parts:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def encoded(texts) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") for t in texts]


def segment_rows(docs: DataFrame) -> DataFrame:
    """(a, g1, g2, d, p, c): anchor, digest, document, place (32 bits of the text's hash, then the start), windows."""

    def run(batches):
        for b in batches:
            owner, start, count, anchor, g1, g2 = segments_of(encoded(b["text"]))
            place = (b["h"].to_numpy().astype(np.int64)[owner] << 32) | start
            yield pd.DataFrame({"a": anchor, "g1": g1, "g2": g2, "d": b["d"].to_numpy()[owner], "p": place, "c": count.astype(np.int32)})

    return _texts(docs).mapInPandas(run, "a long, g1 long, g2 long, d long, p long, c int")


def anchor_rows(docs: DataFrame) -> DataFrame:
    """(a): the anchor of each segment."""

    def run(batches):
        for b in batches:
            yield pd.DataFrame({"a": segments_of(encoded(b["text"]), digests=False)[3]})

    return docs.select(text_of().alias("text")).mapInPandas(run, "a long")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(id_key().alias("d"), F.hash("text").alias("h"), text_of().alias("text"))


def _split_place(df: DataFrame) -> DataFrame:
    return df.withColumn("h", F.expr("cast(p >> 32 as int)")).withColumn("s", F.expr("cast(p & 4294967295 as int)"))


def in_block(rows: list[tuple], salted: bool) -> tuple[list[pd.DataFrame], list[pd.DataFrame]]:
    """Later windows of a block as (d, p, c), and for salted anchors its distinct windows as (w1, w2, d, p)."""
    d, p, c = (np.array([r[i] for r in rows], np.int64) for i in (0, 1, 2))
    segs = [r[3] for r in rows]
    owner, offset, group = block_groups(segs, c)
    dd, pp = d[owner], p[owner] + offset
    order = np.lexsort((pp, dd, group))
    owner, offset, group, dd, pp = owner[order], offset[order], group[order], dd[order], pp[order]
    first = np.ones(len(group), bool)
    first[1:] = group[1:] != group[:-1]
    # a repeated row has the place of its group's first window and isn't later
    head = np.maximum.accumulate(np.where(first, np.arange(len(group)), 0))
    at = np.flatnonzero((dd != dd[head]) | (pp != pp[head]))
    at = at[np.lexsort((pp[at], dd[at]))]
    later = pd.DataFrame({"d": dd[at], "p": pp[at], "c": np.ones(len(at), np.int32)})
    if len(later):  # consecutive starts as one row
        run = np.ones(len(later), bool)
        run[1:] = (later["d"].to_numpy()[1:] != later["d"].to_numpy()[:-1]) | (np.diff(later["p"]) != 1)
        starts = np.flatnonzero(run)
        later = later.iloc[starts].assign(c=np.diff(np.append(starts, len(run))).astype(np.int32))
    reps = []
    if salted:
        f = np.flatnonzero(first)
        data = np.frombuffer(b"".join(segs), np.uint8)
        begin = np.cumsum([0, *(len(s) for s in segs[:-1])])[owner[f]] + offset[f]
        w1, w2 = (range_hashes(data, begin, begin + LENGTH, k).view(np.int64) for k in (5, 6))
        reps.append(pd.DataFrame({"w1": w1, "w2": w2, "d": dd[f], "p": pp[f]}))
    return [later], reps


def repeated(docs: DataFrame) -> DataFrame:
    """(d, h, runs array of struct(s, c)): windows of each document that also start earlier, c from s on."""
    shared = materialize(anchor_rows(docs).groupBy("a").agg(F.count("*").alias("n")).where("n > 1").select("a"), "anchors")
    met = materialize(segment_rows(docs).join(shared, "a", "left_semi"), "segments")
    place = F.struct("d", "p")
    unique = materialize(met.groupBy("a", "g1", "g2", "c").agg(F.min(place).alias("first"), F.count("*").alias("n")), "unique")
    copies = unique.where("n > 1").select("g1", "g2", "c", "first")
    equal = met.join(materialize(copies, "copies"), ["g1", "g2", "c"]).where(place > F.col("first")).select("d", "p", "c")
    # different segments of one anchor
    many = unique.groupBy("a").agg(F.count("*").alias("n")).where("n > 1")
    many = materialize(many.select("a", F.ceil(F.col("n") / BLOCK_SEGMENTS).cast("int").alias("salts")), "many")
    wanted = unique.join(many, "a").select("a", "salts", F.pmod("g1", "salts").cast("int").alias("salt"), "first.d", "first.p", "c")
    wanted = _split_place(wanted).groupBy("d", "h").agg(F.collect_list(F.struct("a", "salts", "salt", "s", "c", "p")).alias("segs"))
    near = materialize(wanted, "wanted")

    def cut(batches):
        for b in batches:
            out = []
            for d, text, segs in zip(b["d"], b["text"], b["segs"], strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                out += [(x["a"], x["salts"] > 1, x["salt"], d, x["p"], x["c"], raw[x["s"] : x["s"] + x["c"] + LENGTH - 1]) for x in segs]
            yield pd.DataFrame(out, columns=["a", "salted", "salt", "d", "p", "c", "seg"])

    source = _texts(docs).join(near, ["d", "h"]).select("d", "text", "segs")
    pieces = source.mapInPandas(cut, "a long, salted boolean, salt int, d long, p long, c int, seg binary")
    dealt = pieces.repartition("a", "salt").sortWithinPartitions("salted", "a", "salt")

    def sort(batches):
        rows, total, last = [], 0, None

        def found():
            later, reps = in_block([r[3:] for r in rows], rows[0][0])
            for f in later:
                yield f.assign(w1=0, w2=0, rep=False)
            for f in reps:
                yield f.assign(c=np.int32(0), rep=True)

        for b in batches:
            for r in b[["salted", "a", "salt", "d", "p", "c", "seg"]].itertuples(index=False, name=None):
                key = r[:3]
                # whole blocks only: a block ends between anchors, and salted anchors are blocks of their own kind
                if rows and key != last and (total >= BLOCK_BYTES or r[0] != last[0]):
                    yield from found()
                    rows, total = [], 0
                rows.append(r)
                total, last = total + len(r[6]), key
        if rows:
            yield from found()

    sorted_ = materialize(dealt.mapInPandas(sort, "w1 long, w2 long, d long, p long, c int, rep boolean"), "sorted")
    reps = sorted_.where("rep")
    firsts = reps.groupBy("w1", "w2").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    across = reps.join(materialize(firsts, "windows"), ["w1", "w2"]).where(place > F.col("first")).select("d", "p", F.lit(1).alias("c"))
    every = _split_place(equal.unionByName(sorted_.where("not rep").select("d", "p", "c")).unionByName(across))
    return every.groupBy("d", "h").agg(F.collect_set(F.struct("s", "c")).alias("runs"))


def spans_of(runs, length: int = LENGTH) -> list[tuple[int, int]]:
    """Maximal covered byte ranges."""
    out: list[list[int]] = []
    for s, e in sorted((r["s"], r["s"] + r["c"] + length - 1) for r in runs):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def kept_bytes(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for s in spans for x in s), len(raw)]
    return b"".join(raw[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2))


def joined(docs: DataFrame) -> DataFrame:
    found = materialize(repeated(docs), "runs").select(F.col("d").alias("__d"), F.col("h").alias("__h"), F.col("runs").alias("__runs"))
    keyed = docs.withColumn("__dk", id_key()).withColumn("__hk", F.hash("text"))
    return keyed.join(found, (F.col("__dk") == F.col("__d")) & (F.col("__hk") == F.col("__h")), "left").drop("__dk", "__hk", "__d", "__h")


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated bytes cut out; what is left of a split character is replaced by U+FFFD."""

    @F.pandas_udf("string")
    def cut(text: pd.Series, runs: pd.Series) -> pd.Series:
        return pd.Series([kept_bytes(t, spans_of(r)).decode("utf-8", "replace") for t, r in zip(encoded(text), runs, strict=True)])

    text = F.when(F.col("__runs").isNotNull(), cut(text_of(), F.coalesce("__runs", F.array().cast("array<struct<s:int,c:int>>"))))
    return joined(docs).withColumn("text", text.otherwise(F.col("text"))).drop("__runs")


def op7_suffix(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")

    def run(batches):
        for b in batches:
            out = []
            for doc, text, runs in zip(b["doc_id"], b["text"], b["__runs"], strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                spans = [] if runs is None else spans_of(runs)
                out.append((doc, len(raw), sum(e - s for s, e in spans), len(spans), hashlib.sha256(kept_bytes(raw, spans)).hexdigest()))
            yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return joined(docs).select("doc_id", text_of().alias("text"), "__runs").mapInPandas(run, schema)
