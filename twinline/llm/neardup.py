"""Near-duplicate classes with DartMinHash signatures.

A text is a bag of five-word shingles: a weighted set, a shingle's weight its
number of occurrences. Along a rank axis each unit of weight is hit by hashed darts at the times
of a unit Poisson process, the same for every text that has the region. Darts
below the rank bound R = t / weight (t = k ln k + 2k expected darts in any text,
long or short) fall on k coordinates by hash; each coordinate keeps its
earliest. Texts with an empty coordinate throw on to twice the rank. Two
signatures agree in a coordinate with the probability of the weighted Jaccard
similarity.

k = 512 in 64 bands of 8: a pair at similarity 0.8 shares no band with
probability 8e-6, one at 0.3 shares one with 4e-3. Equal texts are collapsed
first. The members of a bucket are compared with one centre, the member with most
company, exactly and from the whole texts; what a member has and the centre hasn't, or
the other way round, is kept as its difference. Members with the same centre that are
in different classes by then are compared by their differences D alone, for
|X xor Y| = |D_x| + |D_y| - 2 |D_x and D_y|: exact again, as one product of matrices in
a task of at most ``LIMIT`` members. A centre of more members deals them into shares, each two
of which make a task; of more than ``WIDE``, those of its largest class, which need no comparison
with one another, into shares of their own that meet the others' shares only. Either way every two
members of different classes meet in a task, so how many members a centre has decides no result. Pairs
of members are rows only if they are similar; nothing is left out.

Defined results: null is the empty text; texts without words are near
duplicates of equal texts only; texts of one to four words have one shingle of
all of them; rows that share doc_id and text are one document; a null doc_id
sorts first; an empty table gives an empty result; extra columns pass through.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from .common import NULL_ID, discard, id_key, materialize, text_of
from .hashing import RADIX, batches_of, mix, shingle_elements, table

BANDS, ROWS, SIMILARITY, SHINGLE = 64, 8, 0.8, 5
#: Members of a centre that one task compares, and those from which on its largest class is dealt apart.
LIMIT, WIDE = 2_048, 32_768
#: Darts thrown at a time.
DARTS = 50_000


def layers(elements: np.ndarray, owner: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Elements of weight one at most: whole layers of an element, and one of what is left."""
    count = np.ceil(weights).astype(np.int64)
    at = np.repeat(np.arange(len(elements)), count)
    nth = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
    el = np.where(nth == 0, elements[at], mix(elements[at] + nth.astype(np.uint64) * RADIX))
    return el, owner[at], np.minimum(1.0, weights[at] - nth)


def signatures(elements: np.ndarray, owner: np.ndarray, n: int, k: int, weights: np.ndarray | None = None) -> np.ndarray:
    """(n, k) earliest dart of each coordinate, for n texts; rows of texts without elements are 0.

    An element of weight w (default 1) is hit in the part of its region below w;
    weights above 1 are layers of regions. ``owner`` is in order.
    """
    if weights is not None:
        elements, owner, weights = layers(elements, owner, weights)
    weight = np.bincount(owner, weights, minlength=n)
    out = np.zeros((n, k), np.uint64)
    todo, expected = np.flatnonzero(weight > 0), k * np.log(k) + 2 * k
    while len(todo):
        bound = np.zeros(n)
        bound[todo] = expected / weight[todo]
        best, ident = np.full(n * k, np.inf), np.zeros(n * k, np.uint64)
        live = np.flatnonzero(bound[owner] > 0)
        limit = bound[owner[live]]
        # elements of like bounds throw their darts side by side, DARTS at a time
        for size in np.unique(step := np.ceil(np.log2(limit + 1)).astype(np.int64)):
            some = live[step == size]
            width = int(1.25 * 2**size) + 2
            for lo in range(0, len(some), per := max(1, DARTS // width)):
                at = some[lo : lo + per]
                rank, first = np.zeros(len(at)), 1
                while len(at):
                    steps = np.arange(first, first + width, dtype=np.uint64) * RADIX
                    dart = mix(elements[at][:, None] + steps)
                    gap = -np.log(((dart >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)
                    gap[:, 0] += rank
                    ranks = np.cumsum(gap, axis=1)
                    keep = ranks < bound[owner[at]][:, None]
                    if weights is not None:
                        keep &= ((mix(dart ^ RADIX) >> np.uint64(11)).astype(np.float64) * 2.0**-53) < weights[at][:, None]
                    hit, face = ranks[keep], mix(dart[keep])
                    cell = np.repeat(owner[at] * k, keep.sum(1)) + (face % np.uint64(k)).astype(np.int64)
                    np.minimum.at(best, cell, hit)
                    won = best[cell] == hit
                    ident[cell[won]] = face[won]
                    rank = ranks[:, -1]
                    more = rank < bound[owner[at]]
                    at, rank, first = at[more], rank[more], first + width
        best, ident = best.reshape(n, k), ident.reshape(n, k)
        filled = np.isfinite(best[todo]).all(1)
        out[todo[filled]] = ident[todo[filled]]
        todo, expected = todo[~filled], expected * 2
    return out


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(n, bands) keys; the band's number is part of the key."""
    mult = table(11, rows) | np.uint64(1)
    part = sig.reshape(len(sig), bands, rows)
    return mix((part * mult).sum(2) + table(13, bands)).view(np.int64)


def signed(texts: list[str], bands: int, rows: int, shingle: int) -> list:
    out: list = []
    for a, b in batches_of([len(t) for t in texts]):
        el, own = shingle_elements(texts[a:b], shingle)
        keys = band_keys(signatures(el, own, b - a, bands * rows), bands, rows)
        has = np.bincount(own, minlength=b - a) > 0
        out += [row if ok else row[:0] for row, ok in zip(keys, has, strict=True)]
    return out


def with_bands(docs: DataFrame, bands: int, rows: int, shingle: int) -> DataFrame:
    """(d, h, v, bands): v is the digest of the text."""

    def run(batches):
        for b in batches:
            yield b[["d", "h", "v"]].assign(bands=signed(b["text"].tolist(), bands, rows, shingle))

    digest = F.unhex(F.md5(text_of())).alias("v")
    base = docs.select(id_key().alias("d"), F.xxhash64("text").alias("h"), digest, text_of().alias("text"))
    return base.mapInPandas(run, "d long, h long, v binary, bands array<long>")


def elements_of(texts: list[str], shingle: int) -> list[np.ndarray]:
    """The sorted elements of each text."""
    out = []
    for a, b in batches_of([len(t) for t in texts]):
        el, own = shingle_elements(texts[a:b], shingle)
        out += np.split(el, np.searchsorted(own, np.arange(1, b - a)))
    return [np.sort(x) for x in out]


def similarity(m: int, n: int, differing) -> float:
    """Weighted Jaccard similarity of bags of m and n shingles of which so many are in one only."""
    return (m + n - differing) / np.maximum(1, m + n + differing)


def similar(left: list[str], right: list[str], shingle: int) -> np.ndarray:
    """Weighted Jaccard similarity of the bags of shingles, pair by pair."""
    pairs = zip(elements_of(left, shingle), elements_of(right, shingle), strict=True)
    return np.array([similarity(len(x), len(y), len(np.setxor1d(x, y, assume_unique=True))) for x, y in pairs])


def compared(pairs: DataFrame, texts: DataFrame, least: float, shingle: int) -> DataFrame:
    """(x, v, alike, n, d) of pairs of a centre x and a member v: are they similar, v's elements and its difference."""

    def run(batches):
        for p in batches:
            for a, b in batches_of([len(x) + len(y) for x, y in zip(p["tx"], p["tv"], strict=True)], 1_000_000):
                some = p.iloc[a:b]
                centres = {bytes(x): t for x, t in zip(some["x"], some["tx"], strict=True)}
                known = dict(zip(centres, elements_of(list(centres.values()), shingle), strict=True))
                out = []
                for x, v, y in zip(some["x"], some["v"], elements_of(some["tv"].tolist(), shingle), strict=True):
                    c = known[bytes(x)]
                    d = np.setxor1d(c, y, assume_unique=True)
                    out.append((x, v, similarity(len(c), len(y), len(d)) >= least, len(y), d.tobytes()))
                yield pd.DataFrame(out, columns=["x", "v", "alike", "n", "d"])

    both = pairs.join(texts.select(F.col("v").alias("x"), F.col("text").alias("tx")), "x")
    both = both.join(texts.select("v", F.col("text").alias("tv")), "v")
    return both.select("x", "v", "tx", "tv").mapInPandas(run, "x binary, v binary, alike boolean, n long, d binary")


def links_in(v: list[bytes], c: list[bytes], n: list[int], d: list[bytes], least: float, columns: int = 2048) -> list[tuple[bytes, bytes]]:
    """(a, b) with a < b: similar pairs of different classes among members of one centre."""
    label = np.unique(np.array(c, object), return_inverse=True)[1]
    if not label.any():
        return []
    diffs = [np.frombuffer(x, np.uint64) for x in d]
    size, n = np.array([len(x) for x in diffs]), np.array(n)
    owner = np.repeat(np.arange(len(v)), size)
    _, at, count = np.unique(np.concatenate(diffs), return_inverse=True, return_counts=True)
    column = np.cumsum(count > 1) - 1  # an element of one difference is in no intersection
    owner, at = owner[count[at] > 1], column[at[count[at] > 1]]
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    common = np.zeros((len(v), len(v)), np.float32)
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, columns):
        part = slice(*np.searchsorted(at, [lo, lo + columns]))
        has = np.zeros((len(v), columns), np.float32)
        has[owner[part], at[part] - lo] = 1
        common += has @ has.T
    out = []
    for i in range(len(v) - 1):
        j = np.arange(i + 1, len(v))
        close = similarity(n[i], n[j], size[i] + size[j] - 2 * common[i, j]) >= least
        out += [(min(v[i], v[k]), max(v[i], v[k])) for k in j[close & (label[j] != label[i])]]
    return out


def in_blocks(members: DataFrame, limit: int) -> DataFrame:
    """Members (k, n_k, ...) of centres with more than ``limit`` of them dealt into shares, each two of which make a block."""
    shares = F.ceil(F.col("n_k") / (limit // 2)).cast("int")
    own = members.withColumn("s", F.pmod(F.xxhash64(F.lit("share"), "v"), shares).cast("int"))
    other = own.withColumn("t", F.explode(F.sequence(F.lit(0), shares - 1)))
    return other.withColumn("k", F.xxhash64("k", F.least("s", "t"), F.greatest("s", "t"))).drop("s", "t")


def by_class(members: DataFrame, limit: int) -> DataFrame:
    """As ``in_blocks``, but no block for two shares of a centre's largest class: the negative ones, each of which meets all others."""
    per = members.groupBy("k", "c").agg(F.count("*").alias("n_c"))
    most = materialize(per.groupBy("k").agg(F.max(F.struct("n_c", "c")).alias("most")), "largest")
    apart = F.col("c") == F.col("most.c")
    shares = lambda n: F.ceil(n / (limit // 2)).cast("int")
    inner, outer = shares(F.col("most.n_c")), shares(F.col("n_k") - F.col("most.n_c"))
    place = lambda n: F.pmod(F.xxhash64(F.lit("share"), "v"), n).cast("int")
    own = members.join(most, "k").withColumn("s", F.when(apart, -1 - place(inner)).otherwise(place(outer)))
    other = own.withColumn("t", F.explode(F.sequence(F.when(apart, F.lit(0)).otherwise(-inner), outer - 1)))
    return other.withColumn("k", F.xxhash64("k", F.least("s", "t"), F.greatest("s", "t"))).drop("s", "t", "most")


def of_several(members: DataFrame) -> DataFrame:
    """Members of the groups k with members of several classes, and the groups' sizes n_k."""
    kinds = members.groupBy("k").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("n_k"))
    return members.join(kinds.where("lo <> hi").select("k", "n_k"), "k")


def links_within(members: DataFrame, least: float, limit: int, wide: int) -> DataFrame:
    """(a, b): similar pairs of different classes among the members (k, v, c, n, d) of each centre."""
    some = materialize(of_several(members), "open")
    names, wide = ["k", "v", "c", "n", "d"], max(limit, wide)
    large, huge = some.where((F.col("n_k") > limit) & (F.col("n_k") <= wide)), some.where(F.col("n_k") > wide)
    parts = [some.where(F.col("n_k") <= limit), in_blocks(large, limit), by_class(huge, limit)]
    blocks = reduce(DataFrame.unionByName, [x.select(names) for x in parts])

    def run(batches):
        key, rows = None, []

        def found():
            return pd.DataFrame(links_in(*zip(*rows, strict=True), least) if rows else [], columns=["a", "b"])

        for p in batches:
            for k, v, c, n, d in p[names].itertuples(index=False, name=None):
                if k != key:
                    yield found()
                    key, rows = k, []
                rows.append((bytes(v), bytes(c), n, d))
        yield found()

    return blocks.repartition("k").sortWithinPartitions("k").mapInPandas(run, "a binary, b binary").distinct()


def classes(
    docs: DataFrame, least: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, shingle: int = SHINGLE, limit: int = LIMIT, wide: int = WIDE
) -> DataFrame:
    """(d, h, cd, ch): each different document and the first document, by (doc_id, text hash), of its class."""
    sig = materialize(with_bands(docs, bands, rows, shingle), "signatures")
    nodes = materialize(sig.groupBy("v").agg(F.min(F.struct("d", "h")).alias("rep"), F.first("bands").alias("bands")), "nodes")
    places = materialize(sig.select("d", "h", "v").distinct(), "places")
    discard(sig)
    keys = nodes.select("v", F.explode("bands").alias("k"))
    shared = materialize(keys.groupBy("k").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    members = materialize(keys.join(shared, "k"), "members")
    company = materialize(members.groupBy("v").agg(F.sum("n").alias("company")), "company")
    known = nodes.join(company, "v", "left_semi").select("v", "rep.d", "rep.h")
    source = docs.select(id_key().alias("d"), F.xxhash64("text").alias("h"), text_of().alias("text"))
    texts = materialize(source.join(known, ["d", "h"]).dropDuplicates(["v"]).select("v", "text"), "texts")
    named = materialize(nodes.select("v", "rep"), "named")
    discard(nodes)

    rated = members.join(company, "v").select("k", "v", "company")
    top = rated.groupBy("k").agg(F.max(F.struct("company", "v")).alias("top"))  # combines before the shuffle
    centres = materialize(top.select("k", F.col("top.v").alias("x")), "centres")
    pairs = materialize(members.join(centres, "k").where("v <> x").select("x", "v").distinct(), "pairs")
    discard(members)
    near = materialize(compared(pairs, texts, least, shingle), "compared")
    edges = near.where("alike").select(F.least("x", "v").alias("a"), F.greatest("x", "v").alias("b"))
    labels = connected_components(edges)
    of = labels.select(F.col("node").alias("v"), F.col("component").alias("c"))
    rest = near.join(of, "v", "left").select(F.xxhash64("x").alias("k"), "v", F.coalesce("c", "v").alias("c"), "n", "d")
    more = materialize(links_within(rest, least, limit, wide), "links")
    if more.limit(1).count():
        labels = connected_components(edges.unionByName(more))
        of = labels.select(F.col("node").alias("v"), F.col("component").alias("c"))
    named = materialize(named.join(of, "v", "left").withColumn("c", F.coalesce("c", "v")), "classes")
    first = named.groupBy("c").agg(F.min("rep").alias("first"))
    by_text = materialize(named.join(materialize(first, "first"), "c").select("v", "first"), "by_text")
    return places.join(by_text, "v").select("d", "h", F.col("first.d").alias("cd"), F.col("first.h").alias("ch"))


def keep_first(docs: DataFrame, **how) -> DataFrame:
    """One row of each class of near duplicates: its first document."""
    firsts = classes(docs, **how).where("d = cd and h = ch").select(F.col("d").alias("__d"), F.col("h").alias("__h"))
    keyed = docs.withColumn("__dk", id_key()).withColumn("__hk", F.xxhash64("text"))
    kept = keyed.join(firsts, (F.col("__dk") == F.col("__d")) & (F.col("__hk") == F.col("__h")), "left_semi")
    return kept.dropDuplicates(["__dk", "__hk"]).drop("__dk", "__hk")


def _id(col: str):
    return F.when(F.col(col) != NULL_ID, F.col(col))


def op9_neardup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return classes(docs).select(_id("d").alias("doc_id"), _id("cd").alias("class_id"))
