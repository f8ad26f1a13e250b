"""Substring dedup by content-defined chunking with a gear rolling hash.

A chunk ends where the gear hash of the last 32 bytes is below a bound, so cuts
move with the content and an insertion disturbs only the chunks it touches.
Chunks are at least MIN bytes (but for a text's last) and at most MAX, and never
split a character. A chunk whose 128-bit digest occurs earlier (smaller doc_id,
or same document, earlier start) is a repeat; runs of consecutive repeats of
RUN bytes or more are removed, shorter ones are chance and stay.

First the 64-bit half of each digest is counted (counts combine before the
shuffle); chunks whose half occurs once are done. Only what is left is compared
in full. A hot chunk is a hot join key beside a table of known size, which the
optimizer splits; nothing gathers a group but one document's own repeats.

Defined results: null is the empty text, without chunks, and stays null; a null
doc_id sorts first; rows that share doc_id and text are one document; an empty
table gives an empty result; extra columns pass through.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_key, materialize, text_of
from .hashing import batches_of, range_hashes, table

WINDOW, MIN, MAX, RUN = 32, 12, 256, 64
#: A cut is where the hash is below this: one place in 20.
BELOW = np.uint32(2**32 // 20)
GEAR = (table(17) >> np.uint64(32)).astype(np.uint32)


def gear(data: np.ndarray) -> np.ndarray:
    """h[i] = sum of GEAR[data[i - j]] << j for j < 32, by doubling the window."""
    h = GEAR[data]
    step = 1
    while step < WINDOW:
        h[step:] += h[:-step] << np.uint32(step)
        step *= 2
    return h


def chunk_ends(raw: bytes) -> list[int]:
    """Ends of the chunks of one text."""
    n = len(raw)
    if not n:
        return []
    data = np.frombuffer(raw, np.uint8)
    h = gear(data)
    # a chunk may end before byte i only if i starts a character
    places = (np.flatnonzero(h[:-1] < BELOW) + 1).tolist()
    out, last = [], 0
    for p in [*places, n]:
        while p - last > MAX:
            cut = last + MAX
            while cut > last + MAX - 4 and raw[cut] & 0xC0 == 0x80:
                cut -= 1
            out.append(cut)
            last = cut
        if p == n:
            out.append(n)
        elif p - last >= MIN and raw[p] & 0xC0 != 0x80:
            out.append(p)
            last = p
    return out


def chunks_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text index, start, length, two halves of the digest) of every chunk of some texts."""
    parts = []
    raws = [t.encode("utf-8", "surrogatepass") for t in texts]
    for a, b in batches_of([len(r) for r in raws]):
        ends = [chunk_ends(r) for r in raws[a:b]]
        counts = np.array([len(e) for e in ends])
        base = np.cumsum([0, *(len(r) for r in raws[a : b - 1])])
        end = np.array([x for e in ends for x in e], np.int64)
        if not len(end):
            continue
        start = np.concatenate([[0], end[:-1]])
        start[np.cumsum(counts)[counts > 0] - counts[counts > 0]] = 0
        owner = np.repeat(np.arange(b - a), counts)
        data = np.frombuffer(b"".join(raws[a:b]), np.uint8)
        s, e = start + base[owner], end + base[owner]
        parts.append((owner + a, start, end - start, range_hashes(data, s, e, 2).view(np.int64), range_hashes(data, s, e, 3).view(np.int64)))
    if not parts:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def chunk_rows(docs: DataFrame) -> DataFrame:
    """(k1, k2, d, p, n): digest, document, place (32 bits of the text's hash, then the start), length."""

    def run(batches):
        for b in batches:
            owner, start, n, k1, k2 = chunks_of(b["text"].tolist())
            place = (b["h"].to_numpy().astype(np.int64)[owner] << 32) | start
            yield pd.DataFrame({"k1": k1, "k2": k2, "d": b["d"].to_numpy()[owner], "p": place, "n": n.astype(np.int32)})

    base = docs.select(id_key().alias("d"), F.hash("text").alias("h"), text_of().alias("text"))
    return base.mapInPandas(run, "k1 long, k2 long, d long, p long, n int")


def repeats(docs: DataFrame) -> DataFrame:
    """(d, h, spans): runs of repeated chunks of RUN bytes or more, by document."""
    rows = chunk_rows(docs)
    shared = materialize(rows.groupBy("k1").agg(F.count("*").alias("c")).where("c > 1").select("k1"), "shared")
    met = materialize(rows.join(shared, "k1", "left_semi"), "met")
    place = F.struct("d", "p")
    first = met.groupBy("k1", "k2").agg(F.min(place).alias("first"), F.count("*").alias("c")).where("c > 1").drop("c")
    later = met.join(materialize(first, "first"), ["k1", "k2"]).where(place > F.col("first"))
    start = F.expr("cast(p & 4294967295 as int)").alias("s")
    per = later.select("d", F.expr("cast(p >> 32 as int)").alias("h"), start, "n").groupBy("d", "h")
    own = per.agg(F.sort_array(F.collect_set(F.struct("s", "n"))).alias("own"))

    def run(batches):
        for b in batches:
            spans = []
            for x in b["own"]:
                out: list[list[int]] = []
                for c in x:
                    if out and out[-1][1] == c["s"]:
                        out[-1][1] += c["n"]
                    else:
                        out.append([c["s"], c["s"] + c["n"]])
                spans.append([{"start": s, "end": e} for s, e in out if e - s >= RUN])
            yield b[["d", "h"]].assign(spans=spans)

    return own.mapInPandas(run, "d long, h int, spans array<struct<start:int,end:int>>").where(F.size("spans") > 0)


def with_spans(docs: DataFrame) -> DataFrame:
    """``docs`` plus __spans, the byte ranges to remove (empty if none)."""
    found = materialize(repeats(docs), "spans").select(F.col("d").alias("__d"), F.col("h").alias("__h"), F.col("spans").alias("__spans"))
    keyed = docs.withColumn("__dk", id_key()).withColumn("__hk", F.hash("text"))
    out = keyed.join(found, (F.col("__dk") == F.col("__d")) & (F.col("__hk") == F.col("__h")), "left")
    none = F.array().cast("array<struct<start:int,end:int>>")
    return out.withColumn("__spans", F.coalesce("__spans", none)).drop("__dk", "__hk", "__d", "__h")


def cut_bytes(raw: bytes, spans) -> bytes:
    out, last = [], 0
    for s in spans:
        out.append(raw[last : s["start"]])
        last = s["end"]
    return b"".join([*out, raw[last:]])


def dedup_chunks(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated runs of chunks cut out of the text."""

    @F.pandas_udf("string")
    def cut(text: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([cut_bytes(t.encode("utf-8", "surrogatepass"), s).decode("utf-8", "surrogatepass") for t, s in zip(text, spans, strict=True)])

    out = with_spans(docs)
    text = F.when(F.size("__spans") > 0, cut(text_of(), F.col("__spans"))).otherwise(F.col("text"))
    return out.withColumn("text", text).drop("__spans")


def op5_chunks(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    sizes = docs.select("doc_id", F.octet_length(text_of()).cast("long").alias("n_bytes"), F.hash("text").alias("hk"), id_key().alias("dk"))
    found = materialize(repeats(docs), "spans")
    out = sizes.join(found, (F.col("dk") == F.col("d")) & (F.col("hk") == F.col("h")), "left")
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    none = F.array().cast("array<struct<start:int,end:int>>")
    return out.select(
        "doc_id",
        "n_bytes",
        F.coalesce(removed, F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("spans", none).alias("spans"),
    )
