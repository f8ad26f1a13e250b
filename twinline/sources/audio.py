"""WAV files: a codec in numpy, a batch reader over any Spark-readable store, a writer, discovery."""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .rttm import stem


def encode_wav(samples: np.ndarray, sr: int, floating: bool = False) -> bytes:
    """(n,) or (n, channels) to RIFF WAVE, 16-bit or 32-bit float."""
    x = np.asarray(samples, np.float32)
    x = x[:, None] if x.ndim == 1 else x
    raw = x.astype("<f4") if floating else np.clip(np.rint(x * 32768), -32768, 32767).astype("<i2")
    width = raw.dtype.itemsize
    fmt = struct.pack("<HHIIHH", 3 if floating else 1, x.shape[1], sr, sr * x.shape[1] * width, x.shape[1] * width, 8 * width)
    body = b"WAVEfmt " + struct.pack("<I", 16) + fmt + b"data" + struct.pack("<I", raw.nbytes) + raw.tobytes()
    return b"RIFF" + struct.pack("<I", len(body)) + body


def probe_wav(head: bytes) -> tuple[int, int, int, int, int, int]:
    """(format, channels, rate, bits, place of the data, bytes of data) from a file's first bytes."""
    if head[:4] != b"RIFF" or head[8:12] != b"WAVE":
        raise ValueError("not a WAVE file")
    at, fmt = 12, None
    while at + 8 <= len(head):
        tag, size = head[at : at + 4], struct.unpack_from("<I", head, at + 4)[0]
        if tag == b"fmt ":
            kind, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", head, at + 8)
            fmt = kind, channels, rate, bits
        elif tag == b"data":
            if fmt is None:
                break
            return *fmt, at + 8, size
        at += 8 + size + size % 2
    raise ValueError("no data chunk")


def decode_wav(data: bytes) -> tuple[np.ndarray, int]:
    """((n, channels) float32, rate)."""
    kind, channels, rate, bits, at, size = probe_wav(data)
    types = {(1, 16): ("<i2", 32768.0), (1, 32): ("<i4", 2147483648.0), (3, 32): ("<f4", 1.0), (3, 64): ("<f8", 1.0), (1, 8): ("u1", 128.0)}
    if (kind, bits) not in types:
        raise ValueError(f"format {kind} with {bits} bits")
    name, scale = types[kind, bits]
    raw = np.frombuffer(data, name, min(size, len(data) - at) // (bits // 8), at).astype(np.float64)
    raw = (raw - 128 if bits == 8 else raw) / scale
    return raw.astype(np.float32).reshape(-1, channels), rate


def discover(spark: SparkSession, path: str, pattern: str = "*.wav") -> DataFrame:
    """(path, call, bytes) of every file, by listing only."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return files.select("path", stem(F.col("path")).alias("call"), F.col("length").alias("bytes")).distinct()


def read(spark: SparkSession, path: str, pattern: str = "*.wav", samples: bool = True) -> DataFrame:
    """A row per channel: call, path, channel, sr, n_samples, pcm (none without ``samples``); unreadable files have an error instead."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    schema = "path string, channel int, sr int, n_samples long, pcm array<float>, error string"
    if not samples:
        return _probe(files, schema)

    def run(batches):
        for b in batches:
            out = []
            for p, c in zip(b["path"], b["content"], strict=True):
                try:
                    x, sr = decode_wav(c)
                    out += [(p, i, sr, len(x), x[:, i], None) for i in range(x.shape[1])]
                except (ValueError, struct.error) as e:
                    out.append((p, None, None, None, None, repr(e)))
            yield pd.DataFrame(out, columns=["path", "channel", "sr", "n_samples", "pcm", "error"])

    return files.select("path", "content").mapInPandas(run, schema).withColumn("call", stem(F.col("path")))


def _probe(files: DataFrame, schema: str, head: int = 4096) -> DataFrame:
    """The rows of ``read`` from the first bytes of every file; nothing else is sent to Python, nothing decoded."""

    def run(batches):
        for b in batches:
            out = []
            for p, n, c in zip(b["path"], b["length"], b["head"], strict=True):
                try:
                    _, channels, sr, bits, at, size = probe_wav(c)
                    out += [(p, i, sr, min(size, n - at) // (bits // 8 * channels), None, None) for i in range(channels)]
                except (ValueError, struct.error, ZeroDivisionError) as e:
                    out.append((p, None, None, None, None, repr(e)))
            yield pd.DataFrame(out, columns=["path", "channel", "sr", "n_samples", "pcm", "error"])

    heads = files.select("path", "length", F.substring("content", 1, head).alias("head"))
    return heads.mapInPandas(run, schema).withColumn("call", stem(F.col("path")))


def to_wav(df: DataFrame) -> DataFrame:
    """(call, wav): encoded files of rows (call, sr, pcm), as a column that any sink can take."""

    @F.pandas_udf("binary")
    def pack(pcm: pd.Series, sr: pd.Series) -> pd.Series:
        return pd.Series([encode_wav(np.asarray(p, np.float32), int(r)) for p, r in zip(pcm, sr, strict=True)])

    return df.select("call", pack("pcm", "sr").alias("wav"))
