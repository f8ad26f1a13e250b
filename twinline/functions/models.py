"""Model adapters as DataFrame transforms.

A model sees Arrow batches of rows (call, channel, sr, pcm) and is made once per
worker. A row that fails keeps its error; nothing else is lost. The built-in
models are deterministic and need nothing from outside; HTTP services plug in
by name with a ``post`` function that takes and returns plain values.
"""

from __future__ import annotations

import time
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import clustering
from ..sources import rttm
from . import signal as sig
from .registry import model, provides


def per_row(audio: DataFrame, make: Callable[[], Callable], schema: str, keep: str = "call string, channel int") -> DataFrame:
    """keep + value + error of ``make()(pcm, sr)`` for each row."""
    names = [c.split()[0] for c in keep.split(", ")]

    def run(batches):
        model = make()
        for b in batches:
            out = []
            for row in b[[*names, "pcm", "sr"]].itertuples(index=False, name=None):
                try:
                    out.append((*row[:-2], model(np.asarray(row[-2], np.float32), int(row[-1])), None))
                except Exception as e:  # one bad recording is a row with an error, whatever the model raises
                    out.append((*row[:-2], None, repr(e)))
            yield pd.DataFrame(out, columns=[*names, "value", "error"])

    return audio.select(*names, "pcm", "sr").mapInPandas(run, f"{keep}, value {schema}, error string")


def retrying(post: Callable, tries: int = 3, pause_s: float = 0.5) -> Callable:
    """``post`` again after failures that its exception marks as the server's (status 500 and up)."""

    def call(*args):
        for i in range(tries):
            try:
                return post(*args)
            except Exception as e:
                if getattr(e, "status", 0) < 500 or i + 1 == tries:
                    raise
                time.sleep(pause_s * 2**i)

    return call


def energy_spans(pcm: np.ndarray, sr: int, floor: float = 0.02, gap_s: float = 0.2) -> list[dict]:
    """Speech where 10 ms frames are louder than the floor; gaps up to ``gap_s`` close."""
    step = max(1, sr // 100)
    n = len(pcm) // step
    loud = np.sqrt(np.mean(pcm[: n * step].reshape(n, step).astype(float) ** 2, axis=1)) > floor if n else np.zeros(0, bool)
    at = np.flatnonzero(np.diff(np.concatenate([[0], loud.astype(int), [0]])))
    spans = [[a * step / sr, b * step / sr] for a, b in zip(at[::2], at[1::2], strict=True)]
    out: list[list[float]] = []
    for s, e in spans:
        if out and s - out[-1][1] <= gap_s:
            out[-1][1] = e
        else:
            out.append([s, e])
    return [{"start": s, "end": e} for s, e in out]


def spectral_vector(pcm: np.ndarray, sr: int, dim: int = 32, low: float = 50.0, high: float = 1000.0) -> list[float]:
    """Mean spectrum over bands between two frequencies, at unit length."""
    power = np.abs(np.fft.rfft(pcm.astype(float))) ** 2
    freq = np.fft.rfftfreq(len(pcm), 1 / sr)
    band = np.digitize(freq, np.linspace(low, high, dim + 1)) - 1
    ok = (band >= 0) & (band < dim)
    v = np.sqrt(np.bincount(band[ok], power[ok], dim))
    return (v / max(np.linalg.norm(v), 1e-12)).tolist()


SPANS, VECTOR = "array<struct<start:double,end:double>>", "array<double>"
GENDER, SAMPLES = "struct<label:string,confidence:double>", "array<float>"
SEGMENTS = "call string, start double, end double, label string"


def valued(schema: str) -> str:
    return f"call string, channel int, value {schema}, error string"


@provides("vad", "energy", valued(SPANS), floor=0.02, gap_s=0.2)
def _energy(floor, gap_s):
    return lambda audio: per_row(audio, lambda: lambda x, sr: energy_spans(x, sr, floor, gap_s), SPANS)


@provides("embedder", "spectral", valued(VECTOR), dim=32)
def _spectral(dim):
    return lambda audio: per_row(audio, lambda: lambda x, sr: spectral_vector(x, sr, dim), VECTOR)


@provides("gender", "pitch", valued(GENDER), split_hz=375.0)
def _pitch(split_hz):
    def classify(x, sr):
        f = np.fft.rfftfreq(len(x), 1 / sr)[np.argmax(np.abs(np.fft.rfft(x.astype(float))))]
        return {"label": "male" if f < split_hz else "female", "confidence": 1.0}

    return lambda audio: per_row(audio, lambda: classify, GENDER)


@provides("enhancer", "gate", valued(SAMPLES), k=1)
def _gate(k):
    """Speech kept, the rest faded, at k times the rate: the shape of an enhancer without a model."""

    def enhance(x, sr):
        spans = [(s["start"], s["end"]) for s in energy_spans(x, sr)]
        return sig.resample(sig.zerofy(x, spans, sr)[0], sr, sr * k).tolist()

    return lambda audio: per_row(audio, lambda: enhance, SAMPLES)


@provides("diarizer", "from_dir", SEGMENTS, path=...)
def _from_dir(path):
    """Adopts segments from RTTM files; no audio is read."""
    return lambda recordings: rttm.read(recordings.sparkSession, path).join(recordings.select("call").distinct(), "call", "left_semi")


@provides("diarizer", "channels", SEGMENTS, floor=0.02, gap_s=0.2)
def _channels(floor, gap_s):
    """One speaker per channel, where it is loud; labels carry the channel so that they can't clash."""

    def diarize(audio: DataFrame) -> DataFrame:
        spans = model("vad", "energy", floor=floor, gap_s=gap_s)(audio).where("error is null")
        rows = spans.select("call", (F.col("channel") + 1).alias("channel"), F.explode("value").alias("s"))
        return rows.select("call", "channel", "s.start", "s.end", F.format_string("ch%d_speaker_0", F.col("channel") - 1).alias("label"))

    return diarize


for _kind, _schema in (("vad", SPANS), ("embedder", VECTOR), ("gender", GENDER), ("enhancer", SAMPLES), ("diarizer", "string")):

    @provides(_kind, "http", valued(_schema), post=..., tries=3, pause_s=0.5)
    def _service(post, tries, pause_s, schema=_schema):
        """A service: ``post(samples, sr) -> value``, again on server errors."""
        return lambda audio: per_row(audio, lambda: retrying(post, tries, pause_s), schema)


@provides("clusterer", "constrained_ahc", "key string, speaker string", threshold=0.8, linkage="complete")
def _ahc(threshold, linkage):
    return lambda vectors: clustering.constrained_clusters(vectors, threshold, linkage)
