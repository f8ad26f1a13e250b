"""AVI motion-JPEG: write, index, decode intra frames, cut into timed clips.

A payload is stored 64 bytes to an 8x8 block, each byte b as the quantised DCT
coefficient 256 + b (in zigzag order, quantiser 1, restart after every block),
so entropy decoding gives the payload back exactly. 256 + b always has nine
magnitude bits; with a seven-bit Huffman code that is sixteen bits to a
coefficient, which numpy packs and unpacks without a loop over bits. Frames of
other writers are decoded symbol by symbol: baseline JPEG, grey or colour with any
subsampling, with their own Huffman tables or, as motion-JPEG often has none,
the usual ones. Histograms are of brightness.

Pixels come from an integer inverse DCT (exact in float64), so equal texts give
equal values in any batch. A frame opens a new clip if its histogram distance
from the one before is above mean + ``spread`` deviations of the last distances
in the clip.

Defined results: null is the empty text; the empty text is one block of zeros;
repeated rows give repeated rows; an empty table gives an empty result; a null doc_id
stays null; extra columns are left out. Media that are null, empty, no AVI or without a
readable frame give one row without a clip and the reason in ``error``. Of truncated
media the frames that are there count; one that can't be decoded shows the picture
before it, and ``error`` says how many there were.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

WIDTH, HEIGHT, FPS = 64, 32, 25
BLOCK = 64
FRAME = WIDTH * HEIGHT
_ALONE = bytes([0] * 6 + [1] + [0] * 9)  # a Huffman table with one symbol, seven bits long


def zigzag() -> np.ndarray:
    """Row-major place of the k-th coefficient in zigzag order."""
    order = sorted(((y, x) for y in range(8) for x in range(8)), key=lambda p: (p[0] + p[1], p[1] if (p[0] + p[1]) % 2 == 0 else p[0]))
    return np.array([y * 8 + x for y, x in order])


def basis() -> np.ndarray:
    """The 8-point DCT basis times 4096, as whole numbers."""
    k, n = np.mgrid[0:8, 0:8]
    c = np.cos((2 * n + 1) * k * np.pi / 16) * np.where(k == 0, np.sqrt(1 / 8), 0.5)
    return np.rint(c * 4096)


ZIGZAG, BASIS = zigzag(), basis()


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _jpeg_head(width: int, height: int) -> bytes:
    return b"".join((
        b"\xff\xd8", _segment(0xDB, b"\x00" + b"\x01" * 64), _segment(0xC0, struct.pack(">BHHBBBB", 8, height, width, 1, 1, 0x11, 0)),
        _segment(0xC4, b"\x00" + _ALONE + b"\x09"), _segment(0xC4, b"\x10" + _ALONE + b"\x09"), _segment(0xDD, b"\x00\x01"),
        _segment(0xDA, b"\x01\x01\x00\x00\x3f\x00"),
    ))


_HEAD = _jpeg_head(WIDTH, HEIGHT)


def encode_frame(payload: bytes) -> bytes:
    """One JPEG from FRAME payload bytes."""
    blocks = np.frombuffer(payload, np.uint8).reshape(-1, BLOCK)
    out = np.ones((len(blocks), 2 * BLOCK + 2), np.uint8)
    out[:, 1 : 2 * BLOCK : 2] = blocks
    out[:, -2], out[:, -1] = 0xFF, 0xD0 + np.arange(len(blocks)) % 8
    if b"\xff" in payload:
        scan = b"".join(bytes(x[:-2]).replace(b"\xff", b"\xff\x00") + bytes(x[-2:]) for x in out)
    else:
        scan = out.tobytes()
    return _HEAD + scan[:-2] + b"\xff\xd9"


def _chunk(tag: bytes, body: bytes) -> bytes:
    return tag + struct.pack("<I", len(body)) + body + b"\x00" * (len(body) % 2)


def encode_avi(payload: bytes) -> bytes:
    """A RIFF AVI with header, motion-JPEG frames and an idx1 index; strd holds the payload's length."""
    padded = payload + b"\x00" * (-len(payload) % FRAME)
    movi, index = [b"movi"], []
    at = 4
    for i in range(0, len(padded), FRAME):
        piece = _chunk(b"00dc", encode_frame(padded[i : i + FRAME]))
        index.append(struct.pack("<4sIII", b"00dc", 0x10, at, struct.unpack_from("<I", piece, 4)[0]))
        movi.append(piece)
        at += len(piece)
    n = len(index)
    avih = struct.pack("<14I", 1_000_000 // FPS, 0, 0, 0x10, n, 0, 1, FRAME, WIDTH, HEIGHT, 0, 0, 0, 0)
    strh = struct.pack("<4s4sIHHIIIIIIII4H", b"vids", b"MJPG", 0, 0, 0, 0, 1, FPS, 0, n, FRAME, 0, 0, 0, 0, WIDTH, HEIGHT)
    strf = struct.pack("<IiiHH4sIiiII", 40, WIDTH, HEIGHT, 1, 8, b"MJPG", FRAME, 0, 0, 0, 0)
    strl = _chunk(b"LIST", b"strl" + _chunk(b"strh", strh) + _chunk(b"strf", strf) + _chunk(b"strd", struct.pack("<Q", len(payload))))
    body = b"AVI " + _chunk(b"LIST", b"hdrl" + _chunk(b"avih", avih) + strl) + _chunk(b"LIST", b"".join(movi)) + _chunk(b"idx1", b"".join(index))
    return _chunk(b"RIFF", body)


def _chunks(data: bytes, at: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    while at + 8 <= end:
        tag, size = data[at : at + 4], struct.unpack_from("<I", data, at + 4)[0]
        yield tag, at + 8, size
        at += 8 + size + size % 2


def _number(data: bytes, kind: str, at: int, default: int) -> int:
    return struct.unpack_from(kind, data, at)[0] if at + struct.calcsize(kind) <= len(data) else default


def parse_avi(data: bytes) -> dict:
    """fps, payload length (None if not ours) and frames as (offset, size); by idx1, or by walking movi without one."""
    if data[:4] != b"RIFF" or data[8:12] != b"AVI ":
        raise ValueError("not a RIFF AVI")
    out: dict = {"fps": FPS, "length": None, "frames": []}
    movi, index = None, []
    for tag, at, size in _chunks(data, 12, len(data)):
        size = min(size, len(data) - at)
        if tag == b"LIST" and data[at : at + 4] == b"hdrl":
            for sub, a, s in _chunks(data, at + 4, at + size):
                if sub == b"avih":
                    out["fps"] = 1_000_000 / max(1, _number(data, "<I", a, 1_000_000 // FPS))
                elif sub == b"LIST":
                    own = (_number(data, "<Q", x, -1) for t, x, n in _chunks(data, a + 4, a + s) if t == b"strd" and n == 8)
                    out["length"] = next((n for n in own if n >= 0), None)
        elif tag == b"LIST" and data[at : at + 4] == b"movi":
            movi = at, size
        elif tag == b"idx1":
            index = [struct.unpack_from("<4sIII", data, at + i) for i in range(0, size - size % 16, 16)]
    if movi and index:
        first = index[0][2]
        base = 0 if data[first : first + 4] == index[0][0] else movi[0]
        out["frames"] = [(base + off + 8, size) for tag, _, off, size in index if tag[2:] in (b"dc", b"db")]
    elif movi:
        out["frames"] = [(a, s) for t, a, s in _chunks(data, movi[0] + 4, movi[0] + movi[1]) if t[2:] in (b"dc", b"db")]
    return out


# The usual Huffman tables of JPEG, by (class and number): symbols of each length, and the symbols. Of the AC
# tables the symbols that aren't listed follow in ascending order (runs to 15 of sizes 1 to 10, end of block, sixteen zeros).
_USUAL = {
    0x00: ("00 01 05 01 01 01 01 01 01 00 00 00 00 00 00 00", "00 01 02 03 04 05 06 07 08 09 0a 0b"),
    0x01: ("00 03 01 01 01 01 01 01 01 01 01 00 00 00 00 00", "00 01 02 03 04 05 06 07 08 09 0a 0b"),
    0x10: ("00 02 01 03 03 02 04 03 05 05 04 04 00 00 01 7d",
           "01 02 03 00 04 11 05 12 21 31 41 06 13 51 61 07 22 71 14 32 81 91 a1 08 23 42 b1 c1 15 52 d1 f0 24 33 62 72 82 09 0a"),
    0x11: ("00 02 01 02 04 04 03 04 07 05 04 04 00 01 02 77",
           "00 01 02 03 11 04 05 21 31 06 12 41 51 07 61 71 13 22 32 81 08 14 42 91 a1 b1 c1 09 23 33 52 f0 15 62 72 d1 0a 16 24 34 e1 25 f1"),
}


def usual_tables() -> dict[int, tuple[bytes, bytes]]:
    every = sorted({0x00, 0xF0} | {run << 4 | size for run in range(16) for size in range(1, 11)})
    out = {}
    for number, (counts, symbols) in _USUAL.items():
        known = bytes.fromhex(symbols)
        out[number] = bytes.fromhex(counts), known + (bytes(x for x in every if x not in known) if number >= 0x10 else b"")
    return out


def _huffman(counts: bytes, symbols: bytes) -> dict[tuple[int, int], int]:
    table, code, k = {}, 0, 0
    for length, n in enumerate(counts, 1):
        for _ in range(n):
            table[length, code] = symbols[k]
            code, k = code + 1, k + 1
        code <<= 1
    return table


class _Bits:
    """Reads a scan without restart markers and stuffed bytes; zeros after its end, for a while."""

    def __init__(self, raw: bytes):
        self.raw, self.at, self.held, self.n = raw, 0, 0, 0

    def take(self, n: int) -> int:
        while self.n < n:
            if self.at > len(self.raw) + 8:
                raise ValueError("scan too short")
            self.held = (self.held & ((1 << self.n) - 1)) << 8 | (self.raw[self.at] if self.at < len(self.raw) else 0)
            self.at, self.n = self.at + 1, self.n + 8
        self.n -= n
        return self.held >> self.n & ((1 << n) - 1)

    def symbol(self, table: dict) -> int:
        code = length = 0
        while (length, code) not in table:
            code, length = code << 1 | self.take(1), length + 1
            if length > 16:
                raise ValueError("bad Huffman code")
        return table[length, code]

    def value(self, size: int) -> int:
        v = self.take(size) if size else 0
        return v if not size or v >> (size - 1) else v - (1 << size) + 1


def _symbols(scan: bytes, units: int, parts: list[tuple[int, dict, dict]], restart: int) -> list[np.ndarray]:
    """Coefficients of a baseline scan, symbol by symbol: of each component (blocks in a unit, DC table, AC table) its blocks in order."""
    out = [np.zeros((units * n, 64), np.int64) for n, _, _ in parts]
    pieces = re.split(rb"\xff[\xd0-\xd7]", scan)
    per = restart or units
    for first in range(0, units, per):
        if first // per >= len(pieces):
            raise ValueError("scan too short")
        bits, pred = _Bits(pieces[first // per].replace(b"\xff\x00", b"\xff")), [0] * len(parts)
        for unit in range(first, min(units, first + per)):
            for c, (n, dc, ac) in enumerate(parts):
                for block in range(unit * n, unit * n + n):
                    pred[c] += bits.value(bits.symbol(dc))
                    out[c][block, 0], k = pred[c], 1
                    while k < 64:
                        run, size = divmod(bits.symbol(ac), 16)
                        if not size:
                            if run != 15:
                                break
                            k += 16
                            continue
                        k += run
                        out[c][block, k] = bits.value(size)
                        k += 1
    return out


def decode_frame(jpeg: bytes) -> tuple[np.ndarray, np.ndarray, int, int]:
    """(coefficients in zigzag order by block, row by row, quantisers, width, height) of the brightness of a baseline JPEG."""
    if jpeg[:2] != b"\xff\xd8":
        raise ValueError("no JPEG")
    at, tables, quant, frame, restart, chosen = 2, {}, {}, None, 0, b""
    while True:
        while jpeg[at : at + 2] == b"\xff\xff":
            at += 1
        marker, n = jpeg[at + 1], struct.unpack_from(">H", jpeg, at + 2)[0]
        body = jpeg[at + 4 : at + 2 + n]
        at += 2 + n
        if marker == 0xDB:
            i = 0
            while i < len(body):
                wide = body[i] >> 4  # two bytes a number
                quant[body[i] & 15] = np.frombuffer(body, ">u2" if wide else np.uint8, 64, i + 1).astype(np.int64)
                i += 1 + 64 * (1 + wide)
        elif marker in (0xC0, 0xC1):
            height, width, count = struct.unpack_from(">HHB", body, 1)
            frame = width, height, [body[6 + 3 * i : 9 + 3 * i] for i in range(count)]  # id, sampling, quantiser
        elif 0xC2 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
            raise ValueError("not a baseline frame")
        elif marker == 0xC4:
            i = 0
            while i < len(body):
                counts = body[i + 1 : i + 17]
                tables[body[i]] = counts, body[i + 17 : i + 17 + sum(counts)]
                i += 17 + sum(counts)
        elif marker == 0xDD:
            restart = struct.unpack(">H", body)[0]
        elif marker == 0xDA:
            chosen = {body[1 + 2 * i]: body[2 + 2 * i] for i in range(body[0])}
            break
    if frame is None:
        raise ValueError("no frame header")
    width, height, parts = frame
    end = jpeg.rfind(b"\xff\xd9")
    scan = jpeg[at : end if end >= at else len(jpeg)]
    q = quant[parts[0][2]]
    n_blocks = -(-width // 8) * -(-height // 8)
    if len(parts) == 1 and restart == 1 and len(scan) == 130 * n_blocks - 2 and all(tables.get(t) == (_ALONE, b"\x09") for t in (0, 16)):
        return np.frombuffer(scan + b"\xff\xd0", np.uint8).reshape(n_blocks, 130)[:, 1:128:2].astype(np.int64) + 256, q, width, height
    if [p[0] for p in parts] != list(chosen):
        raise ValueError("components in several scans")
    tables = {k: _huffman(*v) for k, v in (usual_tables() | tables).items()}
    h, v = [(p[1] >> 4, p[1] & 15) for p in parts][0] if len(parts) > 1 else (1, 1)
    across, down = max(p[1] >> 4 for p in parts) if len(parts) > 1 else 1, max(p[1] & 15 for p in parts) if len(parts) > 1 else 1
    wide, high = -(-width // (8 * across)), -(-height // (8 * down))
    spec = [((p[1] >> 4) * (p[1] & 15) if len(parts) > 1 else 1, tables[chosen[p[0]] >> 4], tables[16 | chosen[p[0]] & 15]) for p in parts]
    coef = _symbols(scan, wide * high, spec, restart)[0]
    # the units' blocks row by row, without those that only fill up the last units
    grid = coef.reshape(high, wide, v, h, 64).transpose(0, 2, 1, 3, 4).reshape(high * v, wide * h, 64)
    return grid[: -(-height * v // (8 * down)), : -(-width * h // (8 * across))].reshape(-1, 64), q, width, height


def pixels(coef: np.ndarray, quant: np.ndarray) -> np.ndarray:
    """Blocks of 8x8 grey values; whole numbers below 2**53 all the way, hence the same in any order of summing."""
    flat = np.zeros(coef.shape)
    flat[:, ZIGZAG] = coef * quant
    rows = flat.reshape(-1, 8) @ BASIS
    cols = BASIS.T @ rows.reshape(-1, 8, 8)
    return np.clip(np.floor((cols + 2.0**23) / 2.0**24) + 128, 0, 255).astype(np.uint8)


def histograms(frames: list[np.ndarray], bins: int = 16) -> np.ndarray:
    step = 256 // bins
    return np.stack([np.bincount((f // step).ravel(), minlength=bins) for f in frames]) if frames else np.zeros((0, bins), np.int64)


def cuts(hist: np.ndarray, window: int = 8, spread: float = 3.0, floor: float = 0.02) -> list[int]:
    """First frames of clips. The threshold adapts to the last ``window`` distances of the clip."""
    if not len(hist):
        return []
    dist = np.abs(np.diff(hist, axis=0)).sum(1) / (2.0 * np.maximum(1, hist[1:].sum(1)))
    out = [0]
    for i, d in enumerate(dist, 1):
        past = dist[max(out[-1], i - 1 - window) : i - 1]
        if len(past) and d > max(floor, past.mean() + spread * past.std()):
            out.append(i)
    return out


#: What a frame that is cut off or no baseline JPEG raises.
UNREADABLE = (ValueError, KeyError, IndexError, struct.error)


def clips(data: bytes) -> tuple[bytes, list[dict], np.ndarray]:
    """(payload read back, clip rows with times, histogram by frame) of an AVI."""
    info = parse_avi(data)
    stored, hist, broken = [], [], 0
    for at, size in info["frames"]:
        try:
            coef, quant, _, _ = decode_frame(data[at : at + size])
            stored.append((coef - 256).astype(np.uint8).tobytes())
            hist.append(histograms([pixels(coef, quant)])[0])
        except UNREADABLE:
            broken += 1
            hist.append(hist[-1] if hist else None)
    if broken == len(hist):
        raise ValueError("no readable frame")
    shown = next(x for x in hist if x is not None)
    hist = np.stack([shown if x is None else x for x in hist])
    starts = cuts(hist)
    rows = [
        {"clip": i, "first_frame": a, "n_frames": b - a, "start_s": a / info["fps"], "end_s": b / info["fps"], "error": f"{broken} broken frames" if broken else None}
        for i, (a, b) in enumerate(zip(starts, [*starts[1:], len(hist)], strict=True))
    ]
    return b"".join(stored)[: info["length"]], rows, hist


def payload_of(text: str | None) -> bytes:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + b"\x00" * (BLOCK if not raw else -len(raw) % BLOCK)


def encode_column(docs: DataFrame) -> DataFrame:
    """(doc_id, media binary): each text stored as an AVI."""

    def run(batches):
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "media": [encode_avi(payload_of(t)) for t in b["text"]]})

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, media binary")


def rows_of(media: bytes | None) -> list[dict]:
    if not media:
        return [{"error": "no media"}]
    try:
        return clips(media)[1]
    except UNREADABLE as e:
        return [{"error": str(e) or "unreadable"}]


def clip_rows(media: DataFrame) -> DataFrame:
    """Timed clip rows of a (doc_id, media) table."""
    names = ["doc_id", "clip", "first_frame", "n_frames", "start_s", "end_s", "error"]

    def run(batches):
        for b in batches:
            rows = [{"doc_id": None if pd.isna(d) else int(d)} | r for d, m in zip(b["doc_id"], b["media"], strict=True) for r in rows_of(m)]
            out = pd.DataFrame(rows, columns=names)
            whole = dict.fromkeys(names[:4], "Int64") | {"start_s": float, "end_s": float}
            yield out.astype(whole)

    return media.select("doc_id", "media").mapInPandas(run, "doc_id long, clip int, first_frame int, n_frames int, start_s double, end_s double, error string")


def digest_row(text: str | None) -> tuple:
    media = encode_avi(payload_of(text))
    back, rows, hist = clips(media)
    total = hist.sum(0)
    feature = f"frames={len(hist)};clips={','.join(f'{r['start_s']:.2f}-{r['end_s']:.2f}' for r in rows)};hist={','.join(map(str, total))}"
    n = len((text or "").encode("utf-8", "surrogatepass"))
    return n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-BLOCK:]), len(media), hashlib.sha256(media).hexdigest(), feature


COLUMNS = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def op8_media(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    names = [c.split()[0] for c in COLUMNS.split(", ")]

    def run(batches):
        for b in batches:
            out = pd.DataFrame([digest_row(t) for t in b["text"]], columns=names)
            out.insert(0, "doc_id", b["doc_id"].to_numpy())
            yield out

    return docs.mapInPandas(run, f"doc_id long, {COLUMNS}")
