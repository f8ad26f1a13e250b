import hashlib
import struct
import zlib

import numpy as np
from pyspark.sql import functions as F
from twinline.llm import media


def test_round_trip_of_any_bytes():
    rng = np.random.default_rng(1)
    for n in (64, 128, 2048, 2112, 9984):
        payload = rng.integers(0, 256, n, np.uint8).tobytes()
        back, rows, hist = media.clips(media.encode_avi(payload))
        assert back == payload and len(hist) == -(-n // media.FRAME)
        assert rows[0]["first_frame"] == 0 and sum(r["n_frames"] for r in rows) == len(hist)
    assert media.payload_of(None) == bytes(64) and len(media.payload_of("a" * 64)) == 64


def test_reading_without_index_gives_the_same_frames():
    avi = media.encode_avi(bytes(range(256)) * 20)
    cut = avi.replace(b"idx1", b"JUNK")
    assert media.parse_avi(cut)["frames"] == media.parse_avi(avi)["frames"]


def test_general_huffman_decoder_agrees_with_the_fast_way():
    frame = media.encode_frame(bytes(i % 251 for i in range(media.FRAME)))
    fast, quant, w, h = media.decode_frame(frame)
    scan = frame[len(media._HEAD) : -2]
    table = media._huffman(media._ALONE, b"\x09")
    assert (media._symbols(scan, w * h // 64, [(1, table, table)], 1)[0] == fast).all()
    assert (quant == 1).all()


def test_other_writers_tables():
    # DC: size 3 as '00', size 0 as '01'; AC: end of block '00', (1, 2) as '01'
    dc, ac = media._huffman(bytes([0, 2] + [0] * 14), b"\x03\x00"), media._huffman(bytes([0, 2] + [0] * 14), b"\x00\x12")
    bits = "00" + "101" + "01" + "10" + "00" + "01" + "00"  # DC 5, one zero, AC 2, end; DC +0, end
    raw = int(bits.ljust(24, "1"), 2).to_bytes(3, "big")
    (got,) = media._symbols(raw, 2, [(1, dc, ac)], 0)
    assert got[0, 0] == 5 and got[0, 2] == 2 and got[1, 0] == 5 and abs(got).sum() == 12


def test_zigzag_and_idct():
    assert media.ZIGZAG[:10].tolist() == [0, 1, 8, 16, 9, 2, 3, 10, 17, 24] and sorted(media.ZIGZAG) == list(range(64))
    flat = np.zeros((1, 64), np.int64)
    flat[0, 0] = 80
    assert (media.pixels(flat, np.ones(64, np.int64)) == 138).all()


def test_shots_at_histogram_jumps():
    dark, light = np.array([90, 10, 0, 0]), np.array([0, 0, 20, 80])
    assert media.cuts(np.stack([dark] * 5 + [light] * 4 + [dark] * 3)) == [0, 5, 9]
    assert media.cuts(np.zeros((0, 4))) == []


def test_awkward_table(spark, awkward, empty):
    enc = media.encode_column(awkward)
    assert enc.count() == awkward.count() and media.encode_column(empty).count() == 0
    rows = media.clip_rows(enc).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in awkward.collect()}
    assert struct.unpack_from("<I", media.encode_avi(bytes(64)), 4)[0] == len(media.encode_avi(bytes(64))) - 8


class Writer:
    """Bits of a baseline scan with the usual tables."""

    def __init__(self):
        self.bits = ""
        self.codes = {k: {sym: f"{code:0{n}b}" for (n, code), sym in media._huffman(*t).items()} for k, t in media.usual_tables().items()}

    def number(self, x, size):
        self.bits += f"{x if x > 0 else x + (1 << size) - 1:0{size}b}" if size else ""

    def block(self, coef, pred, table):
        size = abs(coef[0] - pred).bit_length()
        self.bits += self.codes[table][size]
        self.number(coef[0] - pred, size)
        run = 0
        for x in coef[1:]:
            if not x:
                run += 1
                continue
            while run > 15:
                self.bits += self.codes[16 | table][0xF0]
                run -= 16
            size = abs(x).bit_length()
            self.bits += self.codes[16 | table][run << 4 | size]
            self.number(x, size)
            run = 0
        self.bits += self.codes[16 | table][0] if run else ""
        return coef[0]

    def scan(self):
        bits = self.bits + "1" * (-len(self.bits) % 8)
        self.bits = ""
        return int(bits, 2).to_bytes(len(bits) // 8, "big").replace(b"\xff", b"\xff\x00")


def colour_jpeg(width, height, luma, rng, restart=0):
    """4:2:0, without Huffman tables; ``luma`` are blocks of a grid that fills whole units."""
    wide, high = -(-width // 16), -(-height // 16)
    w, out, pred = Writer(), b"", [0, 0, 0]
    for unit in range(wide * high):
        if restart and unit and unit % restart == 0:
            out += w.scan() + bytes([0xFF, 0xD0 + (unit // restart - 1) % 8])
            pred = [0, 0, 0]
        y, x = divmod(unit, wide)
        for dy in (0, 1):
            for dx in (0, 1):
                pred[0] = w.block(luma[2 * y + dy][2 * x + dx], pred[0], 0)
        for c in (1, 2):
            pred[c] = w.block([int(rng.integers(-50, 50))] + [0] * 62 + [3], pred[c], 1)
    head = media._segment(0xDB, b"\x00" + bytes([2] * 64)) + media._segment(0xDB, b"\x01" + bytes([9] * 64))
    head += media._segment(0xC0, struct.pack(">BHHB", 8, height, width, 3) + bytes([1, 0x22, 0, 2, 0x11, 1, 3, 0x11, 1]))
    head += (media._segment(0xDD, struct.pack(">H", restart)) if restart else b"") + media._segment(0xDA, bytes([3, 1, 0, 2, 0x11, 3, 0x11, 0, 63, 0]))
    return b"\xff\xd8" + head + out + w.scan() + b"\xff\xd9"


def test_colour_frames_without_tables():
    rng = np.random.default_rng(5)
    for width, height, restart in ((40, 24, 0), (16, 16, 0), (33, 50, 2)):
        rows, cols = 2 * -(-height // 16), 2 * -(-width // 16)
        luma = [[[int(v) for v in np.where(rng.random(64) < 0.2, rng.integers(-200, 200, 64), 0)] for _ in range(cols)] for _ in range(rows)]
        coef, quant, w, h = media.decode_frame(colour_jpeg(width, height, luma, rng, restart))
        want = [luma[y][x] for y in range(-(-height // 8)) for x in range(-(-width // 8))]
        assert coef.tolist() == want and (quant == 2).all() and (w, h) == (width, height)


def test_usual_tables_are_complete():
    for number, (counts, symbols) in media.usual_tables().items():
        assert sum(counts) == len(symbols) == len(set(symbols)) == (12 if number < 16 else 162)


def test_media_that_cannot_be_read(spark):
    good = media.encode_avi(bytes(range(256)) * 24)
    half = good[: len(good) // 2]
    broken = bytearray(good)
    at, size = media.parse_avi(good)["frames"][1]
    broken[at : at + size] = bytes(size)
    empty_avi = media._chunk(b"RIFF", b"AVI ")
    rows = [(1, good), (2, None), (3, b""), (4, b"junk"), (5, half), (6, bytes(broken)), (None, good[:40]), (8, empty_avi), (8, empty_avi)]
    got = {}
    for r in media.clip_rows(spark.createDataFrame(rows, "doc_id long, media binary").withColumn("clip", F.lit("clash"))).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sum(r.n_frames for r in got[1]) == 3 and got[1][0].error is None
    assert [got[i][0].error for i in (2, 3, 4)] == ["no media", "no media", "not a RIFF AVI"] and all(got[i][0].clip is None for i in (2, 3, 4, 8, None))
    assert 1 <= sum(r.n_frames for r in got[5]) < 3 and len(got[8]) == 2 and got[8][0].error == "no readable frame"
    assert sum(r.n_frames for r in got[6]) == 3 and got[6][0].error == "1 broken frames"


def test_query_by_hand(spark, sf, documents, awkward, empty, tmp_path):
    def want(text):
        raw = (text or "").encode()
        payload = raw + bytes(64 if not raw else -len(raw) % 64)
        return len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:])

    for r in media.op8_media(spark, sf).collect():
        text = next(d["text"] for d in documents if d["doc_id"] == r.doc_id)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == want(text)
        stored = media.encode_avi(media.payload_of(text))
        assert (r.media_bytes, r.media_sha256) == (len(stored), hashlib.sha256(stored).hexdigest())
    awkward.write.parquet(f"{tmp_path}/a/documents.parquet")
    empty.write.parquet(f"{tmp_path}/e/documents.parquet")
    rows = media.op8_media(spark, f"{tmp_path}/a").collect()
    texts = [r.text for r in awkward.collect()]
    assert sorted((r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in rows) == sorted(map(want, texts))
    assert len({(r.payload_sha256, r.media_sha256, r.feature) for r in rows}) == len({t or "" for t in texts})
    assert media.op8_media(spark, f"{tmp_path}/e").count() == 0
