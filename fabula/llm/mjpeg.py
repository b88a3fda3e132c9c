"""Media columns: AVI motion-JPEG files in a binary column, and their shots as timed clip rows.

Writing: bytes become the quantised coefficients of baseline JPEG frames, 24 x 24 samples of one
component, nine blocks of 64. A byte b is the coefficient whose eight magnitude bits are b: b itself
from 128 on, b - 255 below. All these have size category 8, so the frame's Huffman tables hold the
one symbol of that category with the one-bit code 0, and a coefficient takes nine bits. Each block
is a restart interval, so its first coefficient is not predicted. What a reader of JPEG coefficients
gets back is exactly what was stored.

Reading: chunks of the RIFF file by its idx1 index (by a walk through the movi list where there is
none), then the frames. Frames like those above are unpacked all at once; any other baseline
sequential frame goes through a general Huffman decoder, with the default tables of motion JPEG
where a frame brings none, dequantisation and an inverse cosine transform to luma.

Shots: histograms of neighbouring frames differ by half the sum of their bins' differences; a frame
begins a shot where this exceeds both FLOOR and the mean of the last SPAN differences by SIGMAS of
their standard deviations. Histograms are those of decoded luma for all frames; the transform is a
product of whole numbers, so equal frames give equal samples on every machine. A clip row has its
frames and times.

Null texts are stored as empty ones: one frame of padding. Null ids stay null, repeated rows repeat
their result, other columns are not read, an empty table has no rows.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fabula.llm.memory import releasing, small_batches

#: Bytes of a frame, side in samples, padding byte, microseconds of a frame; bins, least difference, deviations and span of the shot rule.
FRAME, SIDE, PAD, MICROS, BINS, FLOOR, SIGMAS, SPAN = 576, 24, 255, 40_000, 16, 0.2, 3.0, 8
BLOCKS = FRAME // 64

_ONE_CODE = bytes([1] + [0] * 15 + [8])
#: Everything of a frame before its entropy-coded bytes.
HEAD = (
    b"\xff\xd8" + b"\xff\xdb" + struct.pack(">HB", 67, 0) + bytes([1]) * 64 + b"\xff\xc0" + struct.pack(">HBHHBBBB", 11, 8, SIDE, SIDE, 1, 1, 0x11, 0)
    + b"\xff\xc4" + struct.pack(">HB", 20, 0x00) + _ONE_CODE + b"\xff\xc4" + struct.pack(">HB", 20, 0x10) + _ONE_CODE + b"\xff\xdd" + struct.pack(">HH", 4, 1)
    + b"\xff\xda" + struct.pack(">HBBBBBB", 8, 1, 1, 0x00, 0, 63, 0)
)
_BODY = BLOCKS * 72 + 2 * (BLOCKS - 1) + 2


def padded(data: bytes) -> np.ndarray:
    """data and bytes 255 up to a positive multiple of FRAME."""
    out = np.full(max(1, -(-len(data) // FRAME)) * FRAME, PAD, np.uint8)
    out[: len(data)] = np.frombuffer(data, np.uint8)
    return out


def _nine_bits(x: np.ndarray) -> np.ndarray:
    """Rows of 64 bytes -> rows of 72: a zero bit before each byte."""
    b = x.reshape(-1, 8)
    out = np.zeros((len(b), 9), np.uint8)
    for k in range(8):
        out[:, k] |= b[:, k] >> (k + 1)
        out[:, k + 1] = b[:, k] << (7 - k)  # uint8: the bits already written fall off
    return out.reshape(len(x), 72)


def _eight_bits(x: np.ndarray) -> np.ndarray:
    """The inverse; raises where a code is not the one-bit 0."""
    b = x.reshape(-1, 9)
    out = np.empty((len(b), 8), np.uint8)
    for k in range(8):
        if (b[:, k] & (128 >> k)).any():
            raise ValueError("a code outside the table")
        out[:, k] = (b[:, k] << (k + 1)) | (b[:, k + 1] >> (7 - k))
    return out.reshape(len(x), 64)


def write_frames(payload: np.ndarray) -> list[bytes]:
    """JPEG frames of a padded payload."""
    blocks = _nine_bits(payload.reshape(-1, 64)).reshape(-1, BLOCKS, 72)
    body = np.empty((len(blocks), BLOCKS, 74), np.uint8)
    body[:, :, :72], body[:, :, 72] = blocks, 0xFF
    body[:, :, 73] = [*(0xD0 + k for k in range(BLOCKS - 1)), 0xD9]
    stuffed = (blocks == 0xFF).any((1, 2))
    out = []
    for k, odd in enumerate(stuffed.tolist()):
        if odd:
            out.append(HEAD + b"".join(blocks[k, i].tobytes().replace(b"\xff", b"\xff\x00") + body[k, i, 72:].tobytes() for i in range(BLOCKS)))
        else:
            out.append(HEAD + body[k].tobytes())
    return out


def _chunk(name: bytes, data: bytes) -> bytes:
    return name + struct.pack("<I", len(data)) + data + b"\0" * (len(data) & 1)


def write_avi(frames: list[bytes]) -> bytes:
    n, most = len(frames), max(map(len, frames))
    main = struct.pack("<14I", MICROS, most * 1_000_000 // MICROS, 0, 0x10, n, 0, 1, most, SIDE, SIDE, 0, 0, 0, 0)
    stream = struct.pack("<4s4sIHHIIIIIIII4H", b"vids", b"MJPG", 0, 0, 0, 0, MICROS, 1_000_000, 0, n, most, 0xFFFFFFFF, 0, 0, 0, SIDE, SIDE)
    form = struct.pack("<IiiHH4sIiiII", 40, SIDE, SIDE, 1, 8, b"MJPG", SIDE * SIDE, 0, 0, 0, 0)
    head = _chunk(b"LIST", b"hdrl" + _chunk(b"avih", main) + _chunk(b"LIST", b"strl" + _chunk(b"strh", stream) + _chunk(b"strf", form)))
    size = np.array([len(f) for f in frames], np.uint32)
    at = np.cumsum(8 + size + (size & 1)) - (8 + size + (size & 1)) + 4
    index = np.empty((n, 4), "<u4")
    index[:] = np.stack((np.full(n, int.from_bytes(b"00dc", "little")), np.full(n, 0x10), at, size), 1)
    movi = b"movi" + b"".join([_chunk(b"00dc", f) for f in frames])
    body = b"AVI " + head + _chunk(b"LIST", movi) + _chunk(b"idx1", index.tobytes())
    return b"RIFF" + struct.pack("<I", len(body)) + body


def read_avi(data: bytes) -> tuple[list[bytes], int]:
    """The video frames of a file and the microseconds of one."""
    if data[:4] != b"RIFF" or data[8:12] != b"AVI ":
        raise ValueError("not an AVI file")
    micros, movi, index, at, end = MICROS, None, b"", 12, min(len(data), 8 + struct.unpack_from("<I", data, 4)[0])
    while at + 8 <= end:
        name, size = data[at : at + 4], struct.unpack_from("<I", data, at + 4)[0]
        if name == b"LIST" and data[at + 8 : at + 12] == b"hdrl" and (k := data.find(b"avih", at, at + 8 + size)) >= 0:
            micros = struct.unpack_from("<I", data, k + 8)[0] or MICROS
        elif name == b"LIST" and data[at + 8 : at + 12] == b"movi":
            movi = (at + 8, at + 8 + size)
        elif name == b"idx1":
            index = data[at + 8 : at + 8 + size]
        at += 8 + size + (size & 1)
    if movi is None:
        return [], micros
    video = lambda name: name[2:] in (b"dc", b"db") and name[:2].isdigit()
    if index:
        rows = np.frombuffer(index[: len(index) // 16 * 16], "<u4").reshape(-1, 4)
        # offsets count from the list's name or from the file's start
        base = movi[0] if len(rows) and rows[0, 2] < movi[0] else 0
        return [data[base + o + 8 : base + o + 8 + s] for n, _, o, s in rows.tolist() if video(n.to_bytes(4, "little"))], micros
    out, at = [], movi[0] + 4
    while at + 8 <= movi[1]:
        name, size = data[at : at + 4], struct.unpack_from("<I", data, at + 4)[0]
        if name == b"LIST":
            at += 12
            continue
        if video(name):
            out.append(data[at + 8 : at + 8 + size])
        at += 8 + size + (size & 1)
    return out, micros


def unpack(frames: list[bytes]) -> np.ndarray | None:
    """The stored bytes of frames as write_frames makes them; None if any is another kind."""
    whole = len(HEAD) + _BODY
    if not all(f.startswith(HEAD) for f in frames):
        return None
    out = np.empty((len(frames), BLOCKS, 72), np.uint8)
    plain = [k for k, f in enumerate(frames) if len(f) == whole]
    if plain:
        out[plain] = np.frombuffer(b"".join([frames[k] for k in plain]), np.uint8).reshape(len(plain), whole)[:, len(HEAD) :].reshape(len(plain), BLOCKS, 74)[:, :, :72]
    for k in {*range(len(frames))} - {*plain}:
        at, f = len(HEAD), frames[k]
        for i in range(BLOCKS):
            mark = bytes([0xFF, 0xD0 + i if i < BLOCKS - 1 else 0xD9])
            end = f.index(mark, at)
            out[k, i] = np.frombuffer(f[at:end].replace(b"\xff\x00", b"\xff"), np.uint8)
            at = end + 2
    return _eight_bits(out.reshape(-1, 72)).ravel()


# The default Huffman tables of motion JPEG (code counts by length, then symbols), and the zigzag order by its rule.
_DC_LUMA = bytes([0, 1, 5, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0, *range(12)])
_DC_CHROMA = bytes([0, 3, 1, 1, 1, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, *range(12)])
_AC_LUMA = bytes.fromhex(
    "0002010303020403050504040000017d"
    "01020300041105122131410613516107227114328191a1082342b1c11552d1f02433627282090a161718191a25262728292a3435363738393a43444546474849"
    "4a535455565758595a636465666768696a737475767778797a838485868788898a92939495969798999aa2a3a4a5a6a7a8a9aab2b3b4b5b6b7b8b9bac2c3c4c5"
    "c6c7c8c9cad2d3d4d5d6d7d8d9dae1e2e3e4e5e6e7e8e9eaf1f2f3f4f5f6f7f8f9fa"
)
_AC_CHROMA = bytes.fromhex(
    "00020102040403040705040400010277"
    "0001020311040521310612415107617113223281081442 91a1b1c109233352f0156272d10a162434e125f11718191a262728292a35363738393a434445464748"
    "494a535455565758595a636465666768696a737475767778797a82838485868788898a92939495969798999aa2a3a4a5a6a7a8a9aab2b3b4b5b6b7b8b9bac2c3"
    "c4c5c6c7c8c9cad2d3d4d5d6d7d8d9dae2e3e4e5e6e7e8e9eaf2f3f4f5f6f7f8f9fa".replace(" ", "")
)
ZIGZAG = sorted(range(64), key=lambda k: (k // 8 + k % 8, (k // 8 if (k // 8 + k % 8) % 2 else k % 8)))
_COSINE = np.array([[np.sqrt((1 if k else 0.5) / 4) * np.cos((2 * n + 1) * k * np.pi / 16) for n in range(8)] for k in range(8)])


def _table(spec: bytes) -> dict[tuple[int, int], int]:
    """(length, code) -> symbol."""
    out, code, at = {}, 0, 16
    for length in range(1, 17):
        for _ in range(spec[length - 1]):
            out[length, code] = spec[at]
            code, at = code + 1, at + 1
        code <<= 1
    return out


class _Bits:
    def __init__(self, data: bytes) -> None:
        self.value, self.left = int.from_bytes(data, "big"), 8 * len(data)

    def take(self, n: int) -> int:
        if n > self.left:
            raise ValueError("the scan ends early")
        self.left -= n
        return self.value >> self.left & ((1 << n) - 1)

    def symbol(self, table: dict[tuple[int, int], int]) -> int:
        code = 0
        for length in range(1, 17):
            code = code << 1 | self.take(1)
            if (s := table.get((length, code))) is not None:
                return s
        raise ValueError("a code outside the table")

    def number(self, size: int) -> int:
        if not size:
            return 0
        v = self.take(size)
        return v if v >> (size - 1) else v - (1 << size) + 1


def coefficients(jpeg: bytes) -> tuple[dict[int, np.ndarray], dict[int, dict], tuple[int, int]]:
    """Quantised coefficients by component (block rows x block columns x 64, in zigzag order), the components' headers with their quantisers, and height and width. Baseline sequential frames only."""
    quant: dict[int, list[int]] = {}
    dc, ac = {0: _table(_DC_LUMA), 1: _table(_DC_CHROMA)}, {0: _table(_AC_LUMA), 1: _table(_AC_CHROMA)}
    comps: dict[int, dict] = {}
    every, at, shape = 0, 2, (0, 0)
    while at + 4 <= len(jpeg):
        kind, size = jpeg[at + 1], struct.unpack_from(">H", jpeg, at + 2)[0]
        part = jpeg[at + 4 : at + 2 + size]
        if kind == 0xDB:
            while part:
                wide, k = part[0] >> 4, part[0] & 15
                quant[k] = list(struct.unpack_from(">64H" if wide else ">64B", part, 1))
                part = part[129 if wide else 65 :]
        elif kind == 0xC4:
            while part:
                n = 17 + sum(part[1:17])
                (ac if part[0] >> 4 else dc)[part[0] & 15] = _table(part[1:n])
                part = part[n:]
        elif kind in (0xC0, 0xC1):
            shape = struct.unpack_from(">HH", part, 1)
            for k in range(part[5]):
                i, hv, q = part[6 + 3 * k : 9 + 3 * k]
                comps[i] = {"h": hv >> 4, "v": hv & 15, "q": q}
        elif 0xC2 <= kind <= 0xCF and kind not in (0xC8, 0xCC):
            raise ValueError("not a baseline frame")
        elif kind == 0xDD:
            every = struct.unpack(">H", part[:2])[0]
        elif kind == 0xDA:
            for k in range(part[0]):
                comps[part[1 + 2 * k]] |= {"dc": part[2 + 2 * k] >> 4, "ac": part[2 + 2 * k] & 15}
            at += 2 + size
            break
        at += 2 + size
    end = jpeg.rfind(b"\xff\xd9")
    parts, start, k, end = [], at, at, end if end >= at else len(jpeg)
    while (k := jpeg.find(b"\xff", k, end)) >= 0 and k + 1 < end:
        if 0xD0 <= jpeg[k + 1] <= 0xD7:
            parts.append(jpeg[start:k])
            start = k + 2
        k += 2
    parts.append(jpeg[start:end])
    wide, high = max(c["h"] for c in comps.values()), max(c["v"] for c in comps.values())
    if len(comps) == 1:
        wide = high = 1
        for c in comps.values():
            c["h"] = c["v"] = 1
    cols, rows = -(-shape[1] // (8 * wide)), -(-shape[0] // (8 * high))
    out = {i: np.zeros((rows * c["v"], cols * c["h"], 64), np.int32) for i, c in comps.items()}
    bits, last, part = _Bits(b""), {}, iter(parts)
    for m in range(rows * cols):
        if m == 0 or every and m % every == 0:
            bits, last = _Bits(next(part).replace(b"\xff\x00", b"\xff")), dict.fromkeys(comps, 0)
        for i, c in comps.items():
            for v in range(c["v"]):
                for h in range(c["h"]):
                    block = out[i][m // cols * c["v"] + v, m % cols * c["h"] + h]
                    last[i] = block[0] = last[i] + bits.number(bits.symbol(dc[c["dc"]]))
                    k = 1
                    while k < 64:
                        run, size = divmod(bits.symbol(ac[c["ac"]]), 16)
                        if not size and run != 15:
                            break
                        k += run
                        if size:
                            block[k] = bits.number(size)
                        k += 1
    for c in comps.values():
        c["table"] = quant[c["q"]]
    return out, comps, shape


#: The inverse cosine transform of a block, from coefficients in zigzag order to samples by row, in units of 2 ** -13. Whole numbers, so that sums are exact in any order.
_SCALE = 1 << 13
_INVERSE = np.rint(np.einsum("ku,lv->kluv", _COSINE, _COSINE).reshape(64, 64)[ZIGZAG] * _SCALE)


def samples(blocks: np.ndarray) -> np.ndarray:
    """8-bit samples of dequantised blocks (rows of 64 coefficients)."""
    out = np.empty(blocks.shape, np.uint8)
    for k in range(0, len(blocks), 8192):
        x = blocks[k : k + 8192].astype(np.float64) @ _INVERSE
        out[k : k + 8192] = np.clip(np.floor(x / _SCALE + 0.5) + 128, 0, 255)
    return out


def luma(jpeg: bytes) -> np.ndarray:
    """The first component of a frame as 8-bit samples."""
    blocks, comps, (high, wide) = coefficients(jpeg)
    i = next(iter(comps))
    rows, cols = blocks[i].shape[:2]
    x = samples((blocks[i] * np.array(comps[i]["table"])).reshape(-1, 64)).reshape(rows, cols, 8, 8)
    return x.transpose(0, 2, 1, 3).reshape(rows * 8, cols * 8)[:high, :wide]


def stored_luma(stored: np.ndarray) -> np.ndarray:
    """The samples of frames whose stored bytes unpack has read: the same as luma of each, all at once, block by block."""
    c = stored.reshape(-1, 64).astype(np.int16)
    return samples(np.where(c < 128, c - 255, c)).ravel()


def histograms(luma: np.ndarray, frames: int) -> np.ndarray:
    """Shares of BINS levels by frame; luma: samples of all frames, one after another."""
    per = len(luma) // frames
    level = luma.reshape(frames, per) >> (8 - BINS.bit_length() + 1)
    return np.bincount((np.arange(frames)[:, None] * BINS + level).ravel(), minlength=frames * BINS).reshape(frames, BINS) / per


def shots(h: np.ndarray) -> np.ndarray:
    """First frames of all shots."""
    d = np.abs(np.diff(h, axis=0)).sum(1) / 2
    if not len(d):
        return np.zeros(1, np.int64)
    s, ss = np.append(0, np.cumsum(d)), np.append(0, np.cumsum(d * d))
    at = np.arange(len(d))
    low = np.maximum(0, at - SPAN)
    n = np.maximum(1, at - low)
    mean = (s[at] - s[low]) / n
    deviation = np.sqrt(np.maximum(0, (ss[at] - ss[low]) / n - mean * mean))
    cut = (d > FLOOR) & (d > mean + SIGMAS * deviation) & (at > 0)
    return np.append(0, np.flatnonzero(cut) + 1)


def shots_of(frames: list[bytes], stored: np.ndarray | None) -> np.ndarray:
    """First frames of the shots, by the histograms of decoded luma. stored: what unpack gave."""
    if not frames:
        return np.zeros(0, np.int64)
    return shots(histograms(stored_luma(stored), len(frames)) if stored is not None else np.stack([histograms(luma(f).ravel(), 1)[0] for f in frames]))


def clip_rows(first: np.ndarray, n: int, micros: int) -> list[tuple[int, int, int, float, float]]:
    """clip, first and last frame, start and end in milliseconds."""
    ends = [*first[1:].tolist(), n]
    return [(k, a, z - 1, a * micros / 1000, z * micros / 1000) for k, (a, z) in enumerate(zip(first.tolist(), ends, strict=True))] if n else []


def encode(docs: DataFrame) -> DataFrame:
    """docs: doc_id, text. Returns doc_id, n_bytes, media (an AVI file)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 500):
                b = whole.slice(k, 500)
                raw = [(t or "").encode() for t in b.column("text").to_pylist()]
                yield pa.record_batch({"doc_id": b.column("doc_id").cast(pa.int64()), "n_bytes": pa.array(map(len, raw), pa.int64()), "media": pa.array([write_avi(write_frames(padded(x))) for x in raw], pa.binary())})

    return small_batches(docs).select("doc_id", "text").mapInArrow(releasing(run), "doc_id long, n_bytes long, media binary")


def clips(media: DataFrame) -> DataFrame:
    """media: doc_id, media. One row per shot: clip (from 0), first and last frame, start and end in milliseconds. Nulls have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[list] = [[], [], [], [], [], []]
            for i, m in zip(b.column("doc_id").to_pylist(), b.column("media").to_pylist(), strict=True):
                frames, micros = read_avi(m) if m is not None else ([], 0)
                for r in clip_rows(shots_of(frames, unpack(frames)), len(frames), micros):
                    for x, y in zip(rows, (i, *r), strict=True):
                        x.append(y)
            yield pa.record_batch([pa.array(x, t) for x, t in zip(rows, (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64()), strict=True)], ["doc_id", "clip", "first_frame", "last_frame", "start_ms", "end_ms"])

    return media.select("doc_id", "media").mapInArrow(releasing(run), "doc_id long, clip int, first_frame int, last_frame int, start_ms double, end_ms double")


CLIP = [("clip", pa.int32(), "int"), ("first_frame", pa.int32(), "int"), ("last_frame", pa.int32(), "int"), ("start_ms", pa.float64(), "double"), ("end_ms", pa.float64(), "double")]
DIGEST = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, clips array<struct<" + ",".join(f"{n}:{t}" for n, _, t in CLIP) + ">>"


def digests(media: DataFrame) -> DataFrame:
    """media: doc_id, n_bytes, media. Sizes, hashes and shots of what is read back from the files, and the shots as timed clip rows."""
    clip = pa.list_(pa.struct([(n, t) for n, t, _ in CLIP]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[], [], [], [], [], [], []]
            for m in b.column("media").to_pylist():
                frames, micros = read_avi(m)
                stored = unpack(frames)
                first = shots_of(frames, stored)
                raw = stored.tobytes()
                feature = f"frames={len(frames)};shots=" + ",".join(map(str, first.tolist()))
                rows = [dict(zip((n for n, *_ in CLIP), r, strict=True)) for r in clip_rows(first, len(frames), micros)]
                for x, y in zip(out, (len(raw), hashlib.sha256(raw).hexdigest(), zlib.crc32(raw[-32:]), len(m), hashlib.sha256(m).hexdigest(), feature, rows), strict=True):
                    x.append(y)
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), clip)
            names = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "clips"]
            yield pa.record_batch([b.column("doc_id"), b.column("n_bytes"), *[pa.array(x, t) for x, t in zip(out, kinds, strict=True)]], ["doc_id", "n_bytes", *names])

    return media.select("doc_id", "n_bytes", "media").mapInArrow(releasing(run), DIGEST)


def op9_mjpeg(spark, sf_dir: str) -> DataFrame:
    return digests(encode(spark.read.parquet(f"{sf_dir}/documents.parquet")))
