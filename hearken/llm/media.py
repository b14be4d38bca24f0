"""Media columns: AVI with motion JPEG.

A payload becomes 8-bit grey frames of 16 by 12 samples, each an intra frame in JPEG's lossless process (predictor 1,
one Huffman table), held in an AVI with an index. Reading walks the RIFF chunks, takes the frames from the index,
decodes them, and detects shots where the difference of histograms exceeds what the last frames lead one to expect.
Frames are coded and decoded side by side by array operations, RUN at a time, so that a long text needs no more than a
short one besides its own bytes.

Null and empty texts become one frame of blanks; long texts simply have more frames; equal texts give equal media; each
row is answered by itself, whether doc_ids repeat or are null; a difference that only equals a threshold begins no shot;
an empty table gives an empty result; other columns are ignored. Media that are no AVI raise ValueError, and so do frames
of another kind than those written here (16 by 12 samples, lossless, one Huffman table): this is no decoder of others'.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_bytes, map_slices, ragged

WIDTH, HEIGHT, RATE = 16, 12, 10
FRAME = WIDTH * HEIGHT
RUN = 1 << 14  # frames coded or decoded side by side: what they need besides is some 70 bytes a sample
#: Code lengths of the categories 0 to 8 (bits of a difference's size), chosen for text; fixed, part of the format.
LENGTHS = (4, 5, 4, 3, 3, 2, 2, 4, 6)


def _codes(lengths) -> tuple[list[int], list[int]]:
    """Canonical codes: the categories in order of their code lengths, and each category's code."""
    order = sorted(range(len(lengths)), key=lambda s: (lengths[s], s))
    codes, code, last = [0] * len(lengths), 0, 0
    for s in order:
        code <<= lengths[s] - last
        last = lengths[s]
        codes[s] = code
        code += 1
    return order, codes


ORDER, CODES = _codes(LENGTHS)
_TABLE = bytes(LENGTHS.count(n) for n in range(1, 17)) + bytes(ORDER)
HEADER = (
    b"\xff\xd8"
    + b"\xff\xc3" + struct.pack(">HBHHBBBB", 11, 8, HEIGHT, WIDTH, 1, 1, 0x11, 0)
    + b"\xff\xc4" + struct.pack(">HB", 3 + len(_TABLE), 0) + _TABLE
    + b"\xff\xda" + struct.pack(">HBBBBBB", 8, 1, 1, 0, 1, 0, 0)
)
_VALUE, _BITS = np.zeros(511, np.int32), np.zeros(511, np.int32)
for _d in range(-255, 256):
    _s = abs(_d).bit_length()
    _VALUE[_d + 255] = CODES[_s] << _s | (_d if _d >= 0 else _d + (1 << _s) - 1)
    _BITS[_d + 255] = LENGTHS[_s] + _s


def encode_frames(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole JPEG streams of the frames (rows of `samples`), one after the other, and their sizes."""
    n = len(samples)
    grid = samples.reshape(n, HEIGHT, WIDTH).astype(np.int16)
    guess = np.empty_like(grid)
    guess[:, :, 1:] = grid[:, :, :-1]
    guess[:, 1:, 0] = grid[:, :-1, 0]
    guess[:, 0, 0] = 128
    which = (grid - guess + 255).reshape(n, FRAME)
    bits, values = _BITS[which], _VALUE[which]
    ends = np.cumsum(bits, axis=1)
    size = (ends[:, -1] + 7) // 8
    first = np.cumsum(size) - size
    at = (first * 8)[:, None] + ends - bits
    shifted = (values << (24 - bits - (at & 7))).ravel()
    at = (at >> 3).ravel()
    scan = np.zeros(int(size.sum()) + 3, np.uint8)
    for k in range(3):
        scan += np.bincount(at + k, weights=(shifted >> (16 - 8 * k)) & 255, minlength=len(scan)).astype(np.uint8)
    scan = scan[:-3]
    scan[first + size - 1] |= ((1 << (size * 8 - ends[:, -1])) - 1).astype(np.uint8)
    full = scan == 255
    stuffed = np.concatenate(([0], np.cumsum(full)))
    extra = stuffed[first + size] - stuffed[first]
    head, total = len(HEADER), size + extra + len(HEADER) + 2
    begin = np.cumsum(total) - total
    out = np.zeros(int(total.sum()), np.uint8)
    out[begin[:, None] + np.arange(head)] = np.frombuffer(HEADER, np.uint8)
    frame, offset = ragged(size)
    out[begin[frame] + head + offset + stuffed[:-1] - stuffed[first][frame]] = scan
    out[begin + total - 2], out[begin + total - 1] = 255, 0xD9
    return out, total


def _runs(n: int) -> list[tuple[int, int]]:
    return [(low, min(n, low + RUN)) for low in range(0, n, RUN)]


def _movie(frames: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The chunks of the frames' JPEG streams, one after the other, and the streams' sizes."""
    data, sizes = encode_frames(frames)
    padded = sizes + (sizes & 1)
    begin = np.cumsum(padded + 8) - padded - 8
    movie = np.zeros(int((padded + 8).sum()), np.uint8)
    frame, offset = ragged(sizes)
    movie[begin[frame] + 8 + offset] = data
    movie[begin[:, None] + np.arange(4)] = np.frombuffer(b"00dc", np.uint8)
    movie[begin[:, None] + np.arange(4, 8)] = sizes.astype("<u4").view(np.uint8).reshape(-1, 4)
    return movie, sizes


def write_avi(payloads: list[bytes]) -> list[bytes]:
    """An AVI for each payload; payloads are padded with blanks to a positive multiple of a frame."""
    counts = np.array([max(1, -(-len(p) // FRAME)) for p in payloads], np.int64)
    joined = b"".join([p + b" " * (FRAME * n - len(p)) for p, n in zip(payloads, counts.tolist(), strict=True)])
    frames = np.frombuffer(joined, np.uint8).reshape(-1, FRAME)
    coded = [_movie(frames[low:high]) for low, high in _runs(len(frames))]
    movie, sizes = (np.concatenate(parts) for parts in zip(*coded, strict=True))
    padded = sizes + (sizes & 1)
    begin = np.cumsum(padded + 8) - padded - 8
    edge = np.append(begin, len(movie))
    out, at = [], 0
    for n in counts.tolist():
        low, high = int(edge[at]), int(edge[at + n])
        index = np.empty((n, 4), "<u4")
        index[:, 0], index[:, 1] = int.from_bytes(b"00dc", "little"), 16
        index[:, 2], index[:, 3] = begin[at : at + n] - low + 4, sizes[at : at + n]
        header = _chunk(b"avih", struct.pack("<14I", 1_000_000 // RATE, 0, 0, 0x10, n, 0, 1, 0, WIDTH, HEIGHT, 0, 0, 0, 0))
        stream = _chunk(b"strh", struct.pack("<4s4sIHHIIIIIIIIhhhh", b"vids", b"MJPG", 0, 0, 0, 0, 1, RATE, 0, n, 0, 0xFFFFFFFF, 0, 0, 0, WIDTH, HEIGHT))
        form = _chunk(b"strf", struct.pack("<IiiHH4sIiiII", 40, WIDTH, HEIGHT, 1, 8, b"MJPG", FRAME, 0, 0, 0, 0))
        body = _chunk(b"LIST", b"hdrl" + header + _chunk(b"LIST", b"strl" + stream + form)) + _chunk(b"LIST", b"movi" + movie[low:high].tobytes()) + _chunk(b"idx1", index.tobytes())
        out.append(_chunk(b"RIFF", b"AVI " + body))
        at += n
    return out


def _chunk(name: bytes, body: bytes) -> bytes:
    return name + struct.pack("<I", len(body)) + body + b"\0" * (len(body) & 1)


def frame_index(media: bytes) -> tuple[np.ndarray, np.ndarray, int]:
    """Where the frames' JPEG streams begin, their sizes, and microseconds a frame, from the RIFF chunks and the index."""
    if media[:4] != b"RIFF" or media[8:12] != b"AVI ":
        raise ValueError("no AVI")
    at, end, movie, index, pace = 12, min(len(media), 8 + int.from_bytes(media[4:8], "little")), -1, None, 0
    while at + 8 <= end:
        name, size = media[at : at + 4], int.from_bytes(media[at + 4 : at + 8], "little")
        kind = media[at + 8 : at + 12] if name == b"LIST" else b""
        if kind == b"hdrl" and media[at + 12 : at + 16] == b"avih":
            pace = int.from_bytes(media[at + 20 : at + 24], "little")
        elif kind == b"movi":
            movie = at + 8
        elif name == b"idx1":
            index = np.frombuffer(media, "<u4", size // 4, at + 8).reshape(-1, 4)
        at += 8 + size + (size & 1)
    if movie < 0 or index is None or not pace:
        raise ValueError("an AVI without frames, index or header")
    return movie + index[:, 2].astype(np.int64) + 8, index[:, 3].astype(np.int64), pace


def _reading(header: bytes) -> tuple[np.ndarray, np.ndarray]:
    """For the next 14 bits of a scan: the difference they begin with, and its bits, by the header's Huffman table."""
    at = 2
    lengths: dict[int, int] = {}
    while at < len(header):
        mark, size = header[at + 1], int.from_bytes(header[at + 2 : at + 4], "big")
        part = header[at + 4 : at + 2 + size]
        if mark == 0xC3 and part[:6] != struct.pack(">BHHB", 8, HEIGHT, WIDTH, 1):
            raise ValueError("frames of another size")
        if mark == 0xC4:
            symbols = iter(part[17:])
            lengths = {next(symbols): n for n in range(1, 17) for _ in range(part[n])}
        at += 2 + size
    values, bits, code, last = np.zeros(1 << 14, np.int64), np.ones(1 << 14, np.int64), 0, 0
    for s, n in lengths.items():
        code <<= n - last
        last = n
        low = code << (14 - n)
        window = np.arange(low, low + (1 << (14 - n)))
        extra = (window >> (14 - n - s)) & ((1 << s) - 1)
        values[window] = np.where(extra < (1 << s >> 1), extra - (1 << s) + 1, extra) if s else 0
        bits[window] = n + s
        code += 1
    return values, bits


_tables: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}


def decode_frames(data: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The samples of the JPEG streams data[begin:begin + size], a row each."""
    head = len(HEADER)
    header = data[begin[0] : begin[0] + head].tobytes()
    if header[:2] != b"\xff\xd8" or (data[begin[:, None] + np.arange(head)] != np.frombuffer(header, np.uint8)).any():
        raise ValueError("no lossless JPEG frames of one kind")
    if header not in _tables:
        _tables[header] = _reading(header)
    values, bits = _tables[header]
    frame, offset = ragged(sizes - head - 2)
    scan = data[begin[frame] + head + offset]
    keep = np.ones(len(scan), bool)
    keep[1:] = ~((scan[1:] == 0) & (scan[:-1] == 255) & (offset[1:] > 0))
    size = np.bincount(frame[keep], minlength=len(sizes))
    scan = np.concatenate((scan[keep], np.zeros(4, np.uint8))).astype(np.uint32)
    word = (scan[:-3] << np.uint32(24) | scan[1:-2] << np.uint32(16) | scan[2:-1] << np.uint32(8) | scan[3:]).astype(np.int64)
    at = (np.cumsum(size) - size) * 8
    out = np.empty((FRAME, len(sizes)), np.uint8)
    last = np.full(len(sizes), 128, np.int64)
    for k in range(FRAME):
        if k and k % WIDTH == 0:
            last = out[k - WIDTH].astype(np.int64)
        ahead = word[at >> 3] >> (18 - (at & 7)) & 0x3FFF
        last = last + values[ahead] & 255
        at += bits[ahead]
        out[k] = last
    return out.T


def shots(samples: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Whether a shot begins with each frame. Histograms have 16 bins; a frame begins a shot if its difference to the one
    before is over 24 samples and over one and a half times the mean difference of the eight frames before it."""
    n = len(samples)
    hist = np.empty((n, 16), np.int64)
    for low, high in _runs(n):
        bins = np.arange(high - low)[:, None] * 16 + (samples[low:high] >> 4)
        hist[low:high] = np.bincount(bins.ravel(), minlength=(high - low) * 16).reshape(-1, 16)
    diff = np.zeros(n, np.int64)
    diff[1:] = np.abs(np.diff(hist, axis=0)).sum(axis=1)
    group, place = ragged(counts)
    diff[place == 0] = 0
    total = np.concatenate(([0], np.cumsum(diff)))
    past = np.minimum(place, 8)
    expected = total[np.arange(n)] - total[np.arange(n) - past]
    return (place == 0) | ((diff > 24) & (2 * diff * past > 3 * expected))


def to_media(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media: every text stored as an AVI."""

    def work(batch):
        bodies = batch.column("body").to_pylist()
        return pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "n_bytes": pa.array([len(b) for b in bodies], pa.int64()), "media": pa.array(write_avi(bodies), pa.binary())})

    return map_slices(id_and_bytes(docs), work, "doc_id long, n_bytes long, media binary", limit=2 << 20)


CLIPS = "array<struct<first_frame:int,frames:int,start_s:double,end_s:double>>"


def from_media(media: DataFrame) -> DataFrame:
    """doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, clips of each stored AVI."""

    def work(batch):
        stored = batch.column("media").to_pylist()
        found = [frame_index(m) for m in stored]
        bases = np.cumsum([0] + [len(m) for m in stored[:-1]])
        counts = np.array([len(b) for b, _, _ in found], np.int64)
        begin = np.concatenate([b + base for (b, _, _), base in zip(found, bases.tolist(), strict=True)])
        data, sizes = np.frombuffer(b"".join(stored), np.uint8), np.concatenate([s for _, s, _ in found])
        samples = np.concatenate([decode_frames(data, begin[low:high], sizes[low:high]) for low, high in _runs(len(sizes))])
        cut = shots(samples, counts)
        flat, at, rows = np.ascontiguousarray(samples).reshape(-1), 0, []
        for m, n, (_, _, pace) in zip(stored, counts.tolist(), found, strict=True):
            payload = flat[at * FRAME : (at + n) * FRAME].tobytes()
            firsts = np.flatnonzero(cut[at : at + n]).tolist()
            clips = [{"first_frame": a, "frames": b - a, "start_s": a * pace / 1e6, "end_s": b * pace / 1e6} for a, b in zip(firsts, [*firsts[1:], n], strict=True)]
            rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(m), hashlib.sha256(m).hexdigest(), clips))
            at += n
        columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("first_frame", pa.int32()), ("frames", pa.int32()), ("start_s", pa.float64()), ("end_s", pa.float64())]))), strict=True)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), *columns], names=["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "clips"])

    return map_slices(media, work, f"doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, clips {CLIPS}", "media", limit=4 << 20)


def clips(media: DataFrame) -> DataFrame:
    """A timed row for each clip: doc_id, clip, first_frame, frames, start_s, end_s."""
    return from_media(media).select("doc_id", F.posexplode("clips").alias("clip", "c")).select("doc_id", "clip", "c.*")


def features(media: DataFrame) -> DataFrame:
    """from_media with its clips told in a string: frames and clips, then each clip's first frame."""
    told = F.concat(F.format_string("%d frames in %d clips: ", (F.col("payload_bytes") / FRAME).cast("long"), F.size("clips")), F.array_join(F.transform("clips", lambda c: c.first_frame.cast("string")), ","))
    return from_media(media).withColumn("feature", told).drop("clips")
