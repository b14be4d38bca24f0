"""SimHash near-dedup by multi-index hashing.

A text's fingerprint has a bit where over half of its shingles' XXH64 values have it. Fingerprints that differ in DISTANCE
bits at most link. They are cut into segments, and by the pigeonhole principle two that link are close in one of them:
with distance = segments * a + b, within a in one of the first b + 1 segments or within a - 1 in one of the others. Each
fingerprint looks up the values of a small Hamming ball around its segment in that segment's table; of two values that
differ, only the one that has the highest differing bit asks for the other, so that a pair meets once. What is found is
verified by the whole distance.

A table's value that many fingerprints share would be met by all pairs. Fingerprints that stand at or ask for such a
crowded value are linked through midpoints instead: two fingerprints are within 2r bits if and only if the balls of radius
r around them share a point, and those that share a point form a star, not all pairs. That is exact for an even distance;
an odd one is first cut at a midpoint with one bit more, and its edges are verified on the point's few members.

Equal fingerprints are one node. Nulls, empty texts and texts without words have the fingerprint 0, which links as any
other; texts with fewer words than a shingle are one shingle. Texts are read whole; rows that repeat, or share a doc_id,
are answered one by one; rows without doc_id link as others do, but name a group only if no row of it has one, then by
null. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, SEPARATOR, id_and_bytes, map_slices, saved
from .graph import components

SHINGLE, DISTANCE, SEGMENTS, SEED, BITS = 3, 2, 2, 42, 64
CROWD = 64  # fingerprints at a table's value, beyond which they are linked through midpoints
_M = np.uint64
#: The five primes of XXH64. Fixed values.
P1, P2, P3, P4, P5 = (_M(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return x << _M(bits) | x >> _M(64 - bits)


def xxh64(text: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of text[start:end] for all spans at once; the library hashes those of 32 bytes and more."""
    padded = np.concatenate((text, np.zeros(8, np.uint8)))
    eight = np.lib.stride_tricks.as_strided(padded.view(), (len(text) + 1, 8), (1, 1))
    size = ends - starts
    with np.errstate(over="ignore"):
        h = size.astype(np.uint64) + P5 + _M(seed)
        at = starts.copy()
        for k in range(3):
            live = np.flatnonzero((size >= 8 * (k + 1)) & (size < 32))
            lane = np.ascontiguousarray(eight[at[live]]).view("<u8").ravel()
            h[live] = _turned(h[live] ^ _turned(lane * P2, 31) * P1, 27) * P1 + P4
            at[live] += 8
        live = np.flatnonzero(size & 4)
        lane = np.ascontiguousarray(eight[at[live], :4]).view("<u4").ravel().astype(np.uint64)
        h[live] = _turned(h[live] ^ lane * P1, 23) * P2 + P3
        at[live] += 4
        for k in range(3):
            live = np.flatnonzero((size & 3) > k)
            h[live] = _turned(h[live] ^ padded[at[live]].astype(np.uint64) * P5, 11) * P1
            at[live] += 1
        h ^= h >> _M(33)
        h *= P2
        h ^= h >> _M(29)
        h *= P3
        h ^= h >> _M(32)
    long = np.flatnonzero(size >= 32)
    body = text.tobytes() if len(long) else b""
    for i, a, b in zip(long.tolist(), starts[long].tolist(), ends[long].tolist(), strict=True):
        h[i] = xxhash.xxh64_intdigest(body[a:b], seed)
    return h


def _majorities(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For hashes[first[i]:first[i + 1]] of each document the number whose bits are set in over half of them."""
    counts = np.diff(first)
    full = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint64)
    if not len(full):
        return out
    # Eight counters of a byte in a word hold 255 values: sums over blocks of 255, then over a document's blocks.
    blocks = -(-counts[full] // 255)
    home = np.cumsum(blocks) - blocks
    begin = np.repeat(first[full], blocks) + 255 * (np.arange(blocks.sum()) - np.repeat(home, blocks))
    for k in range(8):
        lanes = np.add.reduceat((hashes >> _M(k)) & _M(0x0101010101010101), begin)
        each = np.add.reduceat(lanes.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64), home)
        for byte in range(8):
            out[full] |= (2 * each[:, byte] > counts[full]).astype(np.uint64) << _M(8 * byte + k)
    return out


def fingerprints(bodies: list[bytes], k: int = SHINGLE) -> np.ndarray:
    """The fingerprint of each text."""
    joined = LOWER[np.frombuffer(b" ".join([*bodies, b""]), np.uint8)]
    inside = ~SEPARATOR[joined]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    begins = np.concatenate(([0], np.cumsum(np.fromiter((len(b) + 1 for b in bodies), np.int64, len(bodies)))))
    first = np.searchsorted(edge[::2], begins)
    # The words again with one space after each, so that a shingle is a stretch of them.
    size = edge[1::2] - edge[::2]
    keep = inside.copy()
    keep[edge[1::2]] = True
    text = np.where(inside, joined, 32)[keep].astype(np.uint8)
    starts = np.cumsum(size + 1) - size - 1
    ends = starts + size
    words = np.diff(first)
    shingles = np.where(words >= k, words - k + 1, np.minimum(words, 1))
    each = np.cumsum(shingles) - shingles
    doc = np.repeat(np.arange(len(bodies)), shingles)
    at = first[doc] + np.arange(len(doc)) - each[doc]
    hashes = xxh64(text, starts[at], ends[np.minimum(at + k, first[doc + 1]) - 1])
    return _majorities(hashes, np.append(each, len(doc)))


def signed(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """doc_id, fp (the fingerprint's bits as a long) of every row."""

    def work(batch):
        found = fingerprints(batch.column("body").to_pylist(), k)
        return pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "fp": pa.array(found.view(np.int64))})

    return map_slices(id_and_bytes(docs), work, "doc_id long, fp long", limit=2 << 20)


def segment_radii(distance: int, segments: int) -> list[int]:
    """How far two values of each segment can be from each other if pairs are to meet in one; -1 for no need."""
    a, b = divmod(distance, segments)
    return [a if s <= b else a - 1 for s in range(segments)]


def _cuts(segments: int) -> list[tuple[int, int]]:
    """Each segment's lowest bit and width."""
    edges = [BITS * s // segments for s in range(segments + 1)]
    return [(a, b - a) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _masks(width: int, radius: int) -> list[int]:
    return [sum(1 << bit for bit in bits) for r in range(radius + 1) for bits in combinations(range(width), r)]


def _long(value: int) -> int:
    """An unsigned 64-bit value as a long."""
    return value - (1 << 64) if value >> 63 else value


def _segment(fp, low: int, width: int):
    value = F.shiftrightunsigned(fp, low)
    return value if width == 64 else value.bitwiseAND(F.lit((1 << width) - 1))


def tables(fps: DataFrame, distance: int = DISTANCE, segments: int = SEGMENTS) -> DataFrame:
    """segment, value, fp: every fingerprint at its own value of each segment that is needed."""
    needed = [(s, cut) for s, (cut, r) in enumerate(zip(_cuts(segments), segment_radii(distance, segments), strict=True)) if r >= 0]
    own = F.array(*(F.struct(F.lit(s).alias("segment"), _segment(F.col("fp"), *cut).alias("value")) for s, cut in needed))
    return fps.select("fp", F.explode(own).alias("own")).select("own.segment", "own.value", "fp")


def probes(fps: DataFrame, distance: int = DISTANCE, segments: int = SEGMENTS) -> DataFrame:
    """segment, value, asked: what every fingerprint looks up, the half of the Hamming ball around each segment where it has
    the highest bit that differs, and its own value."""
    def half_ball(segment: int, low: int, width: int, radius: int):
        own = _segment(F.col("fp"), low, width)
        masks = F.array(*(F.lit(_long(m)) for m in _masks(width, radius)))
        tops = F.array(*(F.lit(_long(1 << m.bit_length() - 1 if m else 0)) for m in _masks(width, radius)))
        able = F.filter(F.arrays_zip(masks.alias("mask"), tops.alias("top")), lambda m: (m.mask == 0) | (own.bitwiseAND(m.top) != 0))
        return F.transform(able, lambda m: F.struct(F.lit(segment).alias("segment"), own.bitwiseXOR(m.mask).alias("value")))

    radii = segment_radii(distance, segments)
    parts = [half_ball(s, *cut, radii[s]) for s, cut in enumerate(_cuts(segments)) if radii[s] >= 0]
    return fps.select(F.col("fp").alias("asked"), F.explode(F.concat(*parts)).alias("ball")).select("ball.segment", "ball.value", "asked")


def through_midpoints(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """src, dst: the links among all of `fps`, as stars around the points of their balls. A point's star is no larger than
    its ball, so no group grows with the table."""
    radius = -(-distance // 2)
    masks = F.array(*(F.lit(_long(m)) for m in _masks(BITS, radius)))
    points = fps.select("fp", F.explode(F.transform(masks, lambda m: F.col("fp").bitwiseXOR(m))).alias("point"))
    if distance % 2 == 0:
        first = points.groupBy("point").agg(F.min("fp").alias("first"), F.count("*").alias("n")).where("n > 1")
        return points.join(first, "point").where("fp != first").select(F.col("fp").alias("src"), F.col("first").alias("dst")).distinct()
    met = points.groupBy("point").agg(F.collect_list("fp").alias("at")).where(F.size("at") > 1)
    pairs = met.select(F.explode("at").alias("src"), "at").select("src", F.explode("at").alias("dst"))
    return pairs.where((F.col("src") > F.col("dst")) & (F.bit_count(F.col("src").bitwiseXOR(F.col("dst"))) <= distance)).distinct()


def links(fps: DataFrame, distance: int = DISTANCE, segments: int = SEGMENTS, crowd: int = CROWD) -> DataFrame:
    """src, dst: links between distinct fingerprints `fp`, enough of them to connect all that are within `distance` bits."""
    own, asked = tables(fps, distance, segments), probes(fps, distance, segments)
    at = ["segment", "value"]
    crowded = saved(own.groupBy(at).count().where(F.col("count") > crowd).select(at), "crowded")
    found = asked.join(crowded, at, "left_anti").join(own.join(crowded, at, "left_anti"), at)
    near = found.where((F.col("fp") != F.col("asked")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("asked"))) <= distance))
    stuck = own.join(crowded, at, "left_semi").select("fp").unionByName(asked.join(crowded, at, "left_semi").select(F.col("asked").alias("fp")))
    return near.select(F.col("asked").alias("src"), F.col("fp").alias("dst")).unionByName(through_midpoints(stuck.distinct(), distance))


def grouped(docs: DataFrame, distance: int = DISTANCE, segments: int = SEGMENTS, crowd: int = CROWD, k: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id (the least doc_id that links lead to, its own included) of
    every row."""
    rows = saved(signed(docs, k), "fingerprints")
    nodes = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = components(links(nodes.select("fp"), distance, segments, crowd))
    placed = nodes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = saved(placed, "placed")
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(names, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
