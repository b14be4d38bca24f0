"""Substring joins: which of many needles a text contains, without trying them all.

Every needle is filed under one of its grams, one that few needles have: LONG bytes of a needle that is as long, SHORT bytes
of a shorter one, a needle below that as a whole. A text looks up its own grams by a hash join, and what it finds is verified
byte by byte. Grams that no needle is filed under are dropped where the text is read, by a table (a Bloom filter) that has
BITS_EACH bits for each needle, MOST_BITS at the most; which grams are rare is told by MOST_COUNTERS counters at the most.
Neither needles nor texts are broadcast or collected.

All is told in bytes of UTF-8, so a needle is found wherever it stands, also within words. Null texts and null needles match
nothing, an empty needle matches every text that is not null; needles that repeat count once; texts are looked through
whole. A text whose needle stands in several places is told once for each place.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

SHORT, LONG = 3, 12
BITS_EACH, LEAST_BITS, MOST_BITS, PROBES = 24, 1 << 12, 1 << 27, 4
LEAST_COUNTERS, MOST_COUNTERS = 1 << 16, 1 << 21
BLOCK = 1 << 17  # bytes looked through at once
_U = np.uint64


def _power(n: int, least: int, most: int) -> int:
    """The least power of two that is `n` or more, within bounds that are powers of two."""
    return min(max(1 << max(n - 1, 0).bit_length(), least), most)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


def gram_keys(raw: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of the grams of `size` (below 16) bytes at each place of `raw`."""
    n = len(raw) - size + 1
    if n <= 0:
        return np.empty(0, _U)
    word, words = raw.astype(_U), {}
    for width in (1, 2, 4, 8):
        words[width] = word
        word = word[:-width] | word[width:] << _U(8 * width) if len(word) > width else word[:0]
    key, at = np.full(n, size + 1, _U), 0
    for width in (8, 4, 2, 1):
        if size & width:
            key, at = _mixed(key ^ words[width][at : at + n]), at + width
    return _mixed(key)


def _grams_of(needles: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each size of gram: which needles have it, the keys of all their grams, and the first of each needle's."""
    lengths = np.fromiter(map(len, needles), np.int64, len(needles))
    sizes = np.where(lengths >= LONG, LONG, np.where(lengths >= SHORT, SHORT, lengths))
    for size in np.unique(sizes).tolist():
        which = np.flatnonzero(sizes == size)
        raw = np.frombuffer(b"".join([needles[i] for i in which]), np.uint8)
        many = lengths[which] - size + 1
        starts = np.cumsum(many) - many
        skipped = np.arange(len(which)) * (size - 1)  # a needle has so many places more than grams
        at = np.arange(int(many.sum())) + np.repeat(skipped if size else np.zeros_like(starts) - starts, many)
        yield size, which, gram_keys(raw, size)[at], starts


def _summed(rows: DataFrame, how: str, length: int, kind: type) -> np.ndarray:
    """An array of `length` numbers from rows (place, value), added or or-ed by place."""
    told = rows.groupBy("place").agg(F.expr(f"{how}(value)").alias("value")).toArrow()
    out = np.zeros(length, kind)
    out[told.column("place").to_numpy()] = told.column("value").to_numpy().view(kind)
    return out


def _raw(needles: DataFrame) -> DataFrame:
    return needles.select("needle", F.col("needle").cast("binary").alias("raw")).where("needle is not null")


def rarity(needles: DataFrame, counters: int) -> np.ndarray:
    """How often grams of needles occur, by their hashes' lowest bits: never less than a gram does."""

    def work(batches):
        total = np.zeros(counters, np.int64)
        for batch in batches:
            for _, _, keys, _ in _grams_of(batch.column("raw").to_pylist()):
                total += np.bincount((keys & _U(counters - 1)).astype(np.int64), minlength=counters)
        places = np.flatnonzero(total)
        for k in range(0, len(places), 1 << 16):
            own = places[k : k + (1 << 16)]
            yield pa.RecordBatch.from_pydict({"place": pa.array(own.astype(np.int32)), "value": pa.array(total[own])})

    return _summed(_raw(needles).select("raw").mapInArrow(work, "place int, value long"), "sum", counters, np.int64)


def _filed(needles: DataFrame, counts: np.ndarray) -> DataFrame:
    def work(batches):
        for batch in batches:
            for size, which, keys, starts in _grams_of(batch.column("raw").to_pylist()):
                many = np.diff(np.append(starts, len(keys)))
                seen = counts[(keys & _U(len(counts) - 1)).astype(np.int64)]
                able = np.where(seen == np.repeat(np.minimum.reduceat(seen, starts), many), keys, ~_U(0))
                chosen = np.flatnonzero(able == np.repeat(np.minimum.reduceat(able, starts), many))
                chosen = chosen[np.searchsorted(chosen, starts)]
                own = {"size": pa.array(np.full(len(which), size, np.int32)), "key": pa.array(keys[chosen].view(np.int64)), "before": pa.array((chosen - starts).astype(np.int32))}
                yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(which)) for c in ("needle", "raw")] + [*own.values()], names=["needle", "raw", *own])

    return _raw(needles).mapInArrow(work, "needle string, raw binary, size int, key long, before int")


def filed(needles: DataFrame) -> DataFrame:
    """needle, raw (its bytes), size, key, before: the gram that the needle is filed under, and how many bytes stand before
    it: of its grams one that few needles have, of equals that of the least hash."""
    return _filed(needles, rarity(needles, _power(4 * needles.count(), LEAST_COUNTERS, MOST_COUNTERS))).distinct()


@dataclass
class Sieve:
    """Which hashes needles are filed under: a table of bits in words of 64; the sizes of their grams; the longest needle's
    bytes."""

    words: np.ndarray
    sizes: list[int]
    longest: int

    @classmethod
    def of(cls, index: DataFrame) -> Sieve:
        told = index.groupBy("size").agg(F.count("*").alias("n"), F.max(F.octet_length("raw")).alias("longest")).collect()
        bits = _power(BITS_EACH * sum(r["n"] for r in told), LEAST_BITS, MOST_BITS)

        def work(batches):
            for batch in batches:
                at = np.unique(cls.places(batch.column("key").to_numpy().view(_U), bits))
                word, bit = at >> _U(6), _U(1) << (at & _U(63))
                if len(word):
                    starts = np.flatnonzero(np.diff(word, prepend=word[:1] + _U(1)))
                    yield pa.RecordBatch.from_pydict({"place": pa.array(word[starts].astype(np.int32)), "value": pa.array(np.bitwise_or.reduceat(bit, starts).view(np.int64))})

        words = _summed(index.select("key").mapInArrow(work, "place int, value long"), "bit_or", bits // 64, _U)
        return cls(words, sorted(r["size"] for r in told), max((r["longest"] for r in told), default=0))

    @staticmethod
    def places(keys: np.ndarray, bits: int, probes=range(PROBES)) -> np.ndarray:
        step = keys >> _U(33) | _U(1)
        return np.concatenate([(keys + _U(k) * step) & _U(bits - 1) for k in probes])

    def passing(self, keys: np.ndarray) -> np.ndarray:
        """The places in `keys` of those that may be in the table."""
        left = np.arange(len(keys))
        for k in range(PROBES):
            at = self.places(keys[left], 64 * len(self.words), [k])
            left = left[self.words[(at >> _U(6)).astype(np.int64)] >> (at & _U(63)) & _U(1) == 1]
        return left


def _grams(texts: DataFrame, sieve: Sieve, outer: bool) -> DataFrame:
    """The columns of `texts` but _text (bytes), with _key, _around, _place: the texts' grams that pass, the bytes around
    each that any needle could take, and the gram's place in them; for each text also a row without a key, if `outer`."""
    rest = texts.drop("_text").schema
    schema = StructType([*rest.fields, StructField("_key", LongType()), StructField("_around", BinaryType()), StructField("_place", IntegerType())])
    most = max(1, (16 << 20) // max(2 * sieve.longest, 64))  # rows at once

    def run(batches):
        for batch in batches:
            bodies, own = batch.column("_text").to_pylist(), [batch.column(c) for c in rest.names]

            def rows(which, *told):
                which = pa.array(which, pa.int64())
                types = (pa.int64(), pa.binary(), pa.int32())
                return pa.RecordBatch.from_arrays([*(c.take(which) for c in own), *map(pa.array, told, types)], names=schema.names)

            if outer and bodies:
                none = [None] * len(bodies)
                yield rows(np.arange(len(bodies)), none, none, none)
            known = np.array([i for i, b in enumerate(bodies) if b is not None], np.int64)
            joined = b"".join([bodies[i] for i in known])
            raw = np.frombuffer(joined, np.uint8)
            edge = np.concatenate(([0], np.cumsum(np.fromiter((len(bodies[i]) for i in known), np.int64, len(known)))))
            for size in sieve.sizes:
                if size == 0:
                    yield rows(known, np.repeat(gram_keys(raw[:0], 0).view(np.int64), len(known)), [b""] * len(known), np.zeros(len(known), np.int32))
                    continue
                for low in range(0, len(raw), BLOCK):
                    keys = gram_keys(raw[low : low + BLOCK + size - 1], size)
                    at = sieve.passing(keys)
                    keys, at = keys[at].view(np.int64), at + low
                    text = np.searchsorted(edge, at, side="right") - 1
                    inside = at + size <= edge[text + 1]
                    keys, at, text = keys[inside], at[inside], text[inside]
                    begin, end = np.maximum(at - sieve.longest + size, edge[text]), np.minimum(at + sieve.longest, edge[text + 1])
                    for k in range(0, len(at), most):
                        part = slice(k, k + most)
                        around = [joined[b:e] for b, e in zip(begin[part].tolist(), end[part].tolist(), strict=True)]
                        yield rows(known[text[part]], keys[part], around, (at - begin)[part].astype(np.int32))

    return texts.mapInArrow(run, schema)


def matched(texts: DataFrame, text: str, needles: DataFrame, how: str = "inner") -> DataFrame:
    """The columns of `texts` but `text`, and needle: a row for each place of the column `text` where a needle of `needles`
    (needle) stands; by `how` "left" also rows without a needle, one at least for each text."""
    index = filed(needles)
    sieve = Sieve.of(index)
    rest = [c for c in texts.columns if c != text]
    met = _grams(texts.select(*rest, F.col(text).cast("binary").alias("_text")), sieve, how == "left")
    filed_as = index.select("needle", F.col("raw").alias("_needle"), F.col("key").alias("_filed"), F.col("before").alias("_before"))
    begin = F.col("_place") - F.col("_before")
    same = (F.col("_key") == F.col("_filed")) & (begin >= 0) & (F.substring("_around", begin + 1, F.octet_length("_needle")) == F.col("_needle"))
    return met.join(filed_as, same, how).select(*rest, "needle")
