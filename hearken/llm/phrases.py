"""Phrase collocation mining with depth-limited count tries.

A shard, a bounded stretch of the texts, counts its windows: the DEPTH words from each word on, or fewer at the end of a
piece, below the language. Sorted, they are the shard's trie, written depth first: what a window shares with the one
before is its path in the trie, and only the rest of its words is stored. Tries are cut at prefix ranges; the shards'
parts of a range meet in one task, which merges them in order and walks the merged trie once. A node's count is final if
its subtree lies within the range; those on the first and last path are added up with other ranges' parts. The root of a
language counts all of its words.

The nodes that are frequent enough stay, each linked to its parent (without its last word) and by its suffix link (without
its first). Walking up the parents tells the counts of all left parts, following suffix links those of all right parts; a
phrase of m words takes both arrays over from nodes of m - 1 words. All subphrases of a frequent phrase are frequent, so
every link leads to a node.

Prefix ranges are chosen from a sample of about SAMPLE windows; they balance tasks and decide no result. Null texts are
empty; a null language is NO_LANGUAGE; texts are read whole, very long ones in stretches between pieces; rows that repeat,
or share or lack a doc_id, count one by one; ties are told by the order that `mine` states; an empty table gives an empty
result; other columns are ignored. Words are compared as bytes.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, given_back, saved, slices

DEPTH, LEAST, TOP, PER_MILLE, NO_LANGUAGE = 5, 100, 2000, 1000, "und"
SHARD_BYTES, RANGE_BYTES, MAX_RANGES = 8 << 20, 8 << 20, 1 << 16
SAMPLE, SAMPLE_STEP, SPLIT_WORD = 1 << 17, 32, 64  # windows; words from one to the next; bytes of a word of a split
SALTS = 64
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"  # what ends a piece. Fixed values.
_BREAK, _APART = np.zeros(256, bool), np.zeros(256, bool)
_BREAK[list(BREAKS)] = True
_APART[[9, 32, *BREAKS]] = True
_NEXT_BREAK = re.compile(b"[" + re.escape(BREAKS) + b"]")


def _binary(words: list[bytes]) -> pa.Array:
    return pa.array(words, pa.large_binary())


def _ranked(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct words in order, and each word's number there, from 1."""
    coded = words.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(1, len(order) + 1, dtype=np.int32)
    return coded.dictionary.take(pa.array(order)), rank[coded.indices.to_numpy()]


def _words(bodies: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All words of the texts, each one's text, and how many words its piece still has from it on."""
    joined = LOWER[np.frombuffer(b"\n".join([*bodies, b""]), np.uint8)]
    inside = ~_APART[joined]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    offsets = np.concatenate(([0], np.cumsum(ends - starts)))
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(joined[inside])])
    begin = np.concatenate(([0], np.cumsum(np.fromiter((len(b) + 1 for b in bodies), np.int64, len(bodies)))))
    text = np.searchsorted(begin, starts, side="right") - 1
    breaks = np.flatnonzero(_BREAK[joined])
    piece = np.searchsorted(breaks, starts)
    last = np.flatnonzero(np.diff(piece, append=-1))
    room = last[np.searchsorted(last, np.arange(len(starts)))] - np.arange(len(starts)) + 1
    return words, text, room


def windows_of(langs: list[bytes], bodies: list[bytes], depth: int = DEPTH, step: int = 1, more: list[tuple[bytes, ...]] | None = None):
    """The sorted vocabulary, and a row for each step-th word: its language and the words from it on, as numbers of the
    vocabulary, 0 where the piece has ended; then the rows of `more`."""
    words, text, room = _words(bodies)
    extra = [w for row in more or () for w in row]
    vocabulary, rank = _ranked(pa.concat_arrays([words, _binary(langs), _binary(extra)]))
    n = len(words)
    word, lang = np.concatenate((rank[:n], np.zeros(depth, np.int32))), rank[n : n + len(langs)]
    at = np.arange(0, n, step)
    rows = np.zeros((len(at) + len(more or ()), depth + 1), np.int32)
    rows[: len(at), 0] = lang[text[at]] if n else 0
    for d in range(depth):
        rows[: len(at), d + 1] = np.where(room[at] > d, word[at + d], 0)
    numbers = iter(rank[n + len(langs) :].tolist())
    for i, row in enumerate(more or ()):
        for d in range(len(row)):
            rows[len(at) + i, d] = next(numbers)
    return vocabulary, rows


def _order(rows: np.ndarray, most: int) -> np.ndarray:
    """The order of the rows, column by column; numbers are below 2**most."""
    per = 63 // most
    keys = []
    for low in range(0, rows.shape[1], per):
        key = np.zeros(len(rows), np.int64)
        for column in range(low, min(low + per, rows.shape[1])):
            key = key << most | rows[:, column]
        keys.append(key)
    return np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")


def shared_words(rows: np.ndarray) -> np.ndarray:
    """How many words each of the sorted rows has in common with the one before, from the first on; the first row -1."""
    same = np.logical_and.accumulate(rows[1:] == rows[:-1], axis=1).sum(axis=1)
    return np.concatenate(([-1], same)) if len(rows) else np.empty(0, np.int64)


class Trie:
    """Distinct windows in order, with their counts: the leaves of a trie, depth first."""

    def __init__(self, vocabulary: pa.Array, rows: np.ndarray, counts: np.ndarray):
        order = _order(rows, max(1, len(vocabulary).bit_length()))
        rows, counts = rows[order], counts[order]
        shared = shared_words(rows)
        new = np.flatnonzero(shared < rows.shape[1])
        self.vocabulary, self.rows, self.shared = vocabulary, rows[new], shared[new]
        self.counts = np.add.reduceat(counts, new) if len(new) else counts
        #: The place among the leaves of each row that was given.
        self.place = np.empty(len(rows), np.int64)
        self.place[order] = np.cumsum(shared < rows.shape[1]) - 1

    def part(self, low: int, high: int) -> bytes:
        """The leaves from low to high, with the words that they have: for each leaf the length of its path, of that the part
        that the leaf before has too, its count, and the numbers of the other words."""
        rows, shared = self.rows[low:high], self.shared[low:high].copy()
        shared[:1] = 0
        length = (rows != 0).sum(axis=1)
        column = np.arange(rows.shape[1])
        own = rows[(column >= shared[:, None]) & (column < length[:, None])]
        used, numbers = np.unique(own, return_inverse=True)
        words = self.vocabulary.take(pa.array(used - 1))
        sizes = pc.binary_length(words).to_numpy().astype("<u4")
        counts = self.counts[low:high]
        wide = next(w for w in (1, 2, 4, 8) if int(counts.max()) < 1 << 8 * w)
        short = next(w for w in (1, 2, 4) if len(used) < 1 << 8 * w)
        body = b"".join((struct.pack("<IIIBBB", len(rows), len(used), len(own), rows.shape[1], wide, short), sizes.tobytes(), b"".join(words.to_pylist()), length.astype("u1").tobytes(), shared.astype("u1").tobytes(), counts.astype(f"<u{wide}").tobytes(), numbers.astype(f"<u{short}").tobytes()))
        return struct.pack("<I", len(body)) + pa.compress(body, codec="zstd", asbytes=True)


def _read(part: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words, rows (numbers of the words, from 1) and counts of a stored part."""
    body = pa.decompress(part[4:], struct.unpack_from("<I", part)[0], codec="zstd", asbytes=True)
    n, words, own, width, wide, short = struct.unpack_from("<IIIBBB", body)
    at = 15
    sizes = np.frombuffer(body, "<u4", words, at).astype(np.int64)
    at += 4 * words
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    vocabulary = pa.Array.from_buffers(pa.large_binary(), words, [None, pa.py_buffer(offsets), pa.py_buffer(body[at : at + int(offsets[-1])])])
    at += int(offsets[-1])
    length, shared = np.frombuffer(body, "u1", n, at).astype(np.int64), np.frombuffer(body, "u1", n, at + n).astype(np.int64)
    counts = np.frombuffer(body, f"<u{wide}", n, at + 2 * n).astype(np.int64)
    numbers = np.frombuffer(body, f"<u{short}", own, at + (2 + wide) * n).astype(np.int32) + 1
    rows, column = np.zeros((n, width), np.int32), np.arange(width)
    rows[(column >= shared[:, None]) & (column < length[:, None])] = numbers
    for d in range(width):  # down from the last leaf that has a word of its own here
        source = np.maximum.accumulate(np.where(shared <= d, np.arange(n), 0))
        rows[:, d] = np.where(length > d, rows[source, d], 0)
    return vocabulary, rows, counts


def merged(parts: list[bytes]) -> Trie:
    """The parts of a prefix range as one trie."""
    read = [_read(p) for p in parts]
    vocabulary, rank = _ranked(pa.concat_arrays([v for v, _, _ in read]))
    rows, begin = [], 0
    for words, own, _ in read:
        number = np.concatenate(([0], rank[begin : begin + len(words)])).astype(np.int32)
        rows.append(number[own])
        begin += len(words)
    return Trie(vocabulary, np.concatenate(rows), np.concatenate([c for _, _, c in read]))


def nodes(trie: Trie, least: int) -> pa.RecordBatch:
    """lang, phrase, words, n of the nodes that occur `least` times, and of those on the first and the last path, whose
    subtrees may go on in other ranges. A language's own node has an empty phrase and no words."""
    out: dict[str, list] = {"lang": [], "phrase": [], "words": [], "n": []}
    for d in range(trie.rows.shape[1]):
        starts = np.flatnonzero(trie.shared <= d)
        n = np.add.reduceat(trie.counts, starts)
        keep = n >= least
        keep[[0, -1]] = True
        keep &= trie.rows[starts, d] != 0
        path = trie.rows[starts[keep], : d + 1]
        words = [trie.vocabulary.take(pa.array(path[:, c] - 1)).to_pylist() for c in range(d + 1)]
        out["lang"] += words[0]
        out["phrase"] += [b" ".join(p) for p in zip(*words[1:], strict=True)] if d else [b""] * len(path)
        out["words"] += [d] * len(path)
        out["n"] += n[keep].tolist()
    return pa.RecordBatch.from_arrays([pa.array(out["lang"], pa.binary()), pa.array(out["phrase"], pa.binary()), pa.array(out["words"], pa.int32()), pa.array(out["n"], pa.int64())], names=["lang", "phrase", "words", "n"])


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], list[bytes]]]:
    """Languages and texts of about SHARD_BYTES; a longer text is cut after the end of a piece."""
    langs, bodies, size = [], [], 0
    for batch in slices(batches, limit=SHARD_BYTES):
        for lang, body in zip(batch.column("lang").to_pylist(), batch.column("body").to_pylist(), strict=True):
            begin = 0
            while begin < len(body):
                cut = _NEXT_BREAK.search(body, begin + SHARD_BYTES)
                end = cut.end() if cut else len(body)
                langs.append(lang)
                bodies.append(body[begin:end] if begin or end < len(body) else body)
                size += end - begin
                begin = end
                if size >= SHARD_BYTES:
                    yield langs, bodies
                    langs, bodies, size = [], [], 0
    if bodies:
        yield langs, bodies


def _splits(docs: DataFrame, depth: int, range_bytes: int) -> list[tuple[bytes, ...]]:
    """Where prefix ranges begin, but the first: evenly spaced among the distinct windows of a sample."""
    size = docs.agg(F.sum(F.octet_length("body").cast("long"))).first()[0] or 0
    ranges = min(MAX_RANGES, -(-size // range_bytes))
    if ranges < 2:
        return []
    share = min(1.0, SAMPLE * SAMPLE_STEP / (size / 6))

    def sampled(batches):
        for langs, bodies in _stretches(batches):
            vocabulary, rows = windows_of(langs, bodies, depth, SAMPLE_STEP)
            clipped = _binary([w[:SPLIT_WORD] for w in vocabulary.to_pylist()])
            columns = [clipped.take(pa.array(rows[:, d] - 1, mask=rows[:, d] == 0)).cast(pa.binary()) for d in range(depth + 1)]
            yield pa.RecordBatch.from_arrays(columns, names=[f"w{d}" for d in range(depth + 1)])

    rows = docs.sample(share, 12).mapInArrow(sampled, ", ".join(f"w{d} binary" for d in range(depth + 1))).distinct().collect()
    found = sorted(tuple(bytes(w) for w in row if w is not None) for row in rows)
    return sorted({found[len(found) * k // ranges] for k in range(1, ranges)}) if found else []


def count_phrases(docs: DataFrame, depth: int = DEPTH, least: int = LEAST, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """lang, phrase, words, n: all phrases of 1 to `depth` words that occur `least` times in a language, and each language's
    number of words, as an empty phrase."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)).cast("binary").alias("lang"), F.col("text").cast("binary").alias("body")).where(F.octet_length("body") > 0)
    splits = _splits(texts, depth, range_bytes)
    shared = docs.sparkSession.sparkContext.broadcast(splits)  # MAX_RANGES short windows at most

    def shard(batches):
        splits = shared.value
        for langs, bodies in _stretches(batches):
            vocabulary, rows = windows_of(langs, bodies, depth, more=splits)
            real = len(rows) - len(splits)
            if not real:
                continue
            trie = Trie(vocabulary, rows, np.repeat([1, 0], [real, len(splits)]))
            del rows
            cuts = [0, *trie.place[real:].tolist(), len(trie.rows)]
            live = np.concatenate(([0], np.cumsum(trie.counts > 0)))
            if len(splits):  # the splits themselves go, where no window equals them
                keep = trie.counts > 0
                trie.rows, trie.counts = trie.rows[keep], trie.counts[keep]
                trie.shared = shared_words(trie.rows)
            cuts = live[cuts].tolist()
            parts = [(k, trie.part(a, b)) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if a < b]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in parts], pa.int32()), pa.array([p for _, p in parts], pa.binary())], names=["range", "part"])
        given_back()

    def walk(batches):
        held, now = [], None
        for batch in batches:
            for k, part in zip(batch.column("range").to_pylist(), batch.column("part").to_pylist(), strict=True):
                if k != now and held:
                    yield nodes(merged(held), least)
                    held = []
                now = k
                held.append(part)
        if held:
            yield nodes(merged(held), least)
        given_back()

    parts = texts.mapInArrow(shard, "range int, part binary").repartition(len(splits) + 1, "range").sortWithinPartitions("range")
    found = parts.mapInArrow(walk, "lang binary, phrase binary, words int, n long")
    total = found.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n")).where((F.col("n") >= least) | (F.col("words") == 0))
    return total.select(F.col("lang").cast("string").alias("lang"), F.col("phrase").cast("string").alias("phrase"), "words", "n")


def linked(found: DataFrame, depth: int = DEPTH) -> DataFrame:
    """lang, phrase, words, n, and for each cut of a phrase of two words or more the counts of its left and right parts, from
    k = 1 on; whole: whether no phrase that is longer by a word, and so no longer one at all, occurs as often."""
    empty = F.array().cast("array<bigint>")
    last, levels, swallowed = found.where("words = 1").select("lang", "phrase", "n", empty.alias("lefts"), empty.alias("rights")), [], []
    for words in range(2, depth + 1):
        level = found.where(F.col("words") == words).withColumn("parent", F.substring_index("phrase", " ", words - 1)).withColumn("suffix", F.substring_index("phrase", " ", -(words - 1)))
        up = last.select("lang", F.col("phrase").alias("parent"), F.col("n").alias("up_n"), "lefts")
        across = last.select("lang", F.col("phrase").alias("suffix"), F.col("n").alias("across_n"), "rights")
        both = level.join(up, ["lang", "parent"]).join(across, ["lang", "suffix"])
        lefts, rights = F.concat("lefts", F.array("up_n")), F.concat(F.array("across_n"), "rights")
        last = saved(both.select("lang", "phrase", "words", "n", "parent", "suffix", "up_n", "across_n", lefts.alias("lefts"), rights.alias("rights")), f"phrases-{words}")
        levels.append(last.select("lang", "phrase", "words", "n", "lefts", "rights"))
        if words > 2:
            swallowed += [last.where("n = up_n").select("lang", F.col("parent").alias("phrase")), last.where("n = across_n").select("lang", F.col("suffix").alias("phrase"))]
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    if not swallowed:
        return out.withColumn("whole", F.lit(True))
    gone = swallowed[0]
    for more in swallowed[1:]:
        gone = gone.unionByName(more)
    return out.join(gone.distinct().withColumn("whole", F.lit(False)), ["lang", "phrase"], "left").withColumn("whole", F.coalesce("whole", F.lit(True)))


def mine(docs: DataFrame, depth: int = DEPTH, least: int = LEAST, top: int = TOP, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's `top` phrases of 2 to `depth` words by score, then count, then
    phrase. The score is that of the cut into a left part (l) and a right part (r) which scores lowest, of equal ones the
    first; phrases that a longer one swallows whole are left out."""
    found = saved(count_phrases(docs, depth, least, range_bytes), "phrases")
    totals = found.where("words = 0").select("lang", F.col("n").alias("total"))
    phrases = linked(found, depth).where("whole").join(totals, "lang")
    exact = lambda c: f"CAST({c} AS DECIMAL(20, 0))"
    score = f"({PER_MILLE}BD * {exact('n')} * {exact('total')}) DIV ({exact('lefts[k]')} * {exact('rights[k]')})"
    cuts = F.expr(f"transform(sequence(0, words - 2), k -> struct({score} AS score, k AS k, lefts[k] AS l, rights[k] AS r))")
    scored = phrases.withColumn("cut", F.array_min(cuts)).select("lang", "phrase", F.col("n").alias("a"), "cut.l", "cut.r", F.col("total").alias("n"), "cut.score")
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # A language may have most of the phrases: first the best of each of its parts, then of those.
    salted = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
