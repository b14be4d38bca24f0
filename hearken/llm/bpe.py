"""Byte-pair encoding over a corpus.

ByteCodec replays merges over all distinct pre-tokens of a slice at once: an inverted index leads from a merge's
rank to the word positions where its pair stands; ranks are applied in order and only the neighbours of a merged
pair are looked up and indexed again. WordCodec does the same for vocabularies with word ends, by rounds: every
distinct word merges its lowest pair, words of one length side by side.

Null and empty texts have no ids; bytes that are not UTF-8 count as U+FFFD; equal texts get equal ids; texts of any
length are encoded whole; of pairs of one rank the leftmost merges first; each row is answered by itself, whether doc_ids
repeat or are null; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from .common import id_and_bytes, map_slices, ragged

#: Unicode White_Space, as \s means in the tokenizer libraries (Python's own \s has U+001C to U+001F as well).
SPACE = r"\t-\r \x85\xa0  -     　"
SEGMENT = re.compile(rf"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
CHUNK = re.compile(rf"[^{SPACE}]+")
ODD_SPACE = r"[\x1c-\x1f]"
#: What the library itself encodes: chunks over 64 characters, special tokens, and letters that normalisation may alter.
ODD_CHUNK = r"[^\x00-\x{12f}\x{131}-\x{24f}]|<\||^.{65}"
MARKS = pa.array(list(".,;:!?"))
NONE = np.int32(1 << 30)


class Numbering(dict):
    """Numbers keys as they come."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


class PairTable:
    """(left, right) -> (rank, merged id), in an open hash table that is looked up for whole arrays."""

    def __init__(self, left, right, rank, merged):
        keys = np.asarray(left, np.uint64) << np.uint64(32) | np.asarray(right, np.uint64)
        self.bits = max(4, int(len(keys) * 4).bit_length())
        size = 1 << self.bits
        self.keys = np.full(size, (1 << 64) - 1, np.uint64)
        self.rank, self.merged = np.full(size, NONE, np.int32), np.full(size, -1, np.int32)
        todo, step = np.arange(len(keys)), 0
        rank, merged = np.asarray(rank, np.int32), np.asarray(merged, np.int32)
        while len(todo):
            slot = self._slot(keys[todo], step)
            free = self.keys[slot] == np.uint64((1 << 64) - 1)
            _, one = np.unique(slot, return_index=True)
            won = np.zeros(len(todo), bool)
            won[one] = True
            won &= free
            at, which = slot[won], todo[won]
            self.keys[at], self.rank[at], self.merged[at] = keys[which], rank[which], merged[which]
            todo, step = todo[~won], step + 1
        self.steps = step

    def _slot(self, keys, step):
        h = keys * np.uint64(0x9E3779B97F4A7C15)
        return ((h >> np.uint64(64 - self.bits)) + np.uint64(step)) & np.uint64((1 << self.bits) - 1)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Slots; slots of absent pairs hold rank NONE."""
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        slot = self._slot(keys, 0)
        got = self.keys[slot]
        todo = np.flatnonzero((got != keys) & (got != np.uint64((1 << 64) - 1)))
        for step in range(1, self.steps + 1):
            if not len(todo):
                break
            slot[todo] = self._slot(keys[todo], step)
            got = self.keys[slot[todo]]
            todo = todo[(got != keys[todo]) & (got != np.uint64((1 << 64) - 1))]
        missing = self.keys[slot] != keys
        if missing.any():
            slot[missing] = self.empty
        return slot

    @property
    def empty(self) -> int:
        if not hasattr(self, "_empty"):
            self._empty = int(np.flatnonzero(self.rank == NONE)[0])
        return self._empty


class ByteCodec:
    """Byte-level BPE by a rank file; as the tiktoken library's encode_ordinary."""

    _cache: dict = {}

    @classmethod
    def of(cls, path: str, pattern: str) -> ByteCodec:
        if (path, pattern) not in cls._cache:
            cls._cache[path, pattern] = cls(path, pattern)
        return cls._cache[path, pattern]

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.pattern = regex.compile(pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\s", f"[{SPACE}]").replace(r"\S", f"[^{SPACE}]"))
        self.token = [b""] * (max(self.ranks.values()) + 1)
        left, right, rank = [], [], []
        for token, r in self.ranks.items():
            self.token[r] = token
            for cut in range(1, len(token)):
                if (a := self.ranks.get(token[:cut])) is not None and (b := self.ranks.get(token[cut:])) is not None:
                    left.append(a)
                    right.append(b)
                    rank.append(r)
        self.table = PairTable(left, right, rank, rank)
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.decimal = [b" %d" % i for i in range(len(self.token))]

    def plain(self, word: bytes) -> list[int]:
        """One word by itself: the lowest pair first, the leftmost of equals."""
        parts = [bytes([b]) for b in word]
        while len(parts) > 1:
            r, i = min((self.ranks.get(parts[i] + parts[i + 1], NONE), i) for i in range(len(parts) - 1))
            if r == NONE:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, one after the other, and how many each has."""
        counts = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8)
        n = len(raw)
        if not n:
            return np.empty(0, np.int32), counts
        symbol, word = self.byte[raw].copy(), np.repeat(np.arange(len(words)), counts)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        ends = np.cumsum(counts) - 1
        after[ends[counts > 0]] = -1
        before[(ends - counts + 1)[counts > 0]] = -1
        rank_at = np.full(n, NONE, np.int32)
        alive, marked = np.ones(n, bool), np.zeros(n, bool)
        odd: set[int] = set()
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def note(where: np.ndarray, floor: int) -> None:
            """Index the pairs that begin at these positions."""
            where = where[after[where] >= 0]
            slots = self.table.find(symbol[where], symbol[after[where]])
            ranks = self.table.rank[slots]
            rank_at[where] = ranks
            found = ranks != NONE
            where, ranks = where[found], ranks[found]
            if not len(where):
                return
            if floor >= 0 and (low := ranks < floor).any():
                odd.update(word[where[low]].tolist())
            order = np.argsort(ranks, kind="stable")
            where, ranks = where[order], ranks[order]
            cuts = np.flatnonzero(np.diff(ranks)) + 1
            for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ranks)], strict=True):
                r = int(ranks[begin])
                if r not in index:
                    index[r] = []
                    heapq.heappush(heap, r)
                index[r].append(where[begin:end])

        note(np.arange(n), -1)
        while heap:
            r = heapq.heappop(heap)
            at = index.pop(r)
            at = np.sort(np.concatenate(at))
            at = at[rank_at[at] == r]
            at = at[np.diff(at, prepend=-1) > 0]
            if not len(at):
                continue
            following = after[at]
            marked[at] = True
            if marked[following].any():  # overlapping: the left one goes first
                marked[at] = False
                taken, last, link = [], -1, following.tolist()
                for p, q in zip(at.tolist(), link, strict=True):
                    if p != last:
                        taken.append(p)
                        last = q
                at = np.array(taken)
                following = after[at]
                marked[at] = True
            symbol[at] = r
            beyond = after[following]
            after[at] = beyond
            alive[following] = False
            rank_at[following] = NONE
            rank_at[at] = NONE
            there = beyond >= 0
            before[beyond[there]] = at[there]
            previous = before[at]
            previous = previous[previous >= 0]
            previous = previous[~marked[previous]]
            marked[at] = False
            note(np.concatenate((at, previous)), r)
        ids, counts = symbol[alive], np.bincount(word[alive], minlength=len(words))
        whole = {i: [r] for i, w in enumerate(words) if (r := self.ranks.get(w)) is not None and counts[i] != 1}
        redo = whole | {i: self.plain(words[i]) for i in odd if i not in whole and words[i] not in self.ranks}
        if redo:
            parts = np.split(ids, np.cumsum(counts)[:-1])
            for i, own in redo.items():
                parts[i] = np.array(own, np.int32)
            ids, counts = np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))
        return ids, counts

    def encode(self, bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and how many each has."""
        segments, texts = Numbering(), []
        number = segments.__getitem__
        for body in bodies:
            found = SEGMENT.findall(body.decode("utf-8", "replace"))
            texts.append(np.fromiter(map(number, found), np.int64, len(found)))
        words, parts, sizes = Numbering(), [], []
        for segment in segments:
            bare = segment[1:] if segment[0] == " " else segment
            cut = (segment,) if bare.isalpha() else self.pattern.findall(segment)
            sizes.append(len(cut))
            parts += [words[w] for w in cut]
        ids, counts = self.replay([w.encode() for w in words])
        ids, counts = gathered(ids, counts, np.array(parts, np.int64), np.array(sizes, np.int64))
        every = np.concatenate(texts) if texts else np.empty(0, np.int64)
        return gathered(ids, counts, every, np.fromiter(map(len, texts), np.int64, len(texts)))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


def gathered(values: np.ndarray, counts: np.ndarray, parts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lists made of lists: list i consists of the next sizes[i] of `parts`, numbers of lists in (values, counts)."""
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), pa.array(values, pa.int32()))
    total = np.concatenate(([0], np.cumsum(counts[parts])))
    ends = np.cumsum(sizes)
    return lists.take(pa.array(parts, pa.int64())).flatten().to_numpy(), total[ends] - total[ends - sizes]


def decoded(bodies: list[bytes] | pa.Array) -> pa.Array:
    """Texts; bytes that are not UTF-8 count as U+FFFD."""
    bodies = bodies if isinstance(bodies, pa.Array) else pa.array(bodies, pa.binary())
    try:
        return bodies.cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([b.decode("utf-8", "replace") for b in bodies.to_pylist()], pa.string())


def split_spaces(texts: pa.Array) -> pa.ListArray:
    """The chunks between white space of each text, and empty ones where white space begins or ends it."""
    raw, _ = laid_out(texts)
    if ((raw - np.uint8(0x1C)) < 4).any():  # Arrow takes these for white space
        odd = pc.match_substring_regex(texts, ODD_SPACE)
        rows = [CHUNK.findall(t) for t in texts.filter(odd).to_pylist()]
        both = pa.concat_arrays([split_spaces(texts.filter(pc.invert(odd))), pa.array(rows, pa.list_(pa.string()))])
        order = np.argsort(odd.to_numpy(zero_copy_only=False), kind="stable")
        return both.take(pa.array(np.argsort(order)))
    return pc.utf8_split_whitespace(texts)


def laid_out(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all strings, one after the other, and how many each has."""
    _, offsets, data = strings.buffers()
    cuts = np.frombuffer(offsets, np.int32)[strings.offset : strings.offset + len(strings) + 1].astype(np.int64) if len(strings) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[cuts[0] : cuts[-1]] if cuts[-1] > cuts[0] else np.empty(0, np.uint8)
    return raw, np.diff(cuts)


class WordCodec:
    """BPE with word ends by a tokenizers file of the form: NFC, lower case, words split from white space."""

    _cache: dict = {}

    @classmethod
    def of(cls, path: str) -> WordCodec:
        if path not in cls._cache:
            cls._cache[path] = cls(path)
        return cls._cache[path]

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, end = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        rows = [(vocab[a], vocab[b], r, vocab[a + b]) for r, (a, b) in enumerate(pairs)]
        self.table = PairTable(*zip(*rows, strict=True))
        self.merged = np.array([m for *_, m in rows], np.int32)  # by rank
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = regex.compile(split.replace(r"[^\s", f"[^{SPACE}"))
        chars = byte_characters()
        self.inner = np.array([vocab[c] for c in chars], np.int32)
        self.last = np.array([vocab[c + end] for c in chars], np.int32)
        self.byte = np.concatenate((self.inner, self.last))
        self.first = self.table.rank[self.table.find(np.repeat(self.byte, 512), np.tile(self.byte, 512))]  # of each two bytes
        self.special = [t["content"] for t in spec["added_tokens"]]

    def rounds(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, one after the other, and how many each has."""
        raw, lengths = laid_out(words)
        starts = np.cumsum(lengths) - lengths
        code = raw.astype(np.int32)
        code[starts + lengths - 1] += 256
        counts = np.zeros(len(words), np.int64)
        kept: list[tuple[np.ndarray, np.ndarray]] = []
        for n in np.unique(lengths):
            which = np.flatnonzero(lengths == n)
            rows = code[starts[which][:, None] + np.arange(n)]
            ranks = self.first.take((rows[:, :-1] << 9) + rows[:, 1:])
            rows = self.byte.take(rows)
            while ranks.shape[1]:
                j = ranks.argmin(axis=1)
                best = ranks[np.arange(len(rows)), j]
                done = best == NONE
                if done.any():
                    kept.append((which[done], rows[done]))
                    go = ~done
                    which, rows, ranks, j, best = which[go], rows[go], ranks[go], j[go], best[go]
                    if not len(which):
                        break
                at, width = np.arange(len(rows)), rows.shape[1]
                rows[at, j] = self.merged.take(best)
                column = np.arange(width - 1)
                rows = np.where(column > j[:, None], rows[:, 1:], rows[:, :-1])
                ranks = np.where(column[:-1] >= j[:, None], ranks[:, 1:], ranks[:, :-1])
                right = np.flatnonzero(j < width - 2)
                ranks[right, j[right]] = self.table.rank[self.table.find(rows[right, j[right]], rows[right, j[right] + 1])]
                left = np.flatnonzero(j > 0)
                ranks[left, j[left] - 1] = self.table.rank[self.table.find(rows[left, j[left] - 1], rows[left, j[left]])]
            else:
                kept.append((which, rows))
        for which, rows in kept:
            counts[which] = rows.shape[1]
        ids, starts = np.empty(counts.sum(), np.int32), np.cumsum(counts) - counts
        for which, rows in kept:
            ids[starts[which][:, None] + np.arange(rows.shape[1])] = rows
        return ids, counts

    def encode(self, bodies: list[bytes] | pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, each followed by `end`, and how many each has."""
        found = split_spaces(decoded(bodies))
        own = np.diff(found.offsets.to_numpy())
        chunks = found.flatten().dictionary_encode()
        names = chunks.dictionary
        odd = pc.match_substring_regex(names, ODD_CHUNK)
        small = pc.utf8_lower(names)
        # Most chunks are a word, or a word and a mark; the pattern cuts the others.
        single = pc.and_not(pc.utf8_is_alpha(small), odd)
        head, mark = pc.utf8_slice_codeunits(small, 0, -1), pc.utf8_slice_codeunits(small, -1)
        double = pc.and_not(pc.and_not(pc.and_(pc.utf8_is_alpha(head), pc.is_in(mark, MARKS)), single), odd)
        others = pc.invert(pc.or_(pc.or_(single, double), odd))
        cut = [self.pattern.findall(c) for c in small.filter(others).to_pylist()]
        apart = pa.array([w for c in cut for w in c], pa.string())
        words = pa.concat_arrays([small.filter(single), head.filter(double), mark.filter(double), apart]).dictionary_encode()
        single, double, others, odd = (np.flatnonzero(m.to_numpy(zero_copy_only=False)) for m in (single, double, others, odd))
        sizes = np.ones(len(names), np.int64)
        sizes[double] = 2
        sizes[others] = np.fromiter(map(len, cut), np.int64, len(cut))
        sizes[odd] = 0
        starts = np.cumsum(sizes) - sizes
        parts = np.empty(int(sizes.sum()), np.int64)
        group, place = ragged(sizes[others])
        parts[np.concatenate((starts[single], starts[double], starts[double] + 1, starts[others][group] + place))] = words.indices.to_numpy()
        ids, counts = gathered(*self.rounds(words.dictionary), parts, sizes)
        if len(odd):
            extra = [self.library.encode(c, add_special_tokens=False).ids for c in names.take(pa.array(odd)).to_pylist()]
            parts = np.arange(len(counts))
            parts[odd] = len(counts) + np.arange(len(extra))
            counts = np.concatenate((counts, np.fromiter(map(len, extra), np.int64, len(extra))))
            ids, counts = gathered(np.concatenate((ids, *(np.array(v, np.int32) for v in extra))), counts, parts, np.ones(len(parts), np.int64))
        ids, counts = gathered(ids, counts, chunks.indices.to_numpy(), own)
        if end is None:
            return ids, counts
        return np.insert(ids, np.cumsum(counts), end), counts + 1


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids array<int>: every text by byte-level BPE."""

    def work(batch):
        ids, counts = ByteCodec.of(path, pattern).encode(batch.column("body").to_pylist())
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), pa.array(ids, pa.int32()))
        return pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "ids": lists})

    return map_slices(id_and_bytes(docs), work, "doc_id long, ids array<int>", limit=16 << 20)


def decode(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, body binary: the bytes that the ids stand for."""

    def run(batches):
        codec = ByteCodec.of(path, pattern)
        for batch in batches:
            bodies = [codec.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "body": pa.array(bodies, pa.binary())})

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id long, body binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encodes and decodes in one pass, so that no id leaves its task."""

    def work(batch):
        codec = ByteCodec.of(path, pattern)
        ids, counts = codec.encode(batch.column("body").to_pylist())
        names, decoded, begin = [], [], 0
        for n in counts.tolist():
            own = ids[begin : begin + n].tolist()
            begin += n
            names.append(hashlib.sha256(b"".join(map(codec.decimal.__getitem__, own))[1:]).hexdigest())
            decoded.append(hashlib.sha256(codec.decode(own)).hexdigest())
        return pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "n_tokens": pa.array(counts, pa.int64()), "ids_sha256": pa.array(names), "decoded_sha256": pa.array(decoded)})

    return map_slices(id_and_bytes(docs), work, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", limit=32 << 20)
