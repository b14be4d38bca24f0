"""Token ids in binary blocks, by an adaptive context-mixing range coder.

A block holds the ids of a run of tokens and is coded by itself: its models start afresh and it carries a checksum. Order
2 and order 1 each predict the id that followed the same two ids, or the same id, last; order 0 predicts by the counts of
the ids seen in the block, and ids not seen yet have a share that is spread by adaptive counts of their size. The shares
are mixed by weights that each block learns from what came of its predictions, by their confidence; predictions that agree
add up. Counts and weights are brought up to date at EPOCHS. The mixture drives a range coder with carries and a window of
48 bits, one step an id. The writer knows all ids, so it tells the intervals of whole blocks by sorts and running sums, and
only narrows step by step; the reader takes all blocks of a slice side by side, one position at a time. Both work by array
operations. A block that does not shrink is kept as 16-bit ids, so that none is longer than that by more than its first
byte.

The files are tables of blocks in the shared folder, ordered by document id: (block, tokens, crc32, payload), beside the
documents' lengths. Null texts are documents of their end id alone; documents of any length run over as many blocks as
they need; rows that repeat a doc_id, or have none, are documents of their own, in the order of their texts' hashes, and
rows without doc_id come first; other columns are ignored; an empty table makes no block.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import WordCodec
from .common import given_back, ragged, saved, slices

END_ID, BLOCK = 2, 2048
LANES = 8192  # blocks coded side by side
LONGEST = 4095  # ids of a block, as a place and its confidence share 16 bits
BITS = 10  # of the slot numbers
#: Places at which the order-0 counts and the mixing weights are brought up to date.
EPOCHS = (16, 48, 128, 320, 768, 1408, 2048, 3072)
#: What a prediction is worth at first, out of 4096, by its confidence: of order 1, of order 2.
FIRST = np.array([[0, 300, 900, 1500, 2000, 2400, 2700, 2900], [0, 1400, 2400, 3000, 3300, 3500, 3600, 3700]], np.int32)
TRUST = 6  # ids that the first worth counts for
MOST, LEAST, REST, RARE = 3840, 64, 64, 32  # bounds of shares: a prediction's, what predictions leave, and new ids'
#: Confidence after a miss, and after a hit.
MOVE = np.array([1, 1, 1, 1, 1, 1, 1, 2, 1, 2, 3, 4, 5, 6, 7, 7], np.uint32)
#: New ids are spread over classes, each from one of these ids to the next, of so many bits.
EDGES = np.array([0, 512, 1024, 2048, 4096, 8192, 16384, 32768], np.int32)
WIDTHS = np.array([9, 9, 10, 11, 12, 13, 14, 15], np.int32)
CLASS = np.repeat(np.arange(8), 1 << WIDTHS)
NOTHING = 0xFFFF  # no id
MIX1, MIX2 = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77)
RAW16, RAW32, CODED = 0, 2, 3  # a payload's first byte
WORD, WINDOW, PARTS = 65536.0, float(1 << 48), float(1 << 28)  # of the range coder; shares of 12 bits are coded in 2**28 parts
LEAST_RANGE = float(1 << 32)
TOGETHER = 64  # lanes whose intervals are told together


class Weights:
    """What predictions of each lane are worth, and the share of new ids; encoder and decoder take the same steps. Arrays
    of two rows are the order-1 and the order-2 model's."""

    def __init__(self, lanes: int):
        self.code = np.arange(2 * lanes).reshape(2, lanes) << 4
        self.worth = np.repeat(np.concatenate((FIRST, FIRST), axis=1)[:, None], lanes, axis=1)
        self.tally = np.zeros((2, lanes, 16), np.int32)
        self.new, self.fresh = np.zeros((lanes, 8), np.int32), np.full(lanes, 4096, np.int32)
        self.spread = np.arange(0, 256, 32, dtype=np.int32) * 512 + np.full((lanes, 1), 32, np.int32)

    def count(self, codes: np.ndarray) -> None:
        """Counts outcomes: places in the tally, 8 more than the confidence's for a hit."""
        self.tally += np.bincount(codes.reshape(-1), minlength=self.tally.size).astype(np.int32).reshape(self.tally.shape)

    def update(self, t: int) -> None:
        """Weighs predictions by what came of them in the first t places."""
        missed, hit = self.tally[:, :, :8], self.tally[:, :, 8:]
        share = np.clip((hit * 4096 + FIRST[:, None] * TRUST) // (missed + hit + TRUST), LEAST, MOST)
        share[:, :, 0] = 0
        self.worth[:, :, :8] = self.worth[:, :, 8:] = share
        total = self.new.sum(axis=1)
        others = np.maximum(t - hit.sum(axis=(0, 2)), total)
        self.fresh = np.minimum((total * 4096 + 8192) // (others + 4), 3072).astype(np.int32)
        share = 4 + (self.new * 8 + 8) * 224 // (total * 8 + 64)[:, None]
        self.spread[:] = (np.cumsum(share, axis=1) - share << 9) + share

    def classes(self) -> np.ndarray:
        """For each lane, the class of each of the 256 parts that new ids' share has."""
        out = np.zeros((len(self.new), 256), np.uint8)
        np.put_along_axis(out, self.spread[:, 1:] >> 9, 1, axis=1)
        return np.cumsum(out, axis=1, dtype=np.uint8).reshape(-1)


def _shares(w1, w2, agree, fresh, counted: int):
    """How 2**28 is shared: where order 2 ends and where order 1 does, what an id counted once has, and the part (12 bits) of
    new ids. Of the worths given, the first is used up."""
    w1 *= 4096 - REST - w2
    w1 >>= 12
    w1 += w2
    left = 4096 - w1
    rare = left * fresh
    rare >>= 12
    np.maximum(rare, RARE, out=rare)
    left -= rare
    left <<= 16
    left //= max(1, counted)
    end2 = np.where(agree, w1, w2)  # equal predictions add up
    end2 <<= 16
    w1 <<= 16
    return end2, w1, left, rare


def _ends(longest: int) -> list[int]:
    return [0, *(e for e in EPOCHS if e < longest), longest]


def _plan(lengths: np.ndarray):
    """Lanes by falling length, where each begins, and how many are live at each step."""
    order = np.argsort(-lengths, kind="stable")
    sizes = lengths[order]
    lives = np.searchsorted(-sizes, -np.arange(int(sizes[0]) if len(sizes) else 0), side="left").tolist()
    return order, (np.cumsum(lengths) - lengths)[order], lives


def _groups(lengths: np.ndarray) -> list[slice]:
    """Blocks that are coded side by side, LANES at the most."""
    n = -(-len(lengths) // LANES)
    cuts = [len(lengths) * k // n for k in range(n + 1)] if n else []
    return [slice(a, b) for a, b in zip(cuts, cuts[1:], strict=False)]


def encode_blocks(ids: np.ndarray, lengths: np.ndarray) -> list[bytes]:
    """The payload of each block; blocks follow one another in `ids`. A block whose ids do not shrink is kept as it is, and
    one with ids of 65535 or more, which the models do not know, in 32 bits each."""
    if len(lengths) and int(lengths.max()) > LONGEST:
        raise ValueError(f"a block has {LONGEST} ids at the most")
    out, begin = [], 0
    for group in _groups(lengths):
        sizes = lengths[group]
        own = ids[begin : begin + int(sizes.sum())]
        begin += len(own)
        starts = np.cumsum(sizes) - sizes
        for coded, at, n in zip(_encoded(np.minimum(own, NOTHING - 1).astype(np.uint16), sizes), starts.tolist(), sizes.tolist(), strict=True):
            block = own[at : at + n]
            if n and int(block.max()) >= NOTHING:
                out.append(bytes([RAW32]) + block.astype("<u4").tobytes())
            elif len(coded) >= 2 * n:
                out.append(bytes([RAW16]) + block.astype("<u2").tobytes())
            else:
                out.append(bytes([CODED]) + coded)
    return out


def _foretold(ids: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """For each lane and place, what its slot foretells: the id that followed the slot's context last (above 4 bits), whether
    that is right (8), and the confidence (7).

    In the order of slots and then of places a slot's state is told by where it missed last: from there on each hit adds
    one up to 7, beginning with 1, or with 2 if the miss was one of confidence 7."""
    lanes, n = ids.shape
    key = slots << 12
    key |= np.arange(n, dtype=np.int32)
    key.sort(axis=1)
    at = ((key & 4095) + np.arange(0, lanes * n, n, dtype=np.int32)[:, None]).reshape(-1)
    key = key.reshape(-1)
    own = ids.reshape(-1).take(at, mode="clip")
    same = np.zeros(len(key), bool)
    np.less(key[1:] ^ key[:-1], 4096, out=same[1:])
    same[::n] = False
    hit = same.copy()
    hit[1:] &= own[1:] == own[:-1]
    number = np.arange(len(key), dtype=np.int32)
    missed = np.maximum.accumulate(np.where(hit, 0, number))
    run = np.zeros(len(key), np.int32)  # hits since the last miss
    np.subtract(number[:-1], missed[:-1], out=run[1:])
    failed = same & ~hit
    fell = (failed & (run >= 6)).view(np.uint8)  # misses of confidence 7
    unsure = np.flatnonzero(failed & (run == 5))  # of 7 only if the miss before them was
    if len(unsure):
        before = missed[unsure - 1]
        while (now := fell[before]).tobytes() != fell[unsure].tobytes():
            fell[unsure] = now
    run += 1
    run[1:] += fell.take(missed[:-1], mode="clip")
    np.minimum(run, 7, out=run)
    run |= hit.view(np.uint8) << np.uint8(3)
    run[1:] |= own[:-1].astype(np.int32) << 4
    np.copyto(run, NOTHING << 4, where=~same)
    out = np.empty(len(key), np.int32)
    out[at] = run
    return out.reshape(lanes, n)


def _intervals(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> None:
    """Start and size of the interval of each id (lanes, places), in parts of 2**28, into `starts` and `sizes` (places,
    lanes). What follows a lane's end alters nothing before it. What order 0 gives to a predicted id besides is left out
    of its size."""
    lanes, n = ids.shape
    last = np.zeros((lanes, n), np.uint32)
    last[:, 1:] = ids[:, :-1]
    last *= MIX1
    other = last.copy()
    other[:, 1:] ^= last[:, :-1] >> np.uint32(7)
    other *= MIX2
    told = np.stack([_foretold(ids, (p >> np.uint32(32 - BITS)).view(np.int32)) for p in (last, other)])
    # Order 0: in the order of ids, the ids of a kind stand together, and of those counted so far they are a run as well.
    key = ids.astype(np.int32) << 12
    key |= np.arange(n, dtype=np.int32)
    key.sort(axis=1)
    place = key & 4095
    key = key.reshape(-1)
    edge = np.ones(len(key), bool)
    np.greater(key[1:] ^ key[:-1], 4095, out=edge[1:])
    edge[::n] = True
    begins = np.flatnonzero(edge)
    counts = np.diff(begins, append=len(key))
    row = np.arange(lanes, dtype=np.int32)[:, None]
    kinds = np.empty(len(key), np.int32)
    kinds[(place + row * n).reshape(-1)] = np.repeat(((begins % n << 12) + counts).astype(np.int32), counts)
    kinds = kinds.reshape(lanes, n)
    weights, ends = Weights(lanes), _ends(n)
    before = np.zeros((lanes, n + 1), np.int32)
    for a, b in zip(ends, ends[1:], strict=False):
        first = order = np.zeros((lanes, b - a), np.int32)
        if a:
            weights.update(a)
            np.cumsum(place < a, axis=1, out=before[:, 1:])
            kind = kinds[:, a:b]
            at = (kind >> 12) + row * (n + 1)
            first = before.take(at, mode="clip")
            at += kind & 4095
            order = before.take(at, mode="clip") - first
        codes = told[:, :, a:b] & 15
        guess = told[:, :, a:b] >> 4
        agree = guess[0] == guess[1]
        right1, right2 = codes > 7
        w1, w2 = weights.worth.take(codes + weights.code[:, :, None], mode="clip")  # a hit's worth is the miss's
        end2, end1, part, rare = _shares(w1, w2, agree, weights.fresh[:, None], a)
        start, size = first * part, order * part
        start += end1
        np.copyto(start, end2, where=right1)
        np.copyto(size, end1 - end2, where=right1)
        np.copyto(start, 0, where=right2)
        np.copyto(size, end2, where=right2)
        new = np.flatnonzero(size == 0)
        if len(new):
            own = ids[:, a:b].reshape(-1).take(new)
            cls = CLASS.take(own)
            at = (new // (b - a) << 3) + cls
            weights.new += np.bincount(at, minlength=8 * lanes).astype(np.int32).reshape(lanes, 8)
            rare, spread = rare.reshape(-1).take(new) << 8, weights.spread.take(at)
            more = rare * (spread & 511) >> WIDTHS.take(cls)
            size.reshape(-1)[new] = more
            more *= own - EDGES.take(cls)
            more += rare * (spread >> 9)
            more += end1.reshape(-1).take(new) + a * part.reshape(-1).take(new)
            start.reshape(-1)[new] = more
        codes[0] *= ~(right2 | agree)
        weights.count(codes + weights.code[:, :, None])
        starts[a:b], sizes[a:b] = start.T, size.T


def _encoded(ids: np.ndarray, lengths: np.ndarray) -> list[bytes]:
    """The words of each block. Floats hold the coder's window of 48 bits exactly; a word of 16 bits goes while the range is
    below 2**32. What is carried out of the window is added to the words before it at the end."""
    order, begins, lives = _plan(lengths)
    lanes, longest = len(lengths), len(lives)
    starts, sizes = np.empty((longest, lanes), np.int32), np.empty((longest, lanes), np.int32)
    place = np.arange(longest)
    for k in range(0, lanes if longest else 0, TOGETHER):
        n = int(lengths[order[k]])
        group = slice(k, k + TOGETHER)
        _intervals(ids.take(begins[group, None] + place[:n], mode="clip"), starts[:n, group], sizes[:n, group])
    low, width = np.zeros(lanes), np.full(lanes, WINDOW)
    most = longest + 12  # words that are kept: a block with as many words as ids does not shrink
    words, at = np.zeros(lanes * most, np.int32), np.arange(lanes) * most
    full = at + longest + 4
    for t, live in enumerate(lives):
        l, w = low[:live], width[:live]
        w *= 1 / PARTS
        np.floor(w, out=w)
        l += w * starts[t, :live]
        w *= sizes[t, :live]
        small = np.flatnonzero(w < LEAST_RANGE)
        while len(small):
            own = l.take(small)
            out = np.floor(own * (1 / LEAST_RANGE))
            here = at.take(small)
            words[here] = out
            here += 1
            at[small] = here
            out *= LEAST_RANGE
            own -= out
            own *= WORD
            l[small] = own
            own = w.take(small) * WORD
            w[small] = own
            small = small[own < LEAST_RANGE]
        if t & 1:  # a step makes two words at the most
            np.minimum(at, full, out=at)
    low += WORD - 1  # the range is 2**32 at least: two words tell a number in it, whatever follows
    for out in (np.floor(low / LEAST_RANGE), np.floor(low / WORD) % WORD):
        words[at] = out
        at += 1
    counts = at - np.arange(lanes) * most
    while len(over := np.flatnonzero(words > 65535)):
        words[over] -= 65536
        words[over - 1] += 1
    rows = words.astype("<u2").reshape(lanes, most)
    blocks = [b""] * lanes
    for lane, (which, n) in enumerate(zip(order.tolist(), counts.tolist(), strict=True)):
        blocks[which] = rows[lane, :n].tobytes()
    return blocks


def decode_blocks(payloads: list[bytes], lengths: np.ndarray) -> np.ndarray:
    """The ids of all blocks, one after the other."""
    ids = np.empty(int(lengths.sum()), np.int32)
    starts = np.cumsum(lengths) - lengths
    kinds = np.fromiter((p[0] if p else -1 for p in payloads), np.int64, len(payloads))
    for kind, width in ((RAW16, "<u2"), (RAW32, "<u4")):
        for i in np.flatnonzero(kinds == kind).tolist():
            own = np.frombuffer(payloads[i], width, offset=1)
            ids[starts[i] : starts[i] + len(own)] = own
    coded = np.flatnonzero(kinds == CODED)
    for group in _groups(coded):
        which = coded[group]
        with np.errstate(over="ignore", invalid="ignore"):  # of damaged blocks, which their checksums tell
            found, order = _decoded([payloads[i] for i in which], lengths[which])
        for k, i in enumerate(which[order].tolist()):
            ids[starts[i] : starts[i] + lengths[i]] = found[k, : lengths[i]]
    return ids


def _ranked(ids: np.ndarray) -> np.ndarray:
    """The ids (places, lanes) in ascending order by lane; each (above 32 bits) with the number of those that are smaller
    (12 bits) and its count (12 bits)."""
    t, lanes = ids.shape
    out = np.empty((lanes, t), np.int64)
    for k in range(0, lanes, TOGETHER):
        keys = ids[:, k : k + TOGETHER].T.astype(np.int32)
        keys.sort(axis=1)
        edge = np.ones(keys.shape, bool)
        np.not_equal(keys[:, 1:], keys[:, :-1], out=edge[:, 1:])
        firsts = np.flatnonzero(edge)
        values = keys.reshape(-1).take(firsts).astype(np.int64) << 32
        values += (firsts % t << 12) + np.diff(firsts, append=keys.size)
        kind = np.cumsum(edge, dtype=np.int32)
        kind -= 1
        out[k : k + TOGETHER] = values.take(kind).reshape(len(keys), t)
    return out.reshape(-1)


def _decoded(payloads: list[bytes], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the blocks (lanes, places), and the block of each lane. A slot holds an id and its confidence (4 bits)."""
    order, _, lives = _plan(lengths)
    lanes, ends = len(lengths), _ends(len(lives))
    words = np.frombuffer(b"".join([payloads[i][1:] for i in order] + [bytes(8)]), "<u2")
    sizes = np.array([len(payloads[i]) // 2 for i in order], np.int64)
    at = np.cumsum(sizes) - sizes
    value = (words[at] * WORD + words[at + 1]) * WORD + words[at + 2]
    at += 3
    width = np.full(lanes, WINDOW)
    weights = Weights(lanes)
    lane = np.arange(lanes)
    base = np.stack((lane, lane + lanes)) << BITS
    slots = np.full(2 * lanes << BITS, NOTHING << 4, np.uint32)
    context, last, mixed = np.zeros((2, lanes), np.uint32), np.zeros(lanes, np.uint32), np.zeros(lanes, np.uint32)
    ids = np.zeros((len(lives), lanes), np.uint16)
    seen = np.zeros((max(b - a for a, b in zip(ends, ends[1:], strict=False)), 2, lanes), np.uint8)
    counted, classes = 0, weights.classes()
    for t, live in enumerate(lives):
        if t in EPOCHS:
            codes = seen[: t - counted]
            for k in range(0, len(codes), 64):
                weights.count(codes[k : k + 64] + weights.code)
            weights.update(t)
            ranked, row, counted = _ranked(ids[:t, :live]), lane * t, t
            classes = weights.classes()
        p = context[:, :live]
        np.multiply(last[:live], MIX1, out=p[0])
        np.bitwise_xor(p[0], mixed[:live], out=p[1])
        p[1] *= MIX2
        np.right_shift(p[0], np.uint32(7), out=mixed[:live])
        where = base[:, :live] + (p >> np.uint32(32 - BITS))
        slot = slots.take(where, mode="wrap")
        level = slot & np.uint32(7)
        slot >>= np.uint32(4)
        guess1, guess2 = slot
        w1, w2 = weights.worth.take(weights.code[:, :live] + level, mode="wrap")
        agree = guess1 == guess2
        end2, end1, part, rare = _shares(w1, w2, agree, weights.fresh[:live], counted)
        v, w = value[:live], width[:live]
        w *= 1 / PARTS
        np.floor(w, out=w)
        target = np.minimum(v / w, PARTS - 1).astype(np.int32)
        hit1, hit2 = target < end1, target < end2
        target -= end1
        if counted:
            place = (target / part).astype(np.int64)
            np.minimum(place, counted, out=place)
            new = np.flatnonzero(place == counted)
            place += row[:live]
            found = ranked.take(place, mode="clip").view(np.uint32)
            own, kind = found[1::2].copy(), found[::2].view(np.int32)
            start, size = (kind >> 12) * part, (kind & 4095) * part
            start += end1
        else:
            new = np.flatnonzero(~hit1)
            own, start, size = np.zeros(live, np.uint32), np.zeros(live, np.int32), np.ones(live, np.int32)
        if len(new):
            much = rare.take(new, mode="wrap") << 8
            skipped = counted * part.take(new, mode="wrap")
            rest = target.take(new, mode="wrap") - skipped
            cls = classes.take((new << 8) + np.minimum(rest // much, 255), mode="wrap")
            cell = (new << 3) + cls
            weights.new.reshape(-1)[cell] += 1
            spread = weights.spread.take(cell, mode="wrap")
            bits = WIDTHS.take(cls, mode="wrap")
            one = much * (spread & 511) >> bits
            much *= spread >> 9
            rest -= much
            rest //= one
            np.minimum(rest, (1 << bits) - 1, out=rest)
            own[new] = EDGES.take(cls, mode="wrap") + rest
            rest *= one
            rest += much
            rest += skipped
            rest += end1.take(new, mode="wrap")
            start[new], size[new] = rest, one
        np.copyto(own, guess1, where=hit1)
        np.copyto(own, guess2, where=hit2)
        np.copyto(start, end2, where=hit1)
        np.copyto(start, 0, where=hit2)
        end1 -= end2
        np.copyto(size, end1, where=hit1)
        np.copyto(size, end2, where=hit2)
        v -= w * start
        w *= size
        small = np.flatnonzero(w < LEAST_RANGE)
        while len(small):
            here = at.take(small, mode="wrap")
            v[small] = v.take(small, mode="wrap") * WORD + words.take(here, mode="clip")
            here += 1
            at[small] = here
            wide = w.take(small, mode="wrap") * WORD
            w[small] = wide
            small = small[wide < LEAST_RANGE]
        right = slot == own
        level += right.view(np.uint8) << np.uint8(3)
        slots[where] = MOVE.take(level, mode="wrap") | own << np.uint32(4)
        level[0] *= ~(right[1] | agree)
        seen[t - counted, :, :live] = level
        ids[t, :live] = own
        last[:live] = own
    return ids.T, order


def write_tokens(docs: DataFrame, path: str, end_id: int = END_ID, block: int = BLOCK) -> DataFrame:
    """Writes the ids of all documents in ascending doc_id order; the table of blocks written.

    Each row is one block: part and block number it in file order, doc_ids and doc_counts are the documents that begin
    or go on in it and their ids there, first_doc the number in its part of the first of them, tokens the sum of their
    ids, crc32 the checksum of the ids, payload the coded ids."""

    def run(batches):
        part = -1
        number = documents = 0
        for batch in slices(batches, "body", 32 << 20):
            if part < 0:
                from pyspark import TaskContext

                part = TaskContext.get().partitionId()
            ids, counts = WordCodec.of(path).encode(batch.column("body"), end_id)
            total = len(ids)
            lengths = np.full(-(-total // block), block, np.int64)
            lengths[-1] = total - block * (len(lengths) - 1)
            payloads = encode_blocks(ids, lengths)
            begins = np.cumsum(counts) - counts
            first, last = begins // block, (begins + counts - 1) // block
            doc, k = ragged(last - first + 1)  # a row for each block that a document is in
            home = first[doc] + k
            share = np.minimum(begins[doc] + counts[doc], (home + 1) * block) - np.maximum(begins[doc], home * block)
            owners = np.array(batch.column("doc_id").to_pylist(), object)[doc]
            cuts = np.searchsorted(home, np.arange(len(lengths) + 1))
            raw = ids.astype("<u4")
            crcs = [zlib.crc32(raw[i * block : (i + 1) * block]) for i in range(len(lengths))]
            offsets = pa.array(cuts, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(lengths), part), pa.int32()), pa.array(number + np.arange(len(lengths)), pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(list(owners), pa.int64())), pa.ListArray.from_arrays(offsets, pa.array(share, pa.int64())), pa.array(documents + doc[cuts[:-1]], pa.int64()), pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64()), pa.array(payloads, pa.binary())],
                names=["part", "block", "doc_ids", "doc_counts", "first_doc", "tokens", "crc32", "payload"],
            )
            number += len(lengths)
            documents += batch.num_rows
        given_back()

    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("body")).orderBy("doc_id", F.xxhash64("body"))
    return saved(ordered.mapInArrow(run, "part int, block long, doc_ids array<bigint>, doc_counts array<bigint>, first_doc long, tokens long, crc32 long, payload binary"), "token-blocks")


def read_tokens(blocks: DataFrame) -> DataFrame:
    """doc_id, part, block, place, ids of each stretch of ids of a document, in the order of the file; a wrong checksum raises."""

    def run(batches):
        for batch in slices(batches, "payload", 16 << 20):
            lengths = batch.column("tokens").to_numpy()
            ids = checked(batch, lengths)
            shares = batch.column("doc_counts").combine_chunks() if isinstance(batch.column("doc_counts"), pa.ChunkedArray) else batch.column("doc_counts")
            n = np.array([len(x) for x in shares.to_pylist()])
            group, place = ragged(n)
            sizes = shares.flatten().to_numpy()
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_ids").flatten(), batch.column("part").take(pa.array(group)), batch.column("block").take(pa.array(group)), pa.array(place, pa.int32()), lists], names=["doc_id", "part", "block", "place", "ids"])

    return blocks.mapInArrow(run, "doc_id long, part int, block long, place int, ids array<int>")


def checked(batch: pa.RecordBatch, lengths: np.ndarray) -> np.ndarray:
    ids = decode_blocks(batch.column("payload").to_pylist(), lengths)
    raw, begin = ids.astype("<u4"), 0
    for n, crc in zip(lengths.tolist(), batch.column("crc32").to_pylist(), strict=True):
        if zlib.crc32(raw[begin : begin + n]) != crc:
            raise ValueError("a block of token ids does not match its checksum")
        begin += n
    return ids


def index_tokens(blocks: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, read back from its blocks; a document is a row that was written.

    Stretches are summed up by their lengths and checksums alone; starts come from the totals of parts, which are
    as few as the sort's partitions, and of blocks within a part."""

    def run(batches):
        for batch in slices(batches, "payload", 16 << 20):
            lengths = batch.column("tokens").to_numpy()
            raw, begin = checked(batch, lengths).astype("<u4"), 0
            rows = []
            for part, block, first, owners, shares in zip(*(batch.column(c).to_pylist() for c in ("part", "block", "first_doc", "doc_ids", "doc_counts")), strict=True):
                at = 0
                for place, (owner, n) in enumerate(zip(owners, shares, strict=True)):
                    rows.append((part, block, first + place, at, owner, n, zlib.crc32(raw[begin : begin + n])))
                    begin += n
                    at += n
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), *[pa.int64()] * 6), strict=True)], names=["part", "block", "doc", "at", "doc_id", "n", "crc"])
        given_back()

    stretches = blocks.mapInArrow(run, "part int, block long, doc long, at long, doc_id long, n long, crc long")
    totals = blocks.groupBy("part").agg(F.sum("tokens").alias("tokens")).collect()  # one row for each partition of the sort
    before, run_total = {}, 0
    for row in sorted(totals, key=lambda r: r.part):
        before[row.part], run_total = run_total, run_total + row.tokens
    parts = blocks.sparkSession.createDataFrame([(k, v) for k, v in before.items()], "part int, before long")
    # Blocks of a slice have BLOCK tokens but for the last; their starts are a running sum over each part's block rows.
    from pyspark.sql import Window

    begins = blocks.select("part", "block", "tokens").withColumn("begin", F.coalesce(F.sum("tokens").over(Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    placed = stretches.join(begins.drop("tokens"), ["part", "block"]).join(F.broadcast(parts), "part")
    placed = placed.select("part", "doc", "doc_id", (F.col("before") + F.col("begin") + F.col("at")).alias("start"), "n", "crc")

    def joined(batches):
        for batch in batches:
            starts, counts, crcs = [], [], []
            for own in batch.column("stretches").to_pylist():
                own.sort(key=lambda s: s["start"])
                crc = own[0]["crc"]
                for s in own[1:]:
                    crc = crc_combine(crc, s["crc"], 4 * s["n"])
                starts.append(own[0]["start"])
                counts.append(sum(s["n"] for s in own))
                crcs.append(crc)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(starts, pa.int64()), pa.array(counts, pa.int64()), pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return placed.groupBy("part", "doc").agg(F.first("doc_id").alias("doc_id"), F.collect_list(F.struct("start", "n", "crc")).alias("stretches")).select("doc_id", "stretches").mapInArrow(joined, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _times(matrix: list[int], vector: int) -> int:
    out = 0
    for row in matrix:
        if not vector:
            break
        if vector & 1:
            out ^= row
        vector >>= 1
    return out


_zeros: list[list[int]] = []


def crc_combine(first: int, second: int, length: int) -> int:
    """The crc32 of two byte strings, one after the other, from theirs; `length` is the second's. Appending zero bytes is
    linear over GF(2), so its matrices for powers of two suffice."""
    if not _zeros:
        bit = [0xEDB88320] + [1 << n for n in range(31)]
        for _ in range(3):
            bit = [_times(bit, row) for row in bit]
        _zeros.append(bit)
    k = 0
    while length >> k:
        if len(_zeros) <= k:
            _zeros.append([_times(_zeros[-1], row) for row in _zeros[-1]])
        if length >> k & 1:
            first = _times(_zeros[k], first)
        k += 1
    return first ^ second
