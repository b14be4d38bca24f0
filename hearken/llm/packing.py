"""Best-fit packing of token sequences: best-two-fit.

Documents are encoded where they are read; only (document, piece, length) rows move. Pieces are dealt to shards of
bounded size by a hash of their place in the table. A shard fills a bin greedily with the largest piece that still fits, then
looks for the two unpacked pieces that fill the gap best, over all lengths, and swaps them in if they do better than the
bin's smallest piece. A shard keeps counts of pieces by length and a bitmap of the lengths present, so a fit is a bit operation.

A null text is an empty document with its end id alone; documents longer than a sequence are cut, and only they; equal
rows, and rows that share or lack a doc_id, are packed one by one; of pieces of one length the one read first goes first,
and of pairs that fill a gap alike the one with the longest piece; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import WordCodec
from .common import id_and_bytes, map_slices, saved

CAPACITY, END_ID, SHARD_PIECES = 4096, 1, 200_000


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document's ids cut at `capacity`."""

    def work(batch):
        ids, counts = WordCodec.of(path).encode(batch.column("body"), end_id)
        ids = ids.astype("<u4")
        doc, piece, start, length, crc = [], [], [], [], []
        begin = 0
        for d, n in zip(batch.column("doc_id").to_pylist(), counts.tolist(), strict=True):
            for k, at in enumerate(range(0, n, capacity)):
                own = ids[begin + at : begin + min(n, at + capacity)]
                doc.append(d)
                piece.append(k)
                start.append(at)
                length.append(len(own))
                crc.append(zlib.crc32(own))
            begin += n
        return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return map_slices(id_and_bytes(docs), work, "doc_id long, piece int, start long, length long, ids_crc32 long", limit=16 << 20)


def best_two_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The bin of each piece, its offset there, and the number of bins."""
    order = np.argsort(lengths, kind="stable")
    edges = np.searchsorted(lengths[order], np.arange(capacity + 2)).tolist()
    left = [edges[n + 1] - edges[n] for n in range(capacity + 1)]
    present = sum(1 << n for n in range(capacity + 1) if left[n])
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)

    def largest(most: int) -> int:
        return (present & ((2 << most) - 1)).bit_length() - 1 if most > 0 else -1

    number = 0
    while present:
        content, room = [], capacity
        while (n := largest(room)) > 0:
            content.append(n)
            left[n] -= 1
            if not left[n]:
                present ^= 1 << n
            room -= n
        if room and content:
            small = content[-1]
            gap, best = room + small, (small, 0, 0)
            shortest = (present & -present).bit_length() - 1
            low = present & ((2 << gap - shortest) - 1) if 0 < shortest < gap else 0
            while low:  # the first piece of the pair, from the largest that leaves room for another; two that fill the gap end the search
                a = low.bit_length() - 1
                if 2 * a < best[0]:
                    break
                low ^= 1 << a
                b = largest(min(a, gap - a))
                if b == a and left[a] < 2:
                    b = largest(a - 1)
                if b > 0 and a + b > best[0]:
                    best = (a + b, a, b)
                    if a + b == gap:
                        break
            if best[1]:
                content[-1:] = best[1:]
                for n in best[1:]:
                    left[n] -= 1
                    if not left[n]:
                        present ^= 1 << n
                left[small] += 1
                present |= 1 << small
        at = 0
        for n in content:
            which = order[edges[n]]
            edges[n] += 1
            bins[which], offsets[which] = number, at
            at += n
        number += 1
    return bins, offsets, number


def pack(cut: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """`cut` with sequence_id and offset. Shards hold about `shard_pieces` pieces; each can leave one part-filled
    sequence more than a single shard would."""
    stored = saved(cut, "pieces")
    shards = max(1, round(stored.count() / shard_pieces))

    names = cut.columns

    def shard(keys, table):
        bins, offsets, _ = best_two_fit(table.column("length").to_numpy(), capacity)
        return table.select(names).append_column("sequence_id", pa.array(bins + (keys[0].as_py() << 32), pa.int64())).append_column("offset", pa.array(offsets, pa.int64()))

    # By the place in the stored table, which does not change: rows without doc_id, copies and a long text's pieces spread.
    keyed = stored.withColumn("shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)))
    schema = ", ".join(f"{k} {v}" for k, v in cut.dtypes)
    return keyed.groupBy("shard").applyInArrow(shard, f"{schema}, sequence_id bigint, offset bigint")
