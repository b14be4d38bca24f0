"""Shared pieces of the training-data operators: reading documents, batching, word hashing.

Texts travel as binary columns: a null text is an empty one, invalid UTF-8 is never decoded here, and a
batch never grows with the table, only with the longest single text.
"""

from __future__ import annotations

import ctypes
import hashlib
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES, LONG_WORD = 4 << 20, 32
_M = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_TABLE = np.random.Generator(np.random.PCG64(20)).integers(1, 1 << 63, 256, dtype=np.uint64) * _M(2) + _M(1)
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_and_bytes(docs: DataFrame) -> DataFrame:
    """doc_id and the text's bytes; null texts become empty. Other columns are left behind, whatever their names."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("body"))


def slices(batches: Iterator[pa.RecordBatch], column: str = "body", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that one holds about `limit` bytes of `column`, and one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False).astype(np.int64)
        part, begin = np.cumsum(lengths + 16) // limit, 0
        for end in [*(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]:
            if end > begin:
                yield batch.slice(begin, end - begin)
            begin = end


def given_back() -> None:
    """Hands free memory back to the system: Python workers outlive their tasks, and the next may be of another kind."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def map_slices(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, column: str = "body", limit: int = SLICE_BYTES) -> DataFrame:
    """mapInArrow with `work` applied to each bounded slice; a stateless map, so a lost task is simply run again."""

    def run(batches):
        for batch in slices(batches, column, limit):
            if (out := work(batch)) is not None and out.num_rows:
                yield out
        given_back()

    return df.mapInArrow(run, schema)


def shared_folder(spark: SparkSession, what: str) -> str:
    """A new folder below spark.checkpoint.dir, which all executors share. Where it is unset, a session of this machine alone
    gets a temporary one, and a cluster's is refused. What is written there stays until the session's owner removes it: a
    result that is read again later may need it."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: intermediate tables need a folder that all executors share")
        base = "file://" + os.path.join(tempfile.gettempdir(), "hearken-checkpoints")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{what}-{uuid.uuid4().hex}"


def saved(df: DataFrame, what: str, path: str | None = None) -> DataFrame:
    """df written to the shared folder and read again: cuts the lineage, survives lost executors, runs `df` once."""
    path = path or shared_folder(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Removes a folder of `saved` that nothing will read again."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the finaliser of MurmurHash3, fixed constants)."""
    h = h ^ (h >> _M(33))
    h = h * _M(0xFF51AFD7ED558CCD)
    h ^= h >> _M(33)
    h *= _M(0xC4CEB9FE1A85EC53)
    h ^= h >> _M(33)
    return h


_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for k, b in enumerate((_BASE, _BASE_INV)):
            x = np.full(size, b, np.uint64)
            x[0] = 1
            _powers[k] = np.cumprod(x)
    return _powers[0], _powers[1]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, block: int = 1 << 20) -> np.ndarray:
    """64-bit hashes of values[start:end] for sorted, positive spans; equal content, equal hash, wherever it stands."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        low = int(starts[at])
        stop = max(at + 1, int(np.searchsorted(ends, low + block, side="right")))
        s, e = starts[at:stop] - low, ends[at:stop] - low
        n = int(e.max())
        up, down = powers(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(values[low : low + n] * up[:n], out=total[1:])
        out[at:stop] = mixed((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
        at = stop
    return out


class Words:
    """The words of a slice of documents: `text` holds all of them, `starts` and `ends` their bytes, `hashes` their values,
    and document i has the words first[i] to first[i + 1]."""

    def __init__(self, bodies: list[bytes], lower: bool = False):
        joined = np.frombuffer(b" ".join([*bodies, b""]), np.uint8)
        if lower:
            joined = LOWER[joined]
        inside = ~SEPARATOR[joined]
        edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
        self.text, self.starts, self.ends = joined, edge[::2], edge[1::2]
        self.begin = np.concatenate(([0], np.cumsum(np.fromiter((len(b) + 1 for b in bodies), np.int64, len(bodies)))))
        self.first = np.searchsorted(self.starts, self.begin)
        self.hashes = span_hashes(_TABLE[joined], self.starts, self.ends)
        # Sums modulo 2**64 can be made to agree for long words, whatever the base (Thue-Morse), so these get another hash.
        for i in np.flatnonzero(self.ends - self.starts > LONG_WORD).tolist():
            word = joined[self.starts[i] : self.ends[i]].tobytes()
            self.hashes[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")


def window_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k consecutive words; fewer words than k have none."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    at = np.arange(n)
    return span_hashes(hashes, at, at + k)


def ragged(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For groups of the given sizes: each member's group, and its number within the group."""
    group = np.repeat(np.arange(len(counts)), counts)
    return group, np.arange(len(group)) - np.repeat(np.cumsum(counts) - counts, counts)
