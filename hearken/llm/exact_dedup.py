"""Exact duplicates: Patricia-trie owners.

Texts are dealt out by length and content hash. Each task inserts whole byte strings into a compressed radix
trie; the terminal node of a text holds the id to keep and the number of its rows. Tasks first do this for
the rows they scan, so a text that a third of all rows repeat leaves each task once, and again for what meets
after the shuffle. A trie over its memory bound writes its largest subtree, found below the prefix that all its texts
share, to a scratch file and takes it up again at the end, when the other subtrees are done; what it holds there is less
that prefix, so it can spill in turn. Scratch files are the task's own, on its machine's disk, and vanish with it: a lost
task starts afresh from its input, and nothing else reads them.

Nulls count as empty; empty texts are equal to each other; an empty table gives an empty result; other columns
are ignored whatever their names; texts are compared byte by byte, whole.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_bytes

TRIE_BYTES, NODE = 96 << 20, 300


class Node:
    """`edge` is what leads here from the parent; a terminal has [keep, rows]."""

    __slots__ = ("edge", "children", "terminal")

    def __init__(self, edge: bytes, terminal: list | None = None):
        self.edge, self.children, self.terminal = edge, {}, terminal


def shared_length(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving: compares slices, not single bytes."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


class Trie:
    """A radix trie below `prefix`, which all its texts begin with. The spilled subtrees are known by the bytes that lead
    to them from the root; a subtree is the child of the first node that has several, or holds a text."""

    def __init__(self, keep=min, limit: int = TRIE_BYTES, prefix: bytes = b""):
        self.root, self.keep, self.limit, self.prefix = Node(b""), keep, limit, prefix
        self.size = 0
        self.spilled: dict[bytes, object] = {}
        self.heads: list[int] = []  # the lengths of their keys

    def insert(self, text: bytes, owner: int, rows: int = 1) -> None:
        for n in self.heads:
            if (file := self.spilled.get(text[:n])) is not None:
                pickle.dump((text[n:], owner, rows), file, -1)
                return
        node, rest = self.root, text
        while rest:
            child = node.children.get(rest[0])
            if child is None:
                node.children[rest[0]] = Node(rest, [owner, rows])
                self._grown(len(rest))
                return
            n = shared_length(child.edge, rest)
            if n < len(child.edge):
                middle = Node(child.edge[:n])
                child.edge = child.edge[n:]
                middle.children[child.edge[0]] = child
                node.children[rest[0]] = middle
                child = middle
                self.size += NODE
            node, rest = child, rest[n:]
        if node.terminal is None:
            node.terminal = [owner, rows]
        else:
            node.terminal = [self.keep(node.terminal[0], owner), node.terminal[1] + rows]

    def _grown(self, n: int) -> None:
        self.size += n + NODE
        while self.size > self.limit:
            node, path = self.root, b""
            while len(node.children) == 1 and node.terminal is None:  # the prefix of all texts held
                (node,) = node.children.values()
                path += node.edge
            if not node.children:  # one text alone
                return
            for held, first in sorted(((_held(child), first) for first, child in node.children.items()), reverse=True):
                self._spill(path + bytes([first]), node.children.pop(first))
                self.size -= held
                if self.size <= self.limit // 2:
                    break

    def _spill(self, head: bytes, child: Node) -> None:
        file = self.spilled[head] = tempfile.TemporaryFile()
        self.heads = sorted({*map(len, self.spilled)}, reverse=True)
        for text, (owner, rows) in _terminals(child):
            pickle.dump((text[1:], owner, rows), file, -1)

    def owners(self) -> Iterator[tuple[bytes, int, int]]:
        """(text, id to keep, rows) of each distinct text."""
        for text, (owner, rows) in _terminals(self.root):
            yield self.prefix + text, owner, rows
        self.root = Node(b"")
        for head in list(self.spilled):
            with self.spilled.pop(head) as file:
                file.seek(0)
                below = Trie(self.keep, self.limit, self.prefix + head)
                try:
                    while True:
                        below.insert(*pickle.load(file))
                except EOFError:
                    pass
            yield from below.owners()


def _held(node: Node) -> int:
    """The bytes that a subtree is taken to need."""
    total, stack = 0, [node]
    while stack:
        node = stack.pop()
        total += len(node.edge) + NODE
        stack += node.children.values()
    return total


def _terminals(node: Node) -> Iterator[tuple[bytes, list]]:
    stack = [(node, node.edge)]
    while stack:
        node, path = stack.pop()
        if node.terminal is not None:
            yield path, node.terminal
        stack += [(child, path + child.edge) for child in node.children.values()]


def _owners(keep: str, final: bool, limit: int):
    chosen = min if keep == "smallest" else max

    def run(batches):
        trie = Trie(chosen, limit)
        for batch in batches:
            n = batch.num_rows
            rows = batch.column("rows").to_pylist() if final else [1] * n
            for text, owner, count in zip(batch.column("body").to_pylist(), batch.column("keep_id").to_pylist(), rows, strict=True):
                trie.insert(text, owner, count)
        out, size = [], 0
        for text, owner, count in trie.owners():
            out.append((text, owner, count))
            size += 0 if final else len(text)
            if len(out) >= 4096 or size > 4 << 20:
                yield _batch(out, final)
                out, size = [], 0
        if out:
            yield _batch(out, final)

    return run


def _batch(out: list, final: bool) -> pa.RecordBatch:
    texts, owners, rows = zip(*out, strict=True)
    columns = {"keep_id": pa.array(owners, pa.int64()), "rows": pa.array(rows, pa.int64())}
    if final:
        columns["text_sha256"] = pa.array([hashlib.sha256(t).hexdigest() for t in texts])
    else:
        columns["body"] = pa.array(texts, pa.binary())
    return pa.RecordBatch.from_pydict(columns)


def exact_groups(docs: DataFrame, keep: str = "smallest", trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of `docs`; of equal texts the row with the
    "smallest" or "largest" doc_id stays. Equal rows with one doc_id all get the same answer. Rows whose doc_id
    is null take part in their group's size but never own it unless all its ids are null. Rows without doc_id in a group without ids are all kept by the flag; a caller that wants one of them
    picks it by doc_id and text_sha256."""
    base = id_and_bytes(docs)
    floor = F.lit((1 << 63) - 1 if keep == "smallest" else -(1 << 63))
    scanned = base.select(F.coalesce("doc_id", floor).alias("keep_id"), "body").mapInArrow(_owners(keep, False, trie_bytes), "keep_id long, rows long, body binary")
    dealt = scanned.repartition(F.length("body"), F.xxhash64("body"))
    owners = dealt.mapInArrow(_owners(keep, True, trie_bytes), "keep_id long, rows long, text_sha256 string")
    named = base.select("doc_id", F.sha2("body", 256).alias("text_sha256"))
    joined = named.join(owners.withColumn("keep_id", F.when(F.col("keep_id") != floor, F.col("keep_id"))), "text_sha256")
    return joined.select("doc_id", "keep_id", F.col("rows").alias("group_size"), F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
