"""N-gram Jaccard join: adaptive multi-match prefixes.

A document is its set of distinct word shingles; a node is a set's hash, so exact copies are one node. Prefixes are
made of cells, groups of shingles by their hashes' high bits: they reach over most of a set, and one shared cell means
several shared shingles, so that common lines and passages do not make candidates. Nodes that share a cell of their
prefixes fall into a family; families are the components of stars, one for each cell, and a cell's star is begun where
its sets are read, so that a common cell leaves a task once. Cells with shingles that few texts have come first in a prefix:
what stands in many texts, told by a sample, would chain ever more of a growing corpus into one family. A family is joined in a task of its own, or in pairs of
blocks of BLOCK nodes or BLOCK_SHINGLES shingles if it is large: within it every set lengthens its prefix by the estimated
cost of its candidates, a pair needs correspondingly more shared prefix shingles, pairs already connected are passed over,
and what is left is verified by the exact sizes of intersection and union. A task returns a spanning forest, not all pairs.

Nulls, empty texts and texts without words have an empty set and link with nothing; texts under five words are one
shingle; equal sets always link. Rows are told apart by doc_id and text: rows that repeat both get one answer, texts that
share a doc_id are grouped each by itself, and rows without doc_id link as others do but never name a group that has
another. Whole texts count; other columns are ignored; an empty table gives an empty result. Shingles and sets are told
apart by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Words, given_back, id_and_bytes, map_slices, mixed, saved, slices, span_hashes
from .graph import components

SHINGLE, NEED, OF = 5, 80, 100
BLOCK, BLOCK_SHINGLES, LENGTHS = 4096, 2_000_000, 4
HELD_TOKENS = 2_000_000  # of prefixes, looked through together where they are read
#: Common shingles are told by about so many texts, and are so many at the utmost. They order cells and decide no result.
SAMPLE_TEXTS, COMMON = 16_384, 1 << 18


def shingle_sets(bodies: list[bytes], k: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = Words(bodies, lower=True)
    n = len(words.hashes)
    at = np.arange(n)
    last = np.repeat(words.first[1:], np.diff(words.first))
    begin = np.repeat(words.first[:-1], np.diff(words.first))
    good = (at + k <= last) | (at == begin)
    hashes = span_hashes(words.hashes, at[good], np.minimum(at[good] + k, last[good]))
    edge = np.searchsorted(at[good], words.first)
    out = []
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        own = np.sort(hashes[a:b])
        keep = np.ones(len(own), bool)
        keep[1:] = own[1:] != own[:-1]
        out.append(own[keep])
    return out


def node_of(own: np.ndarray) -> int:
    return int(mixed(mixed(own ^ np.uint64(0x5DEECE66D)).sum(keepdims=True) + np.uint64(len(own))).view(np.int64)[0])


def needed(n: int, need: int, of: int) -> int:
    """The least overlap of a set of n with a set that it links to."""
    return -(-n * need // of)


def text_key(body):
    """A 64-bit hash of a text's bytes: with its doc_id, which may be null or stand on other texts too, it tells a row."""
    return F.xxhash64(body)


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, n, node of every row."""

    def work(batch):
        sets = shingle_sets(batch.column("body").to_pylist())
        return pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "text_key": batch.column("text_key"), "n": pa.array([len(s) for s in sets], pa.int64()), "node": pa.array([node_of(s) for s in sets], pa.int64())})

    return map_slices(docs.withColumn("text_key", text_key("body")), work, "doc_id long, text_key long, n long, node long", limit=2 << 20)


def level(n: int) -> int:
    """Sets of n shingles have 2**level cells, of 1.5 to 3 shingles on average."""
    return max(0, int(n / 1.5).bit_length() - 1)


def common_shingles(docs: DataFrame, signed: DataFrame, texts: int = SAMPLE_TEXTS, most: int = COMMON) -> np.ndarray:
    """Sorted hashes of the `most` most frequent shingles that two different texts have, of about `texts` texts chosen by
    their hashes; of a smaller table, of all."""
    number = signed.agg(F.approx_count_distinct("text_key")).first()[0]
    chosen = docs.select("body").where(F.pmod(F.xxhash64("body", F.lit("sample")), F.lit(max(1, number // texts))) == 0).distinct()

    def work(batch):
        sets = shingle_sets(batch.column("body").to_pylist())
        return pa.RecordBatch.from_pydict({"shingle": pa.array(np.concatenate(sets).view(np.int64), pa.int64())})

    counted = map_slices(chosen, work, "shingle long", limit=2 << 20).groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1")
    found = counted.orderBy(F.desc("n"), "shingle").limit(most).select("shingle").toArrow()
    return np.sort(found.column("shingle").to_numpy().view(np.uint64))


def is_rare(own: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Which shingles of a sorted set are not among `common`, sorted too."""
    if not len(common):
        return np.ones(len(own), bool)
    return common[np.minimum(np.searchsorted(common, own), len(common) - 1)] != own


def cells(own: np.ndarray, k: int, most: int, rare: np.ndarray | None = None) -> np.ndarray:
    """Hashes of the `most` first cells of a sorted set, cut by the shingles' k highest bits: cells of the most `rare`
    shingles come first, of equals the fullest, of these those of least hash, and empty ones last. The order depends on a
    cell's content alone, since a shingle is rare or not wherever it stands."""
    which = (own >> np.uint64(64 - k)).astype(np.int64) if k else np.zeros(len(own), np.int64)
    starts = np.flatnonzero(np.diff(which, prepend=-1))
    size = np.diff(np.append(starts, len(own)))
    salt = np.uint64((k + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    hashes = mixed(np.add.reduceat(mixed(own), starts) + which[starts].astype(np.uint64) + salt)
    if most > len(starts):
        empty = np.setdiff1d(np.arange(1 << k), which[starts])
        lacking = np.sort(mixed(empty.astype(np.uint64) + salt))[: most - len(starts)]
        return np.concatenate((hashes, lacking))
    if most < len(starts):
        few = size if rare is None else np.add.reduceat(rare.astype(np.int64), starts)
        rank = np.minimum(few, 63).astype(np.uint64) << np.uint64(58) | np.minimum(size, 63).astype(np.uint64) << np.uint64(52) | (~hashes >> np.uint64(12))
        hashes = hashes[np.argpartition(rank, len(rank) - most)[len(rank) - most :]]
    return hashes


def stars(docs: DataFrame, need: int = NEED, of: int = OF, common: np.ndarray | None = None) -> DataFrame:
    """node, first: a star for each cell, from the nodes that have it in their prefix to the least of them. Sets x and y
    that link differ in d = (|x| + |y|) (of - need) / (of + need) shingles at the utmost, so in at most d cells; the first
    cell that they share is among the first d + 1 of either. The cells are those of the larger set's level, so a set that
    a set of the next level can link to has a prefix at that level too. Shingles of `common` are not rare."""
    common = np.empty(0, np.uint64) if common is None else common

    def prefix(own):
        n, rare = len(own), is_rare(own, common)
        largest = n * of // need
        most = (n + largest) * (of - need) // (of + need) + 1
        return np.concatenate([cells(own, k, most, rare) for k in range(level(n), level(largest) + 1)])

    def begun(tokens, nodes):
        """A task's part of the stars: edges to the least node here, and that node's cells, to be joined with other tasks'."""
        token, node = np.concatenate(tokens).view(np.int64), np.repeat(np.array(nodes, np.int64), [len(t) for t in tokens])
        order = np.lexsort((node, token))
        token, node = token[order], node[order]
        new = np.append(True, token[1:] != token[:-1])
        first = node[np.flatnonzero(new)[np.cumsum(new) - 1]]
        edges = np.unique(np.stack((node, first), axis=1)[node != first], axis=0)
        edge = np.repeat([False, True], [int(new.sum()), len(edges)])
        key = np.concatenate((token[new], edges[:, 0]))
        return pa.RecordBatch.from_pydict({"edge": pa.array(edge), "key": pa.array(key), "node": pa.array(np.concatenate((node[new], edges[:, 0]))), "first": pa.array(np.concatenate((node[new], edges[:, 1])))})

    def run(batches):
        tokens, nodes, size = [], [], 0
        for batch in slices(batches, limit=2 << 20):
            for own in shingle_sets(batch.column("body").to_pylist()):
                if len(own):
                    tokens.append(prefix(own))
                    nodes.append(node_of(own))
                    size += len(tokens[-1])
            if size > HELD_TOKENS:
                yield begun(tokens, nodes)
                tokens, nodes, size = [], [], 0
        if tokens:
            yield begun(tokens, nodes)
        given_back()

    rows = docs.mapInArrow(run, "edge boolean, key long, node long, first long")
    least = F.when(F.col("edge"), F.col("first")).otherwise(F.min("node").over(Window.partitionBy("edge", "key")))
    return rows.withColumn("first", least).where("node != first").select("node", "first")


def family_links(nodes: list[int], sets: list[np.ndarray], sides: list[int], need: int = NEED, of: int = OF) -> list[tuple[int, int]]:
    """A spanning forest of the links between sets of a family. If `sides` has two values, pairs of one side are left to
    other tasks (those of equal sides, one value, are all joined)."""
    g = len(sets)
    split = len(set(sides)) > 1
    size = np.fromiter(map(len, sets), np.int64, g)
    order = np.argsort(size, kind="stable")
    sets, nodes, side, size = [sets[i] for i in order], [nodes[i] for i in order], np.array(sides)[order], size[order]
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    frequency = np.bincount(flat)
    cuts = np.concatenate(([0], np.cumsum(size)))
    rows, lengths, first = [], np.empty(g, np.int64), []
    for i in range(g):
        own = flat[cuts[i] : cuts[i + 1]]
        own = own[np.argsort(frequency[own], kind="stable")]
        rows.append(own)
        base = len(own) - needed(len(own), need, of) + 1
        cost = np.cumsum(frequency[own[: base + LENGTHS]])
        # A match more costs a longer scan and saves verifications: pairs with l matches are taken to be fewer by l squared.
        options = [(cost[base + l - 2] * (1 + 8 / l**2), l) for l in range(1, LENGTHS + 1) if base + l - 1 <= len(own)]
        lengths[i] = min(options)[1]
        first.append(own[: base + lengths[i] - 1])
    index = _lists(first, len(frequency))
    whole = None
    group, out = list(range(g)), []

    def root(i):
        while group[i] != i:
            group[i] = group[group[i]]
            i = group[i]
        return i

    for i in range(g):
        at, found = _matches(index, first[i])
        able = (at < i) & (found >= np.minimum(lengths[at], lengths[i])) & (size[at] * of >= size[i] * need)
        if split:
            able &= side[at] != side[i]
        here = root(i)
        candidates = np.array([j for j in at[able].tolist() if root(j) != here], np.int64)
        if not len(candidates):
            continue
        if len(candidates) > 24:
            if whole is None:
                whole = _lists(rows, len(frequency))
            at, found = _matches(whole, rows[i])
            common = found[np.searchsorted(at, candidates)]
        else:
            common = np.array([len(np.intersect1d(rows[i], rows[j], assume_unique=True)) for j in candidates])
        for j in candidates[of * common >= need * (size[candidates] + size[i] - common)].tolist():
            a, b = root(j), root(i)
            if a != b:
                out.append((nodes[i], nodes[j]))
                group[a] = b
    return out


def _first_row():
    """The row of least doc_id, one without doc_id only if there is no other."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_key"))


def _lists(rows: list[np.ndarray], tokens: int):
    flat, owner = np.concatenate(rows), np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    order = np.argsort(flat, kind="stable")
    return owner[order], np.concatenate(([0], np.cumsum(np.bincount(flat, minlength=tokens))))


def _matches(index, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows that share some of `tokens`, in ascending order, and how many."""
    owner, cuts = index
    return np.unique(np.concatenate([owner[cuts[t] : cuts[t + 1]] for t in tokens.tolist()]), return_counts=True)


def links(docs: DataFrame, signed: DataFrame, need: int = NEED, of: int = OF, block: int = BLOCK, shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """src, dst: a spanning forest of each family's links between different sets."""
    members = components(stars(docs, need, of, common_shingles(docs, signed)).select(F.col("node").alias("src"), F.col("first").alias("dst")))
    families = members.unionByName(members.select(F.col("root").alias("node"), "root").distinct())
    one = signed.groupBy("node").agg(_first_row().alias("row"), F.first("n").alias("n"))
    homes = families.join(one, "node")
    parts = F.greatest(F.ceil(F.count("*") / block), F.ceil(F.sum("n") / shingles)).cast("int")
    sizes = homes.groupBy("root").agg(parts.alias("blocks"))
    homes = homes.join(sizes, "root").withColumn("home", F.pmod(F.xxhash64("node", F.lit("home")), F.col("blocks")).cast("int"))
    # Blocks meet in pairs: a node of block h goes to the tasks (h, other) for all others, and alone to (h, h).
    homes = homes.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    homes = homes.select("row", "node", "root", "home", F.least("home", "other").alias("low"), F.greatest("home", "other").alias("high"))
    wanted = homes.groupBy(F.col("row.doc_id").alias("own_id"), F.col("row.text_key").alias("own_key")).agg(F.collect_list(F.struct("node", "root", "home", "low", "high")).alias("tasks"))

    def expand(batch):
        sets = shingle_sets(batch.column("body").to_pylist())
        rows = {}
        for own, tasks in zip(sets, batch.column("tasks").to_pylist(), strict=True):
            raw, node = own.astype("<u8").tobytes(), node_of(own)
            rows |= {(t["root"], t["low"], t["high"], t["home"], node): raw for t in tasks if t["node"] == node}
        rows = [(*k, raw) for k, raw in rows.items()]
        if not rows:
            return None
        types = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["root", "low", "high", "home", "node", "own"])

    def joined(batches):
        held, last = [], None

        def family():
            found = family_links([r[4] for r in held], [np.frombuffer(r[5], "<u8") for r in held], [r[3] for r in held], need, of)
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], names=["src", "dst"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("root", "low", "high", "home", "node", "own")), strict=True):
                if row[:3] != last:
                    if len(held) > 1:
                        yield family()
                    held, last = [], row[:3]
                if not held or held[-1][4] != row[4]:  # rows may repeat doc_id and text
                    held.append(row)
        if len(held) > 1:
            yield family()
        given_back()

    keyed = docs.withColumn("own_text", text_key("body"))
    found = keyed.join(wanted, F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("own_text") == F.col("own_key"))).select("body", "tasks")
    placed = map_slices(found, expand, "root long, low int, high int, home int, node long, own binary", limit=2 << 20)
    return placed.repartition("root", "low", "high").sortWithinPartitions("root", "low", "high", "node").mapInArrow(joined, "src long, dst long")


def _rooted(docs: DataFrame, need: int, of: int, block: int) -> tuple[DataFrame, DataFrame]:
    """doc_id, text_key, n_shingles of every row: those with shingles, and the root of their group; and those without."""
    base = id_and_bytes(docs)
    signed = saved(signatures(base), "signatures")
    roots = components(links(base, signed, need, of, block))
    own = signed.withColumnRenamed("n", "n_shingles")
    full = own.where("n_shingles > 0").join(roots, "node", "left").select("doc_id", "text_key", "n_shingles", F.coalesce("root", "node").alias("root"))
    return full, own.where("n_shingles = 0").select("doc_id", "text_key", "n_shingles")


def grouped(docs: DataFrame, need: int = NEED, of: int = OF, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id of every row: the least doc_id that links lead to, its own included."""
    full, empty = _rooted(docs, need, of, block)
    least = full.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    alone = empty.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return full.join(least, "root").select("doc_id", "n_shingles", "component_id").unionByName(alone)


def representatives(docs: DataFrame, need: int = NEED, of: int = OF, block: int = BLOCK) -> DataFrame:
    """doc_id, text_key of one row of each group, that of the least doc_id, and of all rows without shingles."""
    full, empty = _rooted(docs, need, of, block)
    return full.groupBy("root").agg(_first_row().alias("row")).select("row.doc_id", "row.text_key").unionByName(empty.select("doc_id", "text_key"))
