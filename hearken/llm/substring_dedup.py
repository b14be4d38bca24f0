"""Substring dedup: passages of `window` words that begin in an earlier document are removed.

Windows of a document are grouped into stretches that share their minimizer (the least hash of GRAM consecutive words
within a window), so equal windows always meet under one minimizer, and documents need not be streamed against all
shards. Minimizers of one document alone end there. Equal stretches of several documents are one sequence with the
smallest of their documents for its owner. Sequences go to the shard of their minimizer: a compressed FM-index over
their words, against which they are streamed; backward search over wavelet matrices gives their matching statistics
against smaller documents, and intervals of `window` words or more are reported. A minimizer with over HOT sequences is
dealt to several sub-shards, which meet in pairs, so that no index grows with a common passage.

Nulls and empty texts have no words; texts under `window` words keep all; rows are told apart by doc_id and text, so rows
that repeat both get one answer, and texts that share a doc_id are cut each by itself and never for one another; rows
without doc_id have no place in the order: they keep all words and cut nothing. Windows repeated within one document alone
stay; texts are taken whole; other columns are ignored; an empty table gives an empty result. Words are compared by 64-bit
hashes: a false match needs two of a corpus' different words to collide inside otherwise equal windows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Words, given_back, id_and_bytes, map_slices, mixed, ragged, saved, span_hashes, window_hashes
from .fm_index import FMIndex

WINDOW, GRAM, HOT, SHARD_WORDS = 50, 16, 8192, 400_000
PART_ROWS = 4096
ROW = ["doc_id", "text_key"]  # tell a row


def least_places(values: np.ndarray, width: int) -> np.ndarray:
    """Of each `width` consecutive values, the place of the least; of equals, the leftmost."""
    best, place, have = values, np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        take = best[step:] < best[:-step]
        best, place = np.where(take, best[step:], best[:-step]), np.where(take, place[step:], place[:-step])
        have += step
    return place


def stretches(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, text_key, minimizer, content, start, windows: each run of windows that share a minimizer."""

    def work(batch):
        bodies = batch.column("body").to_pylist()
        words = Words(bodies)
        n = len(words.hashes) - window + 1
        if n <= 0:
            return None
        grams = window_hashes(words.hashes, gram)
        place = least_places(grams, window - gram + 1)
        doc = np.repeat(np.arange(len(bodies)), np.diff(words.first))
        good = doc[:n] == doc[window - 1 :]
        new = np.ones(n, bool)
        new[1:] = (place[1:] != place[:-1]) | ~good[:-1] | (doc[1:n] != doc[: n - 1])
        starts = np.flatnonzero(new & good)
        cuts = np.flatnonzero(new | ~good)
        ends = np.append(cuts, n)[np.searchsorted(cuts, starts, side="right")]
        content = span_hashes(words.hashes, starts, ends - 1 + window)
        content = mixed(content + (place[starts] - starts).astype(np.uint64))
        own = doc[starts]
        return pa.RecordBatch.from_pydict({**{c: batch.column(c).take(pa.array(own)) for c in ROW}, "minimizer": pa.array(grams[place[starts]].view(np.int64)), "content": pa.array(content.view(np.int64)), "start": pa.array((starts - words.first[own]).astype(np.int32)), "windows": pa.array((ends - starts).astype(np.int16))})

    return map_slices(docs, work, "doc_id long, text_key long, minimizer long, content long, start int, windows short", limit=2 << 20)


def _spread(found: DataFrame) -> DataFrame:
    """minimizer, least and most (doc_id), rows: one for each minimizer that a task reads, in bounded batches, so that a
    common one leaves a task once."""

    def run(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size > 1 << 20:
                yield from total(held)
                held, size = [], 0
        if held:
            yield from total(held)

    def total(held):
        grouped = pa.Table.from_batches(held).group_by(["minimizer"]).aggregate([("doc_id", "min"), ("doc_id", "max"), ("doc_id", "count")])
        return grouped.rename_columns({"doc_id_min": "least", "doc_id_max": "most", "doc_id_count": "rows"}).select(["minimizer", "least", "most", "rows"]).to_batches()

    return found.select("minimizer", "doc_id").mapInArrow(run, "minimizer long, least long, most long, rows long")


def _sequences(wanted: DataFrame, docs: DataFrame, window: int) -> DataFrame:
    """The words of the stretches `wanted`."""
    by_row = wanted.groupBy(*ROW).agg(F.collect_list(F.struct("minimizer", "content", "start", "windows", "ask", "blocks")).alias("own"))

    def work(batch):
        words = Words(batch.column("body").to_pylist())
        lists = batch.column("own")
        group, _ = ragged(np.diff(lists.offsets.to_numpy()))
        rows = lists.flatten()
        start = words.first[group] + rows.field("start").to_numpy()
        windows = rows.field("windows").to_numpy().astype(np.int64)
        parts, offset = ragged(windows - 1 + window)
        raw = words.hashes[start[parts] + offset].astype("<u8").tobytes()
        cuts = np.concatenate(([0], np.cumsum((windows - 1 + window) * 8)))
        body = [raw[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        return pa.RecordBatch.from_pydict({**{c: batch.column(c).take(pa.array(group)) for c in ROW}, **{k: rows.field(k) for k in ("minimizer", "content", "start", "ask", "blocks")}, "words": pa.array(body, pa.binary())})

    schema = "doc_id long, text_key long, minimizer long, content long, start int, ask boolean, blocks int, words binary"
    return map_slices(docs.join(by_row, ROW), work, schema, limit=2 << 20)


def _searched(sequences: DataFrame, window: int, shard_words: int) -> DataFrame:
    """doc_id, text_key, start, stop: the intervals of asked sequences that are found in smaller documents of their shard."""

    def shard(rows: list):
        docs = np.array([r[0] for r in rows])
        words = [np.frombuffer(r[2], "<u8") for r in rows]
        names, owners = np.unique(docs, return_inverse=True)
        index = FMIndex(words, owners, window)
        ask = [i for i, r in enumerate(rows) if r[1]]
        if not ask:
            return _intervals([])
        sizes = np.array([len(words[i]) for i in ask])
        found = index.matches(index.codes(np.concatenate([words[i] for i in ask])), sizes, owners[ask], window)
        edge = np.diff(np.concatenate(([False], found, [False])).view(np.int8))
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)  # a sequence's last place is never found, so runs end in it
        begin = np.cumsum(sizes) - sizes
        own = np.searchsorted(begin, first, side="right") - 1
        out = []
        for i, low, high in zip(own.tolist(), (first - begin[own]).tolist(), (last - 1 - begin[own] + window).tolist(), strict=True):
            doc, places = rows[ask[i]][0], rows[ask[i]][3]
            out += [(doc, key, start + low, start + high) for key, start in places]
        return _intervals(out)

    def run(batches):
        held, size, last, seen = [], 0, None, {}
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*ROW, "minimizer", "low", "high", "ask", "words", "content", "start")]
            for doc, key, minimizer, low, high, ask, words, content, start in zip(*columns, strict=True):
                if (minimizer, low, high) != last:
                    if size > shard_words:
                        yield shard(held)
                        held, size = [], 0
                    last, seen = (minimizer, low, high), {}
                if content not in seen:
                    seen[content] = []
                    held.append((doc, ask, words, seen[content]))
                    size += len(words) // 8
                seen[content].append((key, start))  # its owner may repeat it
        if held:
            yield shard(held)
        given_back()

    home = F.pmod(F.xxhash64("content"), F.col("blocks")).cast("int")
    others = F.when(F.col("blocks") > 1, F.array_remove(F.sequence(F.lit(0), F.col("blocks") - 1), F.col("home"))).otherwise(F.array(F.lit(0)))
    paired = sequences.withColumn("home", home).withColumn("other", F.explode(others))
    paired = paired.select(*ROW, "minimizer", F.least("home", "other").alias("low"), F.greatest("home", "other").alias("high"), "ask", "words", "content", "start")
    dealt = paired.repartition("minimizer", "low", "high").sortWithinPartitions("minimizer", "low", "high")
    return dealt.mapInArrow(run, "doc_id long, text_key long, start int, stop int")


def _intervals(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else ([], [], [], [])
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)], names=[*ROW, "start", "stop"])


def repeats(scanned: DataFrame, docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT, shard_words: int = SHARD_WORDS) -> DataFrame:
    """doc_id, text_key, start, stop: word intervals made of windows that begin in a document with a smaller doc_id as well.
    `scanned` has doc_id, text_key and body as they are read; `docs` has the same rows dealt by doc_id and text_key."""
    found = saved(stretches(scanned.where("doc_id IS NOT NULL"), window, gram), "stretches")
    several = _spread(found).groupBy("minimizer").agg(F.min("least").alias("least"), F.max("most").alias("most"), F.sum("rows").alias("rows")).where("least <> most")
    # Stretches of a common minimizer are joined in as many parts as they need.
    parts = F.ceil(F.col("rows") / PART_ROWS).cast("int").alias("parts")
    met = saved(found.join(saved(several.select("minimizer", parts), "minimizers"), "minimizer"), "repeated")
    heads = met.groupBy("minimizer", "content").agg(F.min("doc_id").alias("owner"), F.first("parts").alias("parts"))
    shards = saved(heads.groupBy("minimizer").agg(F.min("owner").alias("first"), F.ceil(F.count("*") / hot).cast("int").alias("blocks"), F.count("*").alias("heads")), "shards")
    known = saved(heads.join(shards, "minimizer"), "heads")
    every = known.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    owned = met.withColumn("part", F.pmod(F.xxhash64("doc_id", "start"), F.col("parts")).cast("int")).join(every, ["minimizer", "content", "part"])
    # Copies of a sequence begin in its owner. What a sequence shares with others is searched for once, for its owner.
    copied = owned.where("doc_id > owner").select(*ROW, "start", (F.col("start") + F.col("windows") + (window - 1)).cast("int").alias("stop"))
    asked = owned.where("heads > 1 AND doc_id = owner").withColumn("ask", F.col("owner") > F.col("first"))
    return copied.unionByName(_searched(_sequences(asked, docs, window), window, shard_words))


def cleaned(docs: DataFrame, texts: bool = True, rest: bool = False, **options) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row; if `texts`, kept (the kept words' bytes, joined by a space);
    if `rest`, a struct of the other columns. Texts are dealt by doc_id once for both joins with them."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    base = id_and_bytes(docs)
    if rest:
        packed = F.struct(*(F.col(f"`{c}`") for c in others)) if others else F.struct(F.lit(0).alias("none"))
        base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("body"), packed.alias("rest"))
    scanned, base = (df.withColumn("text_key", F.xxhash64("body")) for df in (id_and_bytes(docs), base))
    base = base.repartition(*ROW)
    found = repeats(scanned, base, **options).groupBy(*ROW).agg(F.collect_list(F.struct("start", "stop")).alias("cut"))

    def work(batch):
        totals, removed, kept = [], [], []
        for body, cut in zip(batch.column("body").to_pylist(), batch.column("cut").to_pylist(), strict=True):
            words = body.split()
            keep = np.ones(len(words), bool)
            for span in cut or ():
                keep[span["start"] : span["stop"]] = False
            totals.append(len(words))
            removed.append(int(len(words) - keep.sum()))
            kept.append(b" ".join([w for w, k in zip(words, keep.tolist(), strict=True) if k] if cut else words))
        out = {"doc_id": batch.column("doc_id"), "n_words": pa.array(totals, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in kept])}
        if texts:
            out["kept"] = pa.array(kept, pa.binary())
        if rest:
            out |= {"body": batch.column("body"), "rest": batch.column("rest")}
        return pa.RecordBatch.from_pydict(out)

    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType())])
    if texts:
        schema = schema.add("kept", T.BinaryType())
    if rest:
        schema = schema.add("body", T.BinaryType()).add("rest", base.schema["rest"].dataType)
    return map_slices(base.join(found, ROW, "left"), work, schema)


def without_repeats(docs: DataFrame, **options) -> DataFrame:
    """`docs`, its columns as they are, with shortened texts where a passage went; other texts keep their white space, and
    null ones stay null. n_chars, if there, follows."""
    null = "".join(docs.columns) + "_null"
    own = cleaned(docs.withColumn(null, F.col("text").isNull()), rest=True, **options)
    text = F.when(F.col(f"rest.`{null}`"), F.lit(None).cast("string")).when(F.col("n_removed") > 0, F.col("kept").cast("string")).otherwise(F.col("body").cast("string"))
    column = {c: F.col(f"rest.`{c}`") for c in docs.columns if c not in ("doc_id", "text")} | {"doc_id": F.col("doc_id"), "text": text}
    if "n_chars" in column:
        column["n_chars"] = F.when(F.col("n_removed") > 0, F.length(text).cast(docs.schema["n_chars"].dataType)).otherwise(column["n_chars"])
    return own.select(*(column[c].alias(c) for c in docs.columns))
