"""Language ID: scripts narrow the candidates, then Viterbi over per-word scores with a switching penalty.

Each word has a score in each learned language, the sum of log shares of its byte trigrams, and a script, from the lead
bytes of its characters; languages that never showed a script in training are no candidates for its words. Viterbi
finds the best sequence of languages, paying a penalty for each switch; its runs are the spans of mixed-language text,
and the language with most bytes is the document's.

Fitted on at most about SAMPLE labelled rows chosen by a hash of doc_id; what is learned are two tables of fixed size.
Null texts and texts without letters are `und` with score 0; ties go to the language first in the alphabet; a table
without labelled rows makes every document `und`; long texts are labelled whole; each row is answered by itself, so rows
that repeat, or share or lack a doc_id, do no harm, and an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, SEPARATOR, id_and_bytes, map_slices

SAMPLE, PENALTY, BUCKETS = 20_000, 12.0, 1 << 16
STRETCH, MATRICES = 8192, 1 << 18  # words of a long text passed at once; entries of the matrices made side by side
#: Scripts by lead byte: ASCII 0, extended Latin 1, Greek 2, Cyrillic 3, Hebrew and Arabic 4, South and Southeast Asian 5,
#: kana 6, Han 7, Hangul 8, others 9; continuation bytes 0. Fixed values.
SCRIPT = np.zeros(256, np.uint8)
SCRIPT[0xC2:0xF5] = 9
SCRIPT[0xC3:0xCA] = 1
SCRIPT[0xCD:0xD0] = 2
SCRIPT[0xD0:0xD4] = 3
SCRIPT[0xD6:0xDC] = 4
SCRIPT[0xE0:0xE2] = 5
SCRIPT[0xE3] = 6
SCRIPT[0xE4:0xEA] = 7
SCRIPT[0xEA:0xEE] = 8
SCRIPTS = 10
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True


@dataclass
class Model:
    langs: list[str]
    scores: np.ndarray  # language, bucket: log share of trigrams
    allowed: np.ndarray  # script, language


def _trigrams(bodies: list[bytes]):
    """Of the joined texts: words' starts and ends, each byte's bucket (a word's end counts as a byte), each document's
    first word, and words' scripts."""
    text = LOWER[np.frombuffer(b" ".join([b"", *bodies, b""]), np.uint8)]
    apart = SEPARATOR[text]
    edge = np.flatnonzero(np.diff(~apart).astype(bool)) + 1
    starts, ends = edge[::2], edge[1::2]
    clean = np.where(apart, 32, text).astype(np.uint32)
    before = np.concatenate(([32], clean[:-1])).astype(np.uint32)
    before2 = np.concatenate(([32, 32], clean[:-2])).astype(np.uint32)
    before2[before == 32] = 32
    bucket = (before2 * np.uint32(7919) + before * np.uint32(263) + clean * np.uint32(40009)) & np.uint32(BUCKETS - 1)
    begin = 1 + np.concatenate(([0], np.cumsum(np.fromiter((len(b) + 1 for b in bodies), np.int64, len(bodies)))))
    script = np.maximum.reduceat(SCRIPT[text], starts) if len(starts) else np.empty(0, np.uint8)
    return text, starts, ends, bucket, begin, np.searchsorted(starts, begin), script


def fit(docs: DataFrame, learn, sample: int = SAMPLE) -> Model:
    """Learns from the text and lang of the rows where the condition `learn` holds and lang is not null."""
    rows = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    share = min(1.0, sample / max(1, rows.count()))
    chosen = rows.where(F.pmod(F.xxhash64(F.col("doc_id"), F.lit("language")), F.lit(1 << 20)) < share * (1 << 20))

    def tally(batches):
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, body in zip(batch.column("lang").to_pylist(), batch.column("body").to_pylist(), strict=True):
                _, starts, ends, bucket, _, _, script = _trigrams([body])
                if len(starts):
                    inside = np.zeros(len(bucket) + 1, np.int8)
                    inside[starts] = 1
                    inside[ends + 1] -= 1
                    own = np.concatenate((np.bincount(bucket[np.cumsum(inside[:-1]) > 0], minlength=BUCKETS), np.bincount(script, minlength=SCRIPTS)))
                    counts[lang] = counts[lang] + own if lang in counts else own
        yield pa.RecordBatch.from_pydict({"lang": pa.array(list(counts), pa.string()), "counts": pa.array([c.astype("<i8").tobytes() for c in counts.values()], pa.binary())})

    parts = chosen.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("binary").alias("body")).repartition(8).mapInArrow(tally, "lang string, counts binary")
    total: dict[str, np.ndarray] = {}
    for row in parts.collect():  # eight tables of fixed size for each language
        own = np.frombuffer(row.counts, "<i8")
        total[row.lang] = total.get(row.lang, 0) + own
    langs = sorted(total)
    if not langs:
        return Model([], np.empty((0, BUCKETS), np.float32), np.ones((SCRIPTS, 0), bool))
    table = np.array([total[k] for k in langs], float)
    grams, scripts = table[:, :BUCKETS] + 0.2, table[:, BUCKETS:]
    allowed = (scripts / scripts.sum(axis=1, keepdims=True) >= 1e-5).T
    allowed[~allowed.any(axis=1)] = True
    return Model(langs, np.log(grams / grams.sum(axis=1, keepdims=True)).astype(np.float32), allowed)


def label(bodies: list[bytes], model: Model, penalty: float = PENALTY):
    """Each word's language, its bytes, and each document's first word."""
    text, starts, ends, bucket, _, first, script = _trigrams(bodies)
    n, langs = len(starts), len(model.langs)
    if not langs:
        return np.zeros(n, np.int16), ends - starts, first, text, starts, ends
    scores = np.empty((n, langs), np.float32)
    cuts = np.empty(2 * n, np.int64)
    cuts[::2], cuts[1::2] = starts, ends + 1
    cuts = cuts[:-1] if n and cuts[-1] >= len(bucket) else cuts
    for k in range(langs):
        if n:
            scores[:, k] = np.add.reduceat(model.scores[k][bucket], cuts)[::2]
    scores -= scores.max(axis=1, keepdims=True) if n else 0
    scores[~model.allowed[script]] -= 100
    labels = _paths(scores, first, penalty)
    return labels, ends - starts, first, text, starts, ends


def _forward(scores: np.ndarray, begin: np.ndarray, sizes: np.ndarray, value: np.ndarray, penalty: float, came: np.ndarray | None) -> np.ndarray:
    """The best value of each sequence for each language of its last word, from `value` before its first. Sequences come
    longest first, so that those still running lie at the front; came gets where each word's language came from."""
    own = np.arange(value.shape[-1], dtype=np.int16)
    for t, live in enumerate(_lives(sizes)):
        now = value[:live]
        best = now.argmax(axis=-1)
        switched = now.max(axis=-1, keepdims=True) - penalty
        switch = switched > now
        at = begin[:live] + t
        if came is not None:
            came[at] = np.where(switch, best[..., None], own)
        step = scores[at]
        value[:live] = np.where(switch, switched, now) + (step if value.ndim == 2 else step[:, None, :])
    return value


def _lives(sizes: np.ndarray) -> list[int]:
    """For each place, how many of the sequences, longest first, reach it."""
    return np.searchsorted(-sizes, -np.arange(int(sizes[0]) if len(sizes) else 0), side="left").tolist()


def _backward(came: np.ndarray, begin: np.ndarray, sizes: np.ndarray, state: np.ndarray, labels: np.ndarray | None) -> np.ndarray:
    """The languages before the first words, of paths that end in `state`; labels gets those on the way."""
    for t, live in reversed(list(enumerate(_lives(sizes)))):
        at = begin[:live] + t
        if labels is not None:
            labels[at] = state[:live]
        state[:live] = came[at if state.ndim == 1 else at[:, None], state[:live]]
    return state


def _paths(scores: np.ndarray, first: np.ndarray, penalty: float, stretch: int | None = None) -> np.ndarray:
    """The language of each word on its text's best path. A text of over `stretch` words is cut into stretches that are
    passed side by side: what each makes of every language that it could begin with is a matrix, the matrices are joined
    from the first to the last stretch, and so the values that each begins with are those of the whole text."""
    n, langs = scores.shape
    stretch = stretch or STRETCH
    counts = np.diff(first)
    parts = np.maximum(1, -(-counts // stretch))
    doc = np.repeat(np.arange(len(counts)), parts)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
    begin = first[doc] + number * stretch
    sizes = np.minimum(stretch, first[doc + 1] - begin)
    start = np.zeros((len(doc), langs), np.float64)
    cut = np.flatnonzero(parts[doc] > 1)
    if len(cut):
        held = max(1, MATRICES // (langs * langs))
        matrix = np.empty((len(cut), langs, langs), np.float32)
        for low in range(0, len(cut), held):
            own = cut[low : low + held]
            order = np.argsort(-sizes[own], kind="stable")
            one = np.where(np.eye(langs, dtype=bool), np.float32(0), np.float32(-1e30))
            value = np.broadcast_to(one, (len(own), langs, langs)).copy()
            matrix[low + order] = _forward(scores, begin[own][order], sizes[own][order], value, penalty, None)
        for i, k in enumerate(cut.tolist()):
            if number[k] + 1 < parts[doc[k]]:
                after = (start[k][:, None] + matrix[i]).max(axis=0)
                start[k + 1] = after - after.max()
    order = np.argsort(-sizes, kind="stable")
    came = np.empty((n, langs), np.int16)
    value = _forward(scores, begin[order], sizes[order], start[order].astype(np.float32), penalty, came)
    final = np.empty(len(doc), np.int64)
    final[order] = value.argmax(axis=1)
    if len(cut):
        order_cut = cut[np.argsort(-sizes[cut], kind="stable")]
        every = np.broadcast_to(np.arange(langs), (len(cut), langs)).copy()
        before = np.empty((len(doc), langs), np.int64)
        before[order_cut] = _backward(came, begin[order_cut], sizes[order_cut], every, None)
        for k in cut[::-1].tolist():
            if number[k]:
                final[k - 1] = before[k, final[k]]
    labels = np.empty(n, np.int16)
    _backward(came, begin[order], sizes[order], final[order], labels)
    return labels


def _lettered(bodies: list[bytes], text, starts, ends, first) -> np.ndarray:
    """Which documents have a letter."""
    ascii_letters = np.concatenate(([0], np.cumsum(LETTER[text])))
    begin = np.concatenate(([1], 1 + np.cumsum(np.fromiter((len(b) + 1 for b in bodies), np.int64, len(bodies)))))
    has = ascii_letters[begin[1:] - 1] > ascii_letters[begin[:-1]]
    for i in np.flatnonzero(~has).tolist():
        has[i] = any(c.isalpha() for c in bodies[i].decode("utf-8", "ignore"))
    return has


def _most(labels: np.ndarray, sizes: np.ndarray, first: np.ndarray, langs: list[str]) -> tuple[list[str], np.ndarray]:
    """The language with most bytes of each text, and its share of them."""
    n, several = len(first) - 1, max(len(langs), 1)
    doc = np.repeat(np.arange(n), np.diff(first))
    weight = np.bincount(doc * several + labels, weights=sizes, minlength=n * several).reshape(n, -1)
    best = weight.argmax(axis=1)
    share = weight[np.arange(n), best] / np.maximum(weight.sum(axis=1), 1)
    return [langs[b] if langs else "und" for b in best.tolist()], share


def predict(docs: DataFrame, model: Model, penalty: float = PENALTY) -> DataFrame:
    """doc_id, lang_pred, score (the share of the text's words' bytes in that language), spans of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x 65,536 scores, whatever the table's size

    def work(batch):
        own, bodies = shared.value, batch.column("body").to_pylist()
        labels, sizes, first, text, starts, ends = label(bodies, own, penalty)
        has = _lettered(bodies, text, starts, ends, first) & (len(own.langs) > 0)
        n, langs = len(bodies), len(own.langs)
        doc = np.repeat(np.arange(n), np.diff(first))
        told, share = _most(labels, sizes, first, own.langs)
        names = [lang if h else "und" for lang, h in zip(told, has.tolist(), strict=True)]
        turn = np.ones(len(labels), bool)
        turn[1:] = (np.diff(labels) != 0) | (np.diff(doc) != 0)
        turns = np.flatnonzero(turn)
        runs = np.diff(np.append(turns, len(labels)))
        cuts = np.searchsorted(turns, first)
        spans = pa.StructArray.from_arrays([pa.array([own.langs[k] if langs else "und" for k in labels[turns].tolist()], pa.string()), pa.array(turns - first[doc[turns]], pa.int64()), pa.array(runs, pa.int64())], names=["lang", "first_word", "words"])
        return pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "lang_pred": pa.array(names), "score": pa.array(np.where(has, share, 0.0)), "spans": pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), spans)})

    schema = "doc_id long, lang_pred string, score double, spans array<struct<lang:string,first_word:long,words:long>>"
    return map_slices(id_and_bytes(docs), work, schema, limit=_limit(model))


def _limit(model: Model) -> int:
    """Bytes of a slice: a word has a score for each language."""
    return max(1 << 16, (4 << 20) * 8 // max(8, len(model.langs)))


def keep_known(docs: DataFrame, model: Model, penalty: float = PENALTY) -> DataFrame:
    """The rows of `docs` that have a language, texts without letters and nulls go; a row without lang gets the language
    that the model tells (`und` if it has learned none), all other columns stay as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names, extra = docs.columns, "body"
    while extra in names:
        extra += "_"

    def work(batch):
        bodies = batch.column(extra).to_pylist()
        labels, sizes, first, text, starts, ends = label(bodies, shared.value, penalty)
        has = _lettered(bodies, text, starts, ends, first)
        told, _ = _most(labels, sizes, first, shared.value.langs)
        own = batch.column("lang")
        filled = pc.if_else(pc.is_null(own), pa.array(told, pa.string()).cast(own.type), own)
        kept = batch.select(names)
        return kept.set_column(names.index("lang"), kept.schema.field("lang"), filled).filter(pa.array(has))

    with_body = docs.withColumn(extra, F.coalesce(F.col("text").cast("binary"), F.lit(b"")))
    return map_slices(with_body, work, docs.schema, extra, limit=_limit(model))
