"""Licences that differ in a word; many languages and long texts; rows without ids over shards; a stage that uses its model."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hearken.llm import language, licenses, media, packing

PROBES = {
    "licensed under the GNU General Public License version 2": "gpl",
    "Licensed under the GNU General Public License, version 3.": "gpl,gpl-3.0",
    "licensed under the GNU Lesser General Public License version 3": "gpl",
    "licensed under the Apache License, Version 1.1": "",
    "Licensed under the Apache License, Version 2.0": "apache-2.0",
    "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License": "",
    "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License": "",
    "This work is licensed under a Creative Commons Attribution 4.0 International License": "cc-by",
    "released under the BSD license": "",
    "released under the MIT license": "mit",
    "Mozilla Public License, version 1.1": "",
    "subject to the Mozilla Public License, version 2.0": "mpl-2.0",
}


def test_licences_are_told_from_their_neighbours(spark):
    docs = spark.createDataFrame(list(enumerate(PROBES)), "doc_id long, text string")
    assert {r.doc_id: r.labels for r in licenses.scan(docs).collect()} == dict(enumerate(PROBES.values()))


def test_every_notice_has_its_own_deciding_grams(spark):
    docs = spark.createDataFrame(list(enumerate(licenses.TEMPLATES)), "doc_id long, text string")
    told = {r.doc_id: r.labels.split(",") for r in licenses.scan(docs).collect()}
    assert all(label in told[i] for i, label in enumerate(licenses.TEMPLATES.values()))
    assert all(places == sorted(set(places)) and max(places, default=0) <= len(phrase.split()) - licenses.GRAM for phrase, label in licenses.TEMPLATES.items() for places in [licenses.deciding(phrase, label)])


def random_model(langs, seed=8):
    r = np.random.default_rng(seed)
    grams = r.normal(size=(langs, language.BUCKETS)).astype(np.float32) - 8
    return language.Model([f"l{k:03d}" for k in range(langs)], grams, np.ones((language.SCRIPTS, langs), bool))


@pytest.mark.parametrize("langs", [1, 3, 150])
def test_paths_in_stretches_are_those_of_whole_texts(langs):
    r = np.random.default_rng(langs)
    sizes = [0, 1, 700, 64, 65, 3, 0, 300]
    first = np.concatenate(([0], np.cumsum(sizes)))
    scores = (r.normal(size=(first[-1], langs)) * 3).astype(np.float32)
    scores -= scores.max(axis=1, keepdims=True)

    def worth(labels):
        return [float(scores[np.arange(a, b), labels[a:b]].sum()) - 4.0 * int((np.diff(labels[a:b]) != 0).sum()) for a, b in zip(first[:-1], first[1:])]

    whole = language._paths(scores, first, 4.0, 10_000)
    for stretch in (64, 7):
        assert np.allclose(worth(language._paths(scores, first, 4.0, stretch)), worth(whole), atol=1e-2)


def test_more_languages_than_a_byte_holds(spark):
    rng = random.Random(2)
    stems = {f"l{k:03d}": [chr(97 + k % 26) + chr(97 + k // 26) + chr(97 + (7 * k + j) % 26) for j in range(3)] for k in range(150)}
    rows = [(i, " ".join(rng.choice(stems[k]) + rng.choice(stems[k]) for _ in range(25)), k) for i, k in enumerate(sorted(stems) * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs, F.lit(True))
    told = {r.doc_id: r.lang_pred for r in language.predict(docs, model).collect()}
    assert len(model.langs) == 150 and sum(told[i] == k for i, _, k in rows) > 0.95 * len(rows)


def test_a_text_of_twenty_megabytes(spark):
    model = random_model(4)
    body = " ".join(random.Random(1).choices(["one", "deux", "tres", "vier", "x"], k=100_000)).encode()
    body = (body + b" ") * (20_000_000 // len(body))
    began = time.time()
    labels, sizes, first, *_ = language.label([body, b"one deux"], model, 3.0)
    assert time.time() - began < 40
    assert len(labels) == first[-1] == len(body.split()) + 2 and sizes.sum() == len(body.replace(b" ", b"")) + 7
    part = language.label([body[:60_000]], model, 3.0)[0]
    assert (part[:5000] == labels[:5000]).all()


def test_rows_without_ids_spread_over_shards(spark):
    rows = [(None, 0, 0, 100 + i % 7, 5) for i in range(4000)]
    cut = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long").repartition(4)
    packed = packing.pack(cut, shard_pieces=500)
    shards = packed.groupBy(F.shiftright("sequence_id", 32)).count().collect()
    assert len(shards) == 8 and max(r["count"] for r in shards) < 1000 and sum(r["count"] for r in shards) == 4000
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where(f"n > {packing.CAPACITY}").count() == 0


def test_the_language_stage_uses_its_model(spark):
    rows = [(i, text, lang) for i, (text, lang) in enumerate([("the cat and the dog", "en")] * 12 + [("der hund und die katze", "de")] * 12 + [("the dog and the cat", None), ("die katze und der hund", None), ("...", None), (None, "en")])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    told = {r.doc_id: r.lang for r in corpus_pipeline.identify(spark, docs, "").collect()}
    assert told == {i: g for i, _, g in rows[:24]} | {24: "en", 25: "de"}
    swapped = docs.withColumn("lang", F.when(F.col("lang") == "en", "de").when(F.col("lang") == "de", "en"))
    again = {r.doc_id: r.lang for r in corpus_pipeline.identify(spark, swapped, "").collect()}
    assert (again[24], again[25]) == ("de", "en")


def test_media_of_a_long_text_in_bounded_memory(monkeypatch):
    """Runs of frames give what all frames at once give, and a long text takes little more than itself."""
    import tracemalloc

    payloads = [bytes(random.Random(k).choices(range(256), k=n)) for k, n in enumerate((0, 1, 500, 40_000, 193))]
    whole = media.write_avi(payloads)
    monkeypatch.setattr(media, "RUN", 7)
    assert media.write_avi(payloads) == whole
    monkeypatch.undo()
    text = b"some words that go on and on " * 700_000
    tracemalloc.start()
    stored = media.write_avi([text])
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 20 * len(text) + (400 << 20) and stored[0][:4] == b"RIFF"
    begin, sizes, _ = media.frame_index(stored[0])
    data = np.frombuffer(stored[0], np.uint8)
    back = media.decode_frames(data, begin[-5:], sizes[-5:])
    assert back.tobytes().rstrip() == text[len(text) // 192 * 192 - 4 * 192 :].rstrip() and len(begin) == -(-len(text) // 192)
