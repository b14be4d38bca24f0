"""The pipeline stage by stage against a plain version."""

import random
import re

import corpus_pipeline
from hearken.llm.common import saved

from .test_operators import UPPER, WORD, cleaned, components, prose, texts


def test_stages(spark):
    rows = [(3 * i + 5, t, ["en", "fr", None][i % 3], "s", len(t) if t else 0) for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = saved(docs, "test")
    now = {d: t for d, t, *_ in rows}
    names = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = saved(stage(spark, docs, ""), f"stage{k}")
        if name == "language ID":
            now = {d: t for d, t in now.items() if t and any(c.isalpha() for c in t)}
        elif name == "exact dedup":
            last = {t: d for d, t in sorted(now.items())}
            now = {d: t for d, t in now.items() if last[t] == d}
        elif name == "n-gram Jaccard join":
            now = {d: now[d] for d, (_, c) in components(now).items() if c == d}
        elif name == "substring dedup":
            now = {d: kept if n else now[d] for d, (_, n, kept) in cleaned(now).items()}
        if name != "best-fit packing":
            assert docs.columns == names
            got = docs.collect()
            assert {r.doc_id: r.text for r in got} == now and len(got) == len(now), name
        else:
            assert {r.doc_id for r in docs.collect()} == set(now)


def test_repeated_rows_and_nothing(spark):
    rows = [(1, "alpha beta gamma", "en", "s", 3)] * 3 + [(2, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.unique(spark, docs, "")
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2]
    nothing = docs.where("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES:
        nothing = saved(stage(spark, nothing, ""), "none")
    assert nothing.count() == 0


def test_rows_without_or_with_another_s_id_are_decided_by_their_own_text(spark):
    long = " ".join(f"word{i}" for i in range(60))
    rows = [(None, "clean text without an id"), (None, "another text without an id"), (None, "another text without an id"), (None, "said with an id too"), (3, "said with an id too"), (3, "said twice"), (9, "said twice"), (3, long), (2, long + " near"), (None, "...")]
    docs = saved(spark.createDataFrame(rows, "doc_id long, text string"), "test")
    rows = lambda df: sorted((r.doc_id or 0, r.text) for r in df.collect())
    left = [(0, "..."), (0, "another text without an id"), (0, "clean text without an id"), (2, long + " near"), (3, "said with an id too"), (3, long), (9, "said twice")]
    kept = saved(corpus_pipeline.unique(spark, docs, ""), "kept")
    assert rows(kept) == sorted(left)
    left.remove((3, long))
    one = saved(corpus_pipeline.distinct(spark, kept, ""), "one")
    assert rows(one) == sorted(left)
    assert rows(corpus_pipeline.passages(spark, one, "")) == sorted(left)
    assert corpus_pipeline.pack(spark, one, "").count() == len(left)


def test_clashing_columns_and_two_texts_of_one_id(spark):
    rng = random.Random(13)
    passage, a, b, tail, head = prose(rng, 60), prose(rng, 80), prose(rng, 80), prose(rng, 70), prose(rng, 70)
    for order in (1, -1):
        rows = [(5, passage + " " + tail), (5, "short other text"), (0, head + " " + passage), (7, a), (7, b), (2, a + " near"), (9, None), (8, "")][::order]
        docs = spark.createDataFrame([(d, t, 1, "body", 2, 3.0, "k") for d, t in rows], "doc_id long, text string, node int, body string, root int, cut double, text_key string").coalesce(1)
        docs = saved(docs, "test")
        names = docs.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = saved(stage(spark, docs, ""), "stage") if name != "language ID" else docs
            assert docs.columns == names
        got = sorted((r.doc_id, r.text) for r in docs.collect() if r.text)
        assert got == sorted([(5, tail), (5, "short other text"), (0, head + " " + passage), (7, b), (2, a + " near")])


def test_words_agree():
    assert WORD.findall("a\x0bB c") == ["a", "B", "c"] and "ÀZ".translate(UPPER) == "Àz" and re.escape("x")
