"""SimHash, phrases and whitening against brute force and plain versions, and on null, empty, long, repeated and clashing
input."""

import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from hearken.llm import phrases, queries, simhash, whitening

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def prose(rng, n, vocabulary=60):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


# --- 11


def plain_fingerprint(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate(UPPER))
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(fps, distance):
    """The least number that links lead to from each place."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance and find(i) != find(j):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(fps))]


def odd_texts():
    rng = random.Random(11)
    base = prose(rng, 200, 900)
    out = [None, "", " \t\x0b", "one", "One", "one two", base, base.upper(), base + " tail", "x" * 70 + " " + "y" * 33 + " zz Zz", "é ñ 日本語 ß İK \x1c\x85", "a " * 700, prose(rng, 20_000)]
    for _ in range(20):
        own = base.split()
        own[rng.randrange(len(own))] = f"x{rng.randrange(99)}"
        out.append("\n".join(own))
    return out


def test_xxh64_equals_the_library_at_all_lengths():
    rng = np.random.default_rng(1)
    text = rng.integers(0, 256, 4000).astype(np.uint8)
    starts = rng.integers(0, 3900, 300)
    ends = starts + np.arange(300) % 90
    want = [xxhash.xxh64_intdigest(text[a:b].tobytes(), 42) for a, b in zip(starts, ends)]
    assert simhash.xxh64(text, starts, ends).tolist() == want


def test_fingerprints_equal_plain_ones():
    texts = odd_texts()
    assert simhash.fingerprints([(t or "").encode() for t in texts]).tolist() == [plain_fingerprint(t) for t in texts]
    assert simhash.fingerprints([]).tolist() == []


def test_simhash_groups(spark):
    rows = [(i + 3, t, "en", 1, 2, 3) for i, t in enumerate(odd_texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, fp int, body int, root int").repartition(3)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.grouped(docs).collect()}
    fps = [plain_fingerprint(t) for _, t, *_ in rows]
    want = plain_groups(fps, simhash.DISTANCE)
    assert got == {d: (f"{f:016x}", g + 3) for (d, *_), f, g in zip(rows, fps, want)}
    assert simhash.grouped(docs.where("doc_id < 0")).collect() == []


def test_simhash_rows_with_one_id_or_none(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (7, "a b c d"), (7, "other words stand here"), (None, "alone as it is"), (9, None), (9, None)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.component_id or 0) for r in simhash.grouped(docs).collect())
    assert [g for g in got if g[0] == 0].count((0, 7)) == 2 and (0, 0) in got
    assert got.count((9, 9)) == 2 and got.count((7, 7)) == 2


def near(rng, centre, bits):
    return centre ^ sum(1 << b for b in rng.sample(range(64), bits))


@pytest.mark.parametrize(("distance", "segments", "crowd"), [(2, 2, 64), (2, 2, 2), (2, 2, 0), (3, 2, 64), (3, 2, 1), (1, 2, 64), (1, 1, 1), (4, 3, 64), (2, 3, 5), (0, 2, 64)])
def test_links_connect_what_all_pairs_connect(spark, distance, segments, crowd):
    from hearken.llm.graph import components

    rng = random.Random(distance * 100 + segments * 10 + crowd)
    fps = {0, (1 << 64) - 1}
    for _ in range(6):
        centre = rng.getrandbits(64)
        fps |= {near(rng, centre, rng.randrange(0, 5)) for _ in range(25)}
    fps = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    frame = spark.createDataFrame([(f,) for f in fps], "fp long")
    edges = simhash.links(frame, distance, segments, crowd)
    assert all(((r.src ^ r.dst) & (1 << 64) - 1).bit_count() <= distance for r in edges.collect())
    roots = {r.node: r.root for r in components(edges).collect()}
    want = plain_groups([f & (1 << 64) - 1 for f in fps], distance)
    assert [roots.get(f, f) for f in fps] == [fps[g] for g in want]


def test_a_crowd_makes_no_pairs(spark):
    """3,000 fingerprints that share a segment: their links are stars, linear in their number."""
    rng = random.Random(4)
    fps = {(123 << 32) ^ sum(1 << b for b in rng.sample(range(32), rng.randrange(1, 4))) for _ in range(9000)}
    fps = sorted(fps)[:3000]
    edges = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"))
    assert edges.count() < 65 * len(fps)


# --- 12


def plain_phrases(rows, depth=5, least=100, top=2000):
    """lang, rank, phrase, a, l, r, n, score."""
    counts: dict[str, Counter] = {}
    for lang, text in rows:
        own = counts.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            own.update(tuple(words[i : i + m]) for i in range(len(words)) for m in range(1, depth + 1) if i + m <= len(words))
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = [p for p, c in f.items() if len(p) > 1 and c >= least]
        swallowed = {q[i : i + m] for q in candidates for m in range(2, len(q)) for i in range(len(q) - m + 1) if f[q] >= f[q[i : i + m]]}
        best = []
        for p in candidates:
            if p not in swallowed:
                score, k = min((1000 * f[p] * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                best.append((-score, -f[p], " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(best)[:top], 1)]
    return sorted(out)


def phrase_rows():
    rng = random.Random(12)
    rows = [(rng.choice(["en", "de", None, "und"]), prose(rng, rng.randrange(0, 120), 12) + rng.choice([".", "\r\n", " ", ",x", ""]) + prose(rng, 30, 12).upper()) for _ in range(150)]
    return rows + [(None, None), ("en", None), ("fr", ""), ("fr", "...  ,\t"), ("en", "w1 " * 5000), ("ß", "Ünï cödé\x85İ \x1c| a"), ("en", "w1\tw2  w3;w4")] + [("en", "a b c d e f")] * 40


def mined(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize(("depth", "least", "top", "range_bytes"), [(5, 8, 50, 2000), (5, 8, 2000, 300), (5, 40, 7, 1 << 30), (2, 8, 20, 1000), (3, 5, 50, 500)])
def test_phrases(spark, monkeypatch, depth, least, top, range_bytes):
    rows = phrase_rows()
    docs = spark.createDataFrame([(i, t, g, 1, "x", 2) for i, (g, t) in enumerate(rows)], "doc_id long, text string, lang string, n int, phrase string, words int").repartition(4)
    monkeypatch.setattr(phrases, "SHARD_BYTES", 3000)
    assert mined(phrases.mine(docs, depth, least, top, range_bytes)) == plain_phrases(rows, depth, least, top)


def test_phrases_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert phrases.mine(docs).collect() == []
    assert phrases.mine(spark.createDataFrame([(1, None, None), (2, " . ", "en")], "doc_id long, text string, lang string")).collect() == []


def test_a_long_text_is_cut_between_pieces(monkeypatch):
    monkeypatch.setattr(phrases, "SHARD_BYTES", 100)
    body = b"one two three. " * 100 + b"x" * 500
    batch = pa.RecordBatch.from_pydict({"lang": pa.array([b"en"], pa.binary()), "body": pa.array([body], pa.binary())})
    parts = [b for _, bodies in phrases._stretches([batch]) for b in bodies]
    assert b"".join(parts) == body and len(parts) > 5 and all(p.endswith(b".") for p in parts[:-1])


def test_tries_come_back_from_their_stored_form():
    rng = np.random.default_rng(3)
    vocabulary, rows = phrases.windows_of([b"en", b"de"], [b"a b c. a b d a b c", b"b b b b b b b, a " + b"q" * 300])
    trie = phrases.Trie(vocabulary, rows, rng.integers(1, 70_000, len(rows)))
    for low, high in ((0, len(trie.rows)), (3, 9), (len(trie.rows) - 1, len(trie.rows))):
        back = phrases.merged([trie.part(low, high)])
        words = lambda t, part: [[t.vocabulary[i - 1].as_py() for i in row if i] for row in part.tolist()]
        assert words(back, back.rows) == words(trie, trie.rows[low:high]) and back.counts.tolist() == trie.counts[low:high].tolist()


def test_products_beyond_64_bits(spark):
    big = 4_000_000_000_000
    found = spark.createDataFrame([("en", "", 0, 10 * big), ("en", "a", 1, big + 7), ("en", "b", 1, big + 9), ("en", "a b", 2, big)], "lang string, phrase string, words int, n long")
    row = phrases.linked(found, 2).where("words = 2").first()
    assert row.lefts == [big + 7] and row.rights == [big + 9] and row.whole
    assert 1000 * big * 10 * big > 1 << 64


# --- 13


def plain_whitening(vectors, components=8):
    """n, exact sums, deviations, eigenvalues, whitened vectors."""
    x = [[int(np.floor(1024 * float(c))) + 100_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    sums = [sum(r[k] for r in x) for k in range(d)]
    deviations = [sum((n * r[k] - sums[k]) ** 2 for k in range(d)) for r in x]
    off = np.array([[float(Fraction(n * r[k] - sums[k], n)) for k in range(d)] for r in x])
    values, axes = np.linalg.eigh(off.T @ off / n)
    return n, sums, deviations, values[::-1][:components], off @ axes[:, ::-1][:, :components] / np.sqrt(values[::-1][:components]), values.sum()


def test_whitening(spark):
    rng = np.random.default_rng(13)
    mixed = rng.normal(size=(12, 12))
    vectors = (rng.normal(size=(300, 12)) @ mixed / 5).astype(np.float32)
    rows = [(i, v.tolist(), "x", 1) for i, v in enumerate(vectors)]
    bad = [(900, None, "x", 1), (901, [1.0] * 11 + [None], "x", 1), (902, [float("nan")] * 12, "x", 1), (903, [float("inf")] + [0.0] * 11, "x", 1), (904, [], "x", 1), (905, [1.0, 2.0], "x", 1), (906, [1e300] * 12, "x", 1)]
    frame = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, x string, component int").repartition(4)
    got = whitening.whiten(frame).collect()
    n, _, deviations, values, whitened, trace = plain_whitening(vectors)
    assert len(got) == 8 * 300 and {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1
    assert got[0].identity_error < 1e-9
    assert {r.vec_id: int(r.deviation) for r in got} == dict(enumerate(deviations))
    for r in got:
        assert abs(r.explained - values[r.component - 1] / trace) < 1e-9 * r.explained
    for k in range(8):
        mine = np.array([r.whitened for r in sorted(got, key=lambda r: r.vec_id) if r.component == k + 1])
        assert min(np.abs(mine - whitened[:, k]).max(), np.abs(mine + whitened[:, k]).max()) < 1e-6


def test_whitening_edges(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None), (2, [])], schema)).collect() == []
    alike = whitening.whiten(spark.createDataFrame([(None, [1.0, 2.0]), (3, [1.0, 2.0]), (3, [1.0, 2.0])], schema)).collect()
    assert len(alike) == 6 and {(r.n, int(r.deviation), r.whitened, r.explained) for r in alike} == {(3, 0, 0.0, 0.0)}
    # A dimension without variance is a component that explains nothing.
    flat = whitening.whiten(spark.createDataFrame([(i, [float(i), 5.0]) for i in range(9)], schema)).collect()
    assert {(r.component, round(r.explained, 9)) for r in flat} == {(1, 1.0), (2, 0.0)}
    assert all(r.whitened == 0.0 for r in flat if r.component == 2)


def test_sums_and_deviations_beyond_64_bits():
    x = np.array([[1 << 61, -(1 << 61)], [0, 5], [1 << 60, 7]], np.int64)
    sums = np.array([sum(int(v) for v in c) for c in x.T], object)
    model = whitening.Whitening(3, sums, np.eye(2), np.ones(2), 2.0)
    assert model.deviations(x) == [sum((3 * int(v) - s) ** 2 for v, s in zip(r, sums)) for r in x]


def test_far_means_lose_nothing(spark):
    """Vectors far from the origin, whose variance a product of raw entries would lose."""
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(200, 4)) + 1e9
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = whitening.whiten(frame).collect()
    assert got[0].identity_error < 1e-9
    values = plain_whitening(vectors)[3]
    assert sorted({round(r.explained, 9) for r in got}, reverse=True) == [round(v, 9) for v in (values / values.sum())]


def test_the_query_s_columns(spark):
    rows = queries.op13_whitening(spark, "/root/testdata/sf0.001")
    assert dict(rows.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
    assert rows.where(F.col("deviation").isNull() | (F.col("identity_error") > 1e-4)).count() == 0
