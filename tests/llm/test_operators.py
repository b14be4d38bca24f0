"""Each operator against a brute-force version, and on null, empty, long, repeated and clashing input."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import public_tokenizers as P
from hearken.llm import bpe, common, exact_dedup, fm_index, graph, jaccard_join, language, licenses, media, packing, quality, queries, substring_dedup, token_files

WORD = re.compile(r"[^\x20\x09-\x0d]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BYTES, WORDS = P.path("byte_bpe_50k.tiktoken"), P.path("word_bpe_49k.json")


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def texts():
    """Copies, near copies, shared passages, short, long, empty, null and odd texts."""
    rng = random.Random(7)
    base = prose(rng, 300)
    passage = prose(rng, 70)
    out = [base, base, base.upper(), None, "", "   \n", "one", "one two three", passage, prose(rng, 20) + " " + passage + "\n" + prose(rng, 30), passage + " tail", "a " * 400, "a " * 120, prose(rng, 6000)]
    for k in range(12):
        own = base.split()
        for _ in range(rng.randrange(1, 14)):
            own[rng.randrange(len(own))] = f"x{rng.randrange(9999)}"
        out.append(" ".join(own))
    out += ["é́ ñ 日本語 ß İK \x1c\x85 x<|endoftext|>'s 123", "ﬁ ™ Ω　z", "General  PUBLIC license; all rights\nreserved. CC-BY cc by", "licensed under the very apache license version 2.0 now", None, "\x0b\x0c tabs\tand\rreturns "]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(3 * i + 5, t, ["en", "fr", None][i % 3], "s", 1, "clash", 2.0) for i, t in enumerate(texts())]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, body string, node double").repartition(3)


@pytest.fixture(scope="module")
def pairs(docs):
    return {r.doc_id: r.text or "" for r in docs.collect()}


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("doc_id < 0")


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_word_hashes_depend_on_content_alone():
    bodies = [b"aa bb  cc", b"", b"bb\tcc", b" " * 5, b"aa bb"]
    w = common.Words(bodies)
    assert np.diff(w.first).tolist() == [3, 0, 2, 0, 2]
    a = [w.hashes[w.first[i] : w.first[i + 1]].tolist() for i in range(5)]
    assert a[0][1:] == a[2] and a[0][:2] == a[4]
    long = np.arange(3_000_000, dtype=np.uint64) % np.uint64(7)
    at = np.array([0, 7, 700_000, 2_100_000])
    assert len(set(common.span_hashes(long, at, at + 5000).tolist())) == 1


# --- 1

def test_fm_index_finds_what_brute_force_finds():
    for seed in range(25):
        r = np.random.default_rng(seed)
        size, w = int(r.integers(2, 6)), int(r.integers(2, 9))
        seqs = [r.integers(0, size, int(r.integers(w, 25))).astype(np.uint64) for _ in range(int(r.integers(2, 12)))]
        owners = r.integers(0, 6, len(seqs))
        index = fm_index.FMIndex(seqs, owners, w)
        found = index.matches(index.codes(np.concatenate(seqs)), np.array([len(s) for s in seqs]), owners, w)
        first = {}
        for s, o in zip(seqs, owners, strict=True):
            for i in range(len(s) - w + 1):
                first[tuple(s[i : i + w])] = min(first.get(tuple(s[i : i + w]), 99), o)
        assert found.tolist() == [i + w <= len(s) and first[tuple(s[i : i + w])] < o for s, o in zip(seqs, owners, strict=True) for i in range(len(s))]


def cleaned(pairs, window=50):
    words = {d: WORD.findall(t) for d, t in pairs.items()}
    first = {}
    for d in sorted(words):
        for i in range(len(words[d]) - window + 1):
            first.setdefault(tuple(words[d][i : i + window]), d)
    out = {}
    for d, w in words.items():
        gone = {j for i in range(len(w) - window + 1) if first[tuple(w[i : i + window])] < d for j in range(i, i + window)}
        out[d] = (len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
    return out


@pytest.mark.parametrize("hot", [8192, 1, 3])
def test_substring_dedup(docs, pairs, hot):
    got = {d: (r.n_words, r.n_removed, bytes(r.kept).decode()) for d, r in by_id(substring_dedup.cleaned(docs, hot=hot, shard_words=300)).items()}
    assert got == cleaned(pairs)
    assert sum(x[1] for x in got.values()) > 500


def test_substring_dedup_edges(docs, none, pairs):
    assert substring_dedup.cleaned(none).count() == 0
    short = by_id(substring_dedup.cleaned(docs, window=6, gram=3))
    assert {d: (r.n_words, r.n_removed) for d, r in short.items()} == {d: x[:2] for d, x in cleaned(pairs, 6).items()}


def test_substring_dedup_tells_rows_with_one_id_apart(spark):
    rng = random.Random(12)
    passage = prose(rng, 60)
    long, other = prose(rng, 900) + " " + passage, passage + " x"
    for rows in ([(5, long), (5, "short text"), (0, other), (5, long)], [(5, "short text"), (5, long), (5, long), (0, other)], [(5, passage + " a"), (5, "b " + passage), (None, passage), (None, "c " + passage)]):
        got = [(r.doc_id, r.n_words, r.n_removed, bytes(r.kept).decode()) for r in substring_dedup.cleaned(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()]
        expected = []
        for d, t in rows:
            alone = cleaned({5: t, 0: other} if (0, other) in rows and d == 5 else {5: t})[5]
            expected.append((d, *alone))
        assert sorted(got, key=str) == sorted(expected, key=str)


def test_long_words_that_agree_modulo_two_to_the_64th_differ():
    word = [0]
    for _ in range(11):
        word += [1 - b for b in word]
    pair = [bytes(97 + (b ^ k) for b in word) for k in (0, 1)]
    plain = common.span_hashes(common._TABLE[np.frombuffer(b"".join(pair), np.uint8)], np.array([0, 2048]), np.array([2048, 4096]))
    assert plain[0] == plain[1]
    assert len(set(common.Words([b" ".join(pair)]).hashes.tolist())) == 2


def test_least_of_ranges():
    r = np.random.default_rng(3)
    for n in (1, 5, 32, 33, 1000):
        values = r.integers(0, 999, n).astype(np.int32)
        low = r.integers(0, n, 300)
        high = np.array([int(r.integers(a + 1, n + 1)) for a in low])
        assert fm_index.Least(values).of(low, high).tolist() == [int(values[a:b].min()) for a, b in zip(low, high, strict=True)]


# --- 2

def test_media_round_trip():
    odd = [b"", b"\xff\x00" * 500, bytes(range(256)) * 3, bytes(np.random.default_rng(1).integers(0, 256, 5000, dtype=np.uint8)), b"x" * 192]
    stored = media.write_avi(odd)
    for body, avi in zip(odd, stored, strict=True):
        begin, sizes, pace = media.frame_index(avi)
        samples = media.decode_frames(np.frombuffer(avi, np.uint8), begin, sizes)
        assert samples.tobytes() == body.ljust(max(192, -(-len(body) // 192) * 192)) and pace == 100_000
    with pytest.raises(ValueError):
        media.frame_index(b"RIFF....WAVE")


def test_media_columns(docs, pairs, none):
    got = by_id(media.features(media.to_media(docs)))
    seen = {}
    for d, t in pairs.items():
        body = t.encode()
        payload = body.ljust(max(192, -(-len(body) // 192) * 192))
        r = got[d]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(body), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
        assert seen.setdefault(t, (r.media_sha256, r.feature)) == (r.media_sha256, r.feature)
    assert media.features(media.to_media(none)).count() == 0


def test_clips_cover_all_frames():
    frames = np.concatenate([np.full((5, 192), 10), np.full((4, 192), 200), np.full((3, 192), 90)]).astype(np.uint8)
    assert np.flatnonzero(media.shots(frames, np.array([12]))).tolist() == [0, 5, 9]
    assert np.flatnonzero(media.shots(frames, np.array([7, 5]))).tolist() == [0, 5, 7, 9]


def plain_shots(frames):
    """Frames that begin a shot, one after the other."""
    hists = [[sum(v >> 4 == b for v in f) for b in range(16)] for f in frames]
    diffs = [0] + [sum(abs(x - y) for x, y in zip(a, b)) for a, b in zip(hists, hists[1:])]
    return [i for i, d in enumerate(diffs) if i == 0 or (d > 24 and d > 1.5 * sum(diffs[max(0, i - 8) : i]) / min(i, 8))]


def test_shots_and_clips_against_a_plain_version(spark):
    rng = random.Random(6)
    texts = [b"a" * 192 * 5 + bytes(range(128)) * 9 + b"a" * 192 * 3, b"", b"%" * 400, "".join(rng.choice("ab \n\u00e9XYZ09.,") for _ in range(9000)).encode(), prose(rng, 900).encode() + bytes(range(32, 127)) * 40]
    docs = spark.createDataFrame([(i, t.decode()) for i, t in enumerate(texts)] + [(9, None)], "doc_id long, text string")
    rows = defaultdict(list)
    for r in sorted(media.clips(media.to_media(docs)).collect(), key=lambda r: (r.doc_id, r.clip)):
        rows[r.doc_id].append((r.clip, r.first_frame, r.frames, r.start_s, r.end_s))
    for i, body in [*enumerate(texts), (9, b"")]:
        body = body.ljust(max(192, -(-len(body) // 192) * 192))
        frames = [body[k : k + 192] for k in range(0, len(body), 192)]
        firsts = plain_shots(frames)
        assert rows[i] == [(k, a, b - a, a / 10, b / 10) for k, (a, b) in enumerate(zip(firsts, [*firsts[1:], len(frames)]))]
    assert max(map(len, rows.values())) > 2


# --- 3

def test_byte_bpe(spark, docs, pairs, none):
    import tiktoken

    codec = bpe.ByteCodec.of(BYTES, P.PATTERN)
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    got = by_id(bpe.round_trip(docs, BYTES, P.PATTERN))
    for d, t in pairs.items():
        ids = library.encode_ordinary(t)
        assert (got[d].n_tokens, got[d].ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()), t[:80]
        assert got[d].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
    ids = bpe.encode(docs, BYTES, P.PATTERN)
    assert {d: bytes(r.body).decode() for d, r in by_id(bpe.decode(ids, BYTES, P.PATTERN)).items()} == pairs
    assert bpe.round_trip(none, BYTES, P.PATTERN).count() == 0


def junk(seed):
    rng = random.Random(seed)
    return "".join(rng.choice("aabbc  \n\t'sStrevml1290éßçñ日本Ωاا🙂́\x1c\x85<|endoftext|>.,;-　İẞ") for _ in range(rng.randrange(0, 200)))


def test_codecs_equal_the_libraries():
    import tiktoken

    many = [junk(i) for i in range(600)] + ["a" * 3000, "ab" * 900, "é" * 500, " " * 300 + "x", ""]
    codec = bpe.ByteCodec.of(BYTES, P.PATTERN)
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    words = bpe.WordCodec.of(WORDS)
    for one, expected, end in ((codec, lambda t: library.encode_ordinary(t), []), (words, lambda t: words.library.encode(t, add_special_tokens=False).ids, [1])):
        ids, counts = one.encode([t.encode() for t in many], *end)
        cut = np.split(ids, np.cumsum(counts)[:-1])
        assert [c.tolist() for c in cut] == [expected(t) + end for t in many]


# --- 4

def components(pairs):
    sets = {}
    for d, t in pairs.items():
        w = WORD.findall(t.translate(UPPER))
        sets[d] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                n = len(sets[a] & sets[b])
                if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {d: (len(sets[d]), find(d)) for d in sets}


@pytest.mark.parametrize("block", [4096, 3])
def test_jaccard_join(docs, pairs, block):
    got = {d: (r.n_shingles, r.component_id) for d, r in by_id(jaccard_join.grouped(docs, block=block)).items()}
    assert got == components(pairs)
    assert len({c for _, c in got.values()}) < len(got) - 8


def test_jaccard_join_tells_rows_with_one_id_apart(spark):
    rng = random.Random(11)
    a, b = prose(rng, 60), prose(rng, 60)
    near = lambda t, k: " ".join(f"n{k}" if i == 59 else w for i, w in enumerate(t.split()))
    for rows in ([(5, a), (5, b), (1, near(a, 1)), (3, near(b, 2))], [(5, b), (5, a), (3, near(b, 2)), (1, near(a, 1))]):
        got = sorted(((r.doc_id, r.component_id) for r in jaccard_join.grouped(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()))
        assert got == [(1, 1), (3, 3), (5, 1), (5, 3)]
    rows = [(None, a), (1, near(a, 1)), (None, b), (None, near(b, 2)), (7, near(b, 3)), (None, a), (None, a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.component_id) for r in jaccard_join.grouped(docs).collect()) == [(0, 1)] * 3 + [(0, 7)] * 2 + [(1, 1), (7, 7)]
    assert sorted(r.doc_id for r in jaccard_join.representatives(docs).collect()) == [1, 7]


def test_jaccard_join_in_blocks_of_few_shingles(docs, pairs):
    signed = jaccard_join.signatures(common.id_and_bytes(docs))
    edges = jaccard_join.links(common.id_and_bytes(docs), signed, shingles=900)
    node = {r.doc_id: r.node for r in signed.collect()}
    root = {r.node: r.root for r in graph.components(edges).collect()}
    joined = defaultdict(set)
    for d, (n, c) in components(pairs).items():
        if n:
            joined[c].add(root.get(node[d], node[d]))
    assert all(len(x) == 1 for x in joined.values()) and len(set().union(*joined.values())) == len(joined)


def test_jaccard_join_of_nothing(none):
    assert jaccard_join.grouped(none).count() == 0


def test_linked_sets_share_a_cell():
    r = np.random.default_rng(5)
    linked = 0
    for t in range(3000):
        n = int(r.integers(1, 60)) if t % 2 else int(r.integers(1, 400))
        x = np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
        y = np.unique(np.concatenate((r.permutation(x)[int(r.integers(0, n // 5 + 1)) :], r.integers(0, 1 << 63, int(r.integers(0, n // 4 + 1)), dtype=np.uint64) * np.uint64(2))))
        both = len(np.intersect1d(x, y))
        if len(y) and 100 * both >= 80 * (len(x) + len(y) - both):
            linked += 1
            own = []
            for s in (x, y):
                largest = len(s) * 100 // 80
                own.append(set(np.concatenate([jaccard_join.cells(s, k, (len(s) + largest) * 20 // 180 + 1) for k in range(jaccard_join.level(len(s)), jaccard_join.level(largest) + 1)]).tolist()))
            assert own[0] & own[1]
    assert linked > 1000


def test_components_of_a_long_chain(spark):
    edges = spark.range(5000).selectExpr("id * 7919 % 5003 AS src", "(id + 1) * 7919 % 5003 AS dst")
    got = {r.node: r.root for r in graph.components(edges).collect()}
    assert len(got) == 5000 and set(got.values()) == {0}


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (None, 3)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {k: 100 for k in range(101, 130)}


# --- 5

def test_language_id(spark):
    rng = random.Random(1)
    stems = {"xx": ["ba", "be", "bo", "zu", "the"], "yy": ["ské", "ñor", "éle", "que", "dor"], "zz": ["при", "вет", "мир", "как"]}
    rows = [(i, " ".join("".join(rng.choice(stems[k]) for _ in range(3)) for _ in range(30)), k) for i, k in enumerate(rng.choice(sorted(stems)) for _ in range(300))]
    mixed = " ".join(rows[j][1] for j in (0, next(i for i, r in enumerate(rows) if r[2] != rows[0][2])))
    rows += [(900, None, "xx"), (901, "123 -- !!", "yy"), (902, "", None), (903, mixed, None), (904, "ба" * 40_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs, queries.remainder(3) != 1)
    got = by_id(language.predict(docs, model))
    assert sum(got[i].lang_pred == k for i, _, k in rows[:300]) >= 295
    assert [got[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and got[901].score == 0
    assert len(got[903].spans) == 2 and all(0 <= r.score <= 1 for r in got.values())
    assert language.keep_known(docs, model).count() == len(rows) - 3
    assert language.predict(docs.where("doc_id < 0"), model).count() == 0
    untaught = language.fit(docs.where("lang is null"), F.lit(True))
    assert {r.lang_pred for r in language.predict(docs, untaught).collect()} == {"und"}


def test_viterbi_against_a_plain_version():
    r = np.random.default_rng(8)
    langs, grams = ["aa", "bb", "cc"], r.normal(size=(3, language.BUCKETS)).astype(np.float32) - 8
    allowed = np.ones((language.SCRIPTS, 3), bool)
    allowed[3] = [False, False, True]
    model = language.Model(langs, grams, allowed)
    rng = random.Random(9)
    bodies = [" ".join(rng.choice(["one", "deux", "tres", "мир", "x", "longerword"]) for _ in range(rng.randrange(0, 25))).encode() for _ in range(30)] + [b"", b" \n "]
    labels, sizes, first, *_ = language.label(bodies, model, 3.0)
    for i, body in enumerate(bodies):
        words, scores = body.split(), []
        for w in words:
            around = b"  " + w + b" "
            own = [sum(float(grams[k][(around[j - 2] * 7919 + around[j - 1] * 263 + around[j] * 40009) % language.BUCKETS]) for j in range(2, len(around))) for k in range(3)]
            top = max(own)
            cyrillic = any(c in "мир" for c in w.decode())
            scores.append([x - top - (100 if cyrillic and k < 2 else 0) for k, x in enumerate(own)])
        value, back = [0.0] * 3, []
        for row in scores:
            step = [max(range(3), key=lambda a: value[a] - (3.0 if a != k else 0)) for k in range(3)]
            value = [value[a] - (3.0 if a != k else 0) + row[k] for k, a in enumerate(step)]
            back.append(step)
        total = max(value)
        got = labels[first[i] : first[i + 1]].tolist()
        assert len(got) == len(words) and sizes[first[i] : first[i + 1]].tolist() == [len(w) for w in words]
        told = sum(row[k] for row, k in zip(scores, got)) - 3.0 * sum(a != b for a, b in zip(got, got[1:]))
        assert abs(told - total) < 1e-3 * max(1, abs(total))


# --- 6

def places(text):
    words = re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text.translate(UPPER))
    found = defaultdict(list)
    for phrase, name in licenses.BASE.items():
        own = phrase.split()
        found[name] += [i for i in range(len(words)) if words[i : i + len(own)] == own]
    every = sorted(i for v in found.values() for i in v)
    return len(words), len(every), every[0] if every else None, every[-1] if every else None, ",".join(sorted(k for k, v in found.items() if v))


def test_license_scan(docs, pairs, none):
    got = by_id(licenses.scan(docs))
    for d, t in pairs.items():
        r = got[d]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == places(t), t[:60]
    apache = next(d for d, t in pairs.items() if "apache" in t)
    assert got[apache].labels == "apache-2.0" and 0.75 <= got[apache].score < 1
    assert licenses.scan(none).count() == 0


def test_repeated_words_do_not_vote_twice(spark):
    rows = ["MIT license, MIT license, MIT license", "cc by cc by cc by cc by cc by", "Released under the (new) MIT license.", "released under the released under the released under the", "under the mit license"]
    notice = next(t for t, label in licenses.TEMPLATES.items() if label == "isc").split()
    rows += [" ".join(notice[:10] + ["so"] + notice[10:20] + notice[22:]), " ".join(notice[: len(notice) // 2]), " ".join(notice[:12] + ["gap"] * 9 + notice[12:])]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = by_id(licenses.scan(docs))
    assert [got[i].labels for i in range(8)] == ["", "cc-by", "", "", "mit", "isc", "", ""] and got[4].score == 0.8
    import duckdb

    documents = docs.toPandas()  # noqa: F841
    told = duckdb.sql(licenses.oracle()).fetchall()
    assert sorted(told, key=lambda r: r[0]) == [tuple(got[i].asDict()[c] for c in docs_columns) for i in range(8)]


docs_columns = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def test_license_scan_is_native(docs):
    docs = common.saved(docs, "native")
    plan = docs.sparkSession._jvm.PythonSQLUtils.explainString(licenses.scan(docs)._jdf.queryExecution(), "formatted")
    assert not re.search("Python|Pandas|Arrow", plan)


# --- 7

@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact_groups(docs, pairs, keep):
    twice = docs.union(docs.where("doc_id % 2 = 0"))
    ids = [r.doc_id for r in twice.collect()]
    groups = defaultdict(list)
    for d in ids:
        groups[pairs[d]].append(d)
    chosen = min if keep == "smallest" else max
    got = sorted((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup.exact_groups(twice, keep).collect())
    assert got == sorted((d, chosen(g), len(g), d == chosen(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for d in g)


def test_trie_spills_by_subtree():
    rng = random.Random(3)
    many = [bytes(rng.choice(b"abc") for _ in range(rng.randrange(0, 40))) for _ in range(3000)]
    small, large = exact_dedup.Trie(min, 4000), exact_dedup.Trie(min)
    for i, t in enumerate(many):
        small.insert(t, i)
        large.insert(t, i)
    assert small.spilled
    assert sorted(small.owners()) == sorted(large.owners()) == sorted((t, many.index(t), many.count(t)) for t in set(many))


def test_trie_spills_below_a_long_common_prefix():
    rng = random.Random(4)
    for heads in ([b"<"], [b"<html><body>" * 30], [b"x" * 400, b"x" * 400 + b"y" * 400, b"z"], [b""]):
        many = [rng.choice(heads) + bytes(rng.choice(b"abc") for _ in range(rng.randrange(0, 60))) for _ in range(1500)] + [b"<", b"", b"x" * 9000]
        limit, trie = 20_000, exact_dedup.Trie(max, 20_000)
        most = 0
        for i, t in enumerate(many):
            trie.insert(t, i)
            most = max(most, sum(exact_dedup._held(c) for c in trie.root.children.values()))
        assert trie.spilled and most <= limit + 9300 + 2 * exact_dedup.NODE
        last = {t: i for i, t in enumerate(many)}
        assert sorted(trie.owners()) == sorted((t, i, many.count(t)) for t, i in last.items())


def test_exact_groups_of_nothing(none):
    assert exact_dedup.exact_groups(none).count() == 0


# --- 8

def test_quality(spark):
    rng = random.Random(2)
    rows = [(i, (prose(rng, 60) if i % 2 else " | ".join(prose(rng, 3).upper() + "!!" for _ in range(20)))) for i in range(400)] + [(500, None), (501, ""), (502, "x" * 200_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)] + [(3, None)], "doc_id long, quality int")
    got = by_id(quality.classify(docs, labels, queries.remainder(4) != 2))
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum((got[i].score >= 0.7) == bool(i % 2) for i in held) >= 0.95 * len(held)
    assert len(got) == 403 and all(0 <= r.score <= 1 for r in got.values())
    assert {r.score for r in quality.classify(docs, labels.where("quality > 5"), F.lit(True)).collect()} == {0.5}
    assert quality.classify(docs.where("doc_id < 0"), labels, F.lit(True)).count() == 0


def test_quality_fit_against_a_plain_ridge_and_isotonic_fit(spark):
    r = np.random.default_rng(10)
    x = r.normal(size=(500, quality.STATISTICS))
    y = (x[:, 0] + 0.5 * x[:, 3] ** 2 + r.normal(size=500) * 0.3 > 0.3).astype(float)
    train = spark.createDataFrame([(row.tolist(), float(v)) for row, v in zip(x, y)], "x array<double>, y double").repartition(3)
    model = quality.fit(train)
    assert np.allclose(model.mean, x.mean(axis=0)) and np.allclose(model.scale, x.std(axis=0))
    z = model.lift(x)
    system = z.T @ z + quality.RIDGE * len(x) / quality.FEATURES * np.eye(quality.FEATURES + 1)
    assert np.allclose(z @ model.beta, z @ np.linalg.solve(system, z.T @ y), atol=1e-6)
    bins = np.rint(model.raw(x) * quality.BINS).astype(int)
    # The isotonic fit at a bin is the greatest, over the bins up to it, of the least means of runs that begin there.
    values = np.unique(bins)
    total, count = np.array([y[bins == b].sum() for b in values]), np.array([(bins == b).sum() for b in values])
    for k in range(len(values)):
        best = max(min(total[i : j + 1].sum() / count[i : j + 1].sum() for j in range(k, len(values))) for i in range(k + 1))
        assert abs(np.interp(values[k] / quality.BINS, model.at, model.level) - best) < 1e-9


# --- 9

def test_packing(docs, pairs, none):
    rows = packing.pack(packing.pieces(docs, WORDS)).collect()
    library = bpe.WordCodec.of(WORDS).library
    owned, filled = defaultdict(list), defaultdict(list)
    for r in rows:
        owned[r.doc_id].append(r)
        filled[r.sequence_id].append(r)
    for d, t in pairs.items():
        ids = np.array(library.encode(t, add_special_tokens=False).ids + [1], "<u4")
        own = sorted(owned[d], key=lambda r: r.piece)
        assert [(r.piece, r.start, r.length, r.ids_crc32) for r in own] == [(k, at, len(ids[at : at + 4096]), zlib.crc32(ids[at : at + 4096])) for k, at in enumerate(range(0, len(ids), 4096))]
    total = 0
    for own in filled.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096
        total += at
    assert len(filled) <= total / 4096 + 2
    assert packing.pack(packing.pieces(none, WORDS)).count() == 0


def test_two_that_fit_better_take_the_smallest_piece_s_place():
    bins, offsets, n = packing.best_two_fit(np.array([60, 30, 22, 18]), 100)
    assert n == 2 and sorted(np.bincount(bins, weights=[60, 30, 22, 18]).tolist()) == [30, 100]
    r = np.random.default_rng(0)
    lengths = r.integers(1, 101, 2000)
    bins, _, n = packing.best_two_fit(lengths, 100)
    assert np.bincount(bins, weights=lengths).max() <= 100 and n <= lengths.sum() / 100 * 1.04 + 1


def test_the_best_pair_is_found_at_every_size():
    lengths = np.array([3491, *range(100, 601)])  # 3491 and 600 leave 5; 505 and 100 fill 605, far below the largest lengths
    bins, _, _ = packing.best_two_fit(lengths, 4096)
    assert np.bincount(bins, weights=lengths)[0] == 4096
    r = np.random.default_rng(1)
    for low, high, n in ((100, 1000, 300), (1, 1000, 200), (5, 300, 400), (300, 500, 50)):
        lengths = r.integers(low, high, n)
        bins, _, _ = packing.best_two_fit(lengths, 1000)
        left, k = sorted(lengths.tolist()), 0
        while left:
            content = []
            while fit := [x for x in left if x <= 1000 - sum(content)]:
                content.append(fit[-1])
                left.remove(fit[-1])
            total, gap = sum(content), 1000 - sum(content) + content[-1]
            best = max((a + left[i] for i in range(len(left)) for a in left[:i] if a + left[i] <= gap), default=0)
            own = lengths[bins == k]
            assert own.sum() == total - content[-1] + max(content[-1], best)
            left = sorted(left + content)
            for x in own.tolist():
                left.remove(x)
            k += 1


# --- 10

def test_range_coder_round_trip():
    r = np.random.default_rng(4)
    for ids, lengths in ((r.integers(0, 49408, 5000), [2048, 1, 951, 2000]), (np.full(3000, 7), [3000]), (np.tile([1, 2, 3, 49407, 0], 400), [1000, 1000]), (np.array([0]), [1]), (r.integers(0, 300, 3000), [2] * 1500)):
        blocks = token_files.encode_blocks(ids, np.array(lengths))
        assert token_files.decode_blocks(blocks, np.array(lengths)).tolist() == ids.tolist()
    assert len(token_files.encode_blocks(np.full(3000, 7), np.array([3000]))[0]) < 300


def test_a_block_is_foretold_as_step_by_step():
    r = np.random.default_rng(6)
    runs = np.repeat(r.integers(0, 9, 3000), r.choice([1, 2, 6, 6, 6, 7, 8], 3000))[: 7 * 900]  # misses after 5 hits tell of those before
    for ids in (runs.reshape(7, 900), r.integers(0, 3, (5, 1300)), np.full((2, 40), 65534)):
        ids = ids.astype(np.uint16)
        slots = r.integers(0, 4, ids.shape).astype(np.int32)
        expected = []
        for own, slot in zip(ids.tolist(), slots.tolist(), strict=True):
            state = {}
            for i, s in zip(own, slot, strict=True):
                guess, level = state.get(s, (token_files.NOTHING, 0))
                expected.append(guess << 4 | (guess == i) << 3 | level)
                state[s] = i, int(token_files.MOVE[level + 8 * (guess == i)])
        assert token_files._foretold(ids, slots).reshape(-1).tolist() == expected


def test_a_coded_block_ends_with_its_ids_and_loses_nothing_to_carries():
    r = np.random.default_rng(7)
    size = lambda ids: len(token_files.encode_blocks(ids, np.array([len(ids)]))[0])
    assert size(np.full(4000, 7)) <= 31 and size(np.array([5, 5, 5, 5])) <= 7
    ids = np.minimum(r.zipf(1.3, 1 << 17), 49407)
    lengths = np.full(64, 2048)
    blocks = token_files.encode_blocks(ids, lengths)
    assert token_files.decode_blocks(blocks, lengths).tolist() == ids.tolist()
    assert 8 * sum(map(len, blocks)) / len(ids) < 7.28
    assert token_files.decode_blocks([b[:-40] + b[-2:] for b in blocks], lengths).tolist() != ids.tolist()  # a damaged block is no crash


def test_crc_of_two_parts():
    for a, b in ((b"hello", b"world12345"), (b"", b"x"), (b"abc", b""), (b"q" * 1000, b"z" * 77777)):
        assert token_files.crc_combine(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def test_token_files(docs, pairs, none):
    blocks = token_files.write_tokens(docs, WORDS, block=700)
    got = by_id(token_files.index_tokens(blocks))
    library, start = bpe.WordCodec.of(WORDS).library, 0
    for d in sorted(pairs):
        ids = np.array(library.encode(pairs[d], add_special_tokens=False).ids + [2], "<u4")
        assert (got[d].start, got[d].n_tokens, got[d].ids_crc32) == (start, len(ids), zlib.crc32(ids))
        start += len(ids)
    assert sum(len(r.ids) for r in token_files.read_tokens(blocks).collect()) == start
    assert token_files.index_tokens(token_files.write_tokens(none, WORDS)).count() == 0


def test_token_files_keep_rows_apart(spark):
    rows = [(1, "first text of one id"), (1, "second text, longer than the first one"), (1, "first text of one id"), (None, "no id"), (None, None), (0, "zero " * 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in token_files.index_tokens(token_files.write_tokens(docs, WORDS, block=64)).collect()]
    library = bpe.WordCodec.of(WORDS).library
    expected = []
    for d, t in rows:
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        expected.append((d, len(ids), zlib.crc32(ids)))
    assert sorted(((d, n, c) for d, _, n, c in got), key=str) == sorted(expected, key=str)
    at = 0
    for d, start, n, _ in sorted(got, key=lambda r: r[1]):
        assert start == at
        at += n
    assert [d for d, *_ in sorted(got, key=lambda r: r[1])] == [None, None, 0, 1, 1, 1]


def test_the_mixture_shortens_what_can_be_foretold_and_nothing_grows():
    r = np.random.default_rng(5)
    bits = lambda ids, n: 8 * sum(map(len, token_files.encode_blocks(ids, np.full(len(ids) // n, n)))) / len(ids)
    assert bits(r.integers(0, 49408, 16384), 2048) <= 16 + 8 / 2048
    assert bits(r.integers(0, 1 << 31, 4096), 2048) <= 32 + 8 / 2048
    order0 = np.minimum(r.zipf(1.5, 1 << 16), 40000) + 5
    share = np.bincount(order0) / len(order0)
    entropy = -sum(p * np.log2(p) for p in share if p)
    assert entropy < bits(order0, 2048) < entropy + 1.6
    again = np.tile(r.integers(0, 49408, 97), 400)[: 1 << 15]
    assert bits(again, 2048) < 97 * 16 / 2048 + 0.4
    with pytest.raises(ValueError, match="at the most"):
        token_files.encode_blocks(np.zeros(5000, int), np.array([5000]))


def test_a_damaged_block_is_noticed(docs):
    blocks = token_files.write_tokens(docs.where("doc_id < 8"), WORDS)
    with pytest.raises(Exception, match="checksum"):
        token_files.index_tokens(blocks.withColumn("crc32", F.col("crc32") + 1)).collect()


# --- rows without ids

def test_null_ids_do_no_harm(spark):
    docs = spark.createDataFrame([(None, "some words to read here", "en"), (1, "some words to read here", "en"), (2, None, None)], "doc_id long, text string, lang string")
    assert exact_dedup.exact_groups(docs).count() == 3
    assert jaccard_join.grouped(docs).count() == 3
    assert substring_dedup.cleaned(docs).count() == 3
    assert licenses.scan(docs).count() == 3
    assert media.features(media.to_media(docs)).count() == 3
    assert packing.pack(packing.pieces(docs, WORDS)).count() == 3
    assert token_files.write_tokens(docs, WORDS).selectExpr("sum(tokens) n").first().n > 3
    assert bpe.round_trip(docs, BYTES, P.PATTERN).count() == 3
    model = language.fit(docs, F.lit(True))
    assert language.predict(docs, model).count() == 3 and language.keep_known(docs, model).count() == 2
    assert quality.classify(docs, spark.createDataFrame([(1, 1), (None, 0)], "doc_id long, quality int"), F.lit(True)).count() == 3


def test_scores_do_not_depend_on_the_rows_beside():
    r = np.random.default_rng(8)
    model = quality.Classifier(np.zeros(quality.STATISTICS), np.ones(quality.STATISTICS))
    model.beta = r.normal(size=quality.FEATURES + 1) / 16
    x = r.normal(size=(150, quality.STATISTICS))
    whole = model.raw(x)
    assert 0.1 < np.mean((whole > 0) & (whole < 1))
    for n in (1, 2, 3, 7, 64, 65, 149):
        for k in range(0, len(x) - n + 1, max(1, n // 3)):
            assert model.raw(x[k : k + n]).tolist() == whole[k : k + n].tolist()


def test_clashing_columns_and_repeated_rows_in_op5_and_op8(docs):
    twice = docs.unionByName(docs).withColumns({"lang_pred": F.lit(1), "score": F.lit("x"), "spans": F.lit(2), "x": F.lit(3), "y": F.lit(4), "quality": F.lit(5)})
    model = language.fit(twice, F.lit(True))
    rows = [(r.doc_id, r.lang_pred, r.score) for r in language.predict(twice, model).collect()]
    assert len(rows) == 2 * docs.count() and all(rows.count(r) == 2 for r in rows)
    assert language.keep_known(twice, model).columns == twice.columns
    labels = twice.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"), F.lit(1).alias("x"), F.lit(1).alias("text"))
    scores = [(r.doc_id, r.score) for r in quality.classify(twice, labels, F.lit(True)).collect()]
    assert len(scores) == 2 * docs.count() and all(scores.count(r) == 2 for r in scores)
