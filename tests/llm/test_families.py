"""Families of near duplicates in texts that share common lines."""

import random
from collections import Counter

import numpy as np

from hearken.llm import common, jaccard_join


def test_common_lines_chain_no_family_of_op4(spark):
    """Texts that share half of their lines with others, below the threshold, were one family; links stay the same."""
    rng = random.Random(44)
    lines = [" ".join(f"c{rng.randrange(9999)}" for _ in range(12)) for _ in range(14)]
    texts = []
    for i in range(300):
        own = [" ".join(f"u{i}x{k}y{j}" for j in range(12)) for k in range(6)] + rng.sample(lines, 7)
        rng.shuffle(own)
        texts.append("\n".join(own))
    near = texts[7].replace("u7x2y3", "changed")
    docs = spark.createDataFrame([*enumerate(texts), (300, near)], "doc_id long, text string")
    base = common.id_and_bytes(docs)
    shared = jaccard_join.common_shingles(base, jaccard_join.signatures(base))
    assert len(shared) >= 14 * 8

    def largest(edges):
        root = {}

        def find(x):
            while root.setdefault(x, x) != x:
                x = root[x]
            return x

        for r in edges.collect():
            root[find(r.node)] = find(r.first)
        return max(Counter(map(find, list(root))).values())

    assert largest(jaccard_join.stars(base)) > 200 and largest(jaccard_join.stars(base, common=shared)) < 5
    told = {r.doc_id: r.component_id for r in jaccard_join.grouped(docs).collect()}
    assert told == {i: i for i in range(300)} | {300: 7}


def test_linked_sets_share_a_cell_whatever_is_common():
    r = np.random.default_rng(6)
    linked = 0
    for t in range(2000):
        n = int(r.integers(1, 60)) if t % 2 else int(r.integers(1, 400))
        x = np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
        y = np.unique(np.concatenate((r.permutation(x)[int(r.integers(0, n // 5 + 1)) :], r.integers(0, 1 << 63, int(r.integers(0, n // 4 + 1)), dtype=np.uint64) * np.uint64(2))))
        both = len(np.intersect1d(x, y))
        if len(y) and 100 * both >= 80 * (len(x) + len(y) - both):
            linked += 1
            shared = np.sort(r.permutation(np.union1d(x, y))[: int(r.integers(0, n + 1))])
            own = []
            for s in (x, y):
                largest = len(s) * 100 // 80
                most, rare = (len(s) + largest) * 20 // 180 + 1, jaccard_join.is_rare(s, shared)
                assert rare.tolist() == (~np.isin(s, shared)).tolist()
                own.append(set(np.concatenate([jaccard_join.cells(s, k, most, rare) for k in range(jaccard_join.level(len(s)), jaccard_join.level(largest) + 1)]).tolist()))
            assert own[0] & own[1]
    assert linked > 500
