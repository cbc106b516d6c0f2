"""Exact and near dedup: edge cases, brute force, and the merge of filters."""

import random
from collections import defaultdict

import numpy as np

from vecshelf.llm import exact_dedup, near_dedup
from vecshelf.llm.components import components

DOCS = "doc_id long, text string, keep_id string, print long"


def test_exact_edges(spark):
    rows = [
        (5, "a  b", "x", 1), (3, "a\tb", None, None), (7, None, "x", 2), (8, "", "x", 3), (9, " ", "x", 4),
        (None, "a b", "x", 5), (None, "q", None, 6), (4, "A b", "x", 7), (11, "dup", "x", 8), (11, "dup", "x", 8),
    ]
    docs = spark.createDataFrame(rows, DOCS)
    found = sorted((r.doc_id or -1, r.keep_id or -1, r.group_size, r.kept) for r in exact_dedup.exact_groups(docs).collect())
    assert found == [
        (-1, -1, 1, True), (-1, 3, 3, False), (3, 3, 3, True), (4, 4, 1, True), (5, 3, 3, False),
        (7, 7, 2, True), (8, 7, 2, False), (9, 9, 1, True), (11, 11, 2, True), (11, 11, 2, True),
    ]
    left = exact_dedup.deduplicate(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in left.collect()) == [-1, 3, 4, 7, 9, 11]
    assert exact_dedup.exact_groups(docs.limit(0)).count() == 0
    assert exact_dedup.deduplicate(docs.limit(0)).count() == 0


def test_filters_merge_without_loss():
    rng = np.random.default_rng(1)
    low = 60
    parts = []
    for _ in range(3):
        values, counts = np.unique(rng.integers(0, 5000, 3000, dtype=np.uint64) * np.uint64(1 << 46), return_counts=True)
        parts.append((values, counts))
    read = [exact_dedup.read_filter(0, *exact_dedup.build_filter(v, c, low), low) for v, c in parts]
    for (v, c), (rv, rc) in zip(parts, read):
        assert (v == rv).all() and (c == rc).all()
    merged = dict(zip(*map(list, exact_dedup.merge_counts([r[0] for r in read], [r[1] for r in read]))))
    want = defaultdict(int)
    for v, c in parts:
        for a, b in zip(v, c):
            want[a] += b
    assert merged == dict(want)


def test_repeated_fingerprints(spark):
    values = [1, -5, 2**62, -(2**63), 1, -(2**63), 1, 7]
    df = spark.createDataFrame([(v,) for v in values], "p long").repartition(3)
    assert sorted(map(tuple, exact_dedup.repeated_fingerprints(df, 8).collect())) == [(-(2**63), 2), (1, 3)]


def closure(links, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)]
    links += [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)] + [(400, 400)]
    df = spark.createDataFrame([*links, (None, 3)], "a long, b long")
    nodes = {n for a, b in links if a != b for n in (a, b)}
    want = closure([x for x in links if x[0] != x[1]], nodes)
    assert {r.node: r.component for r in components(df).collect()} == want
    assert components(df.limit(0)).count() == 0


def shingles(text, k):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} or ({tuple(words)} if words else set())


def test_near_against_brute_force(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    texts = {}
    for base in range(25):
        text = [rng.choice(words) for _ in range(rng.randrange(20, 120))]
        for _ in range(rng.choice([1, 2, 3, 12])):
            copy = list(text)
            for _ in range(rng.randrange(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts[len(texts)] = " ".join(copy)
    texts |= {900: None, 901: "", 902: " \t\n", 903: "One two", 904: "one  TWO", 905: "two one", 906: "x " * 30_000}
    texts |= {907: "ÀB c d e", 908: "àb c d e", 909: texts[0].upper()}
    rows = [(i, t, 0, "n") for i, t in texts.items()] + [(None, texts[0], 0, "n"), (3, texts[3], 0, "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rid long, node string")
    sets = {i: shingles(t, 4) for i, t in texts.items()}
    links = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    want = closure(links, sets)
    found = near_dedup.near_groups(docs, words=4).collect()
    assert len(found) == len(rows)
    for r in found:
        if r.doc_id is None:
            assert (r.component_id, r.kept) == (None, True)
        else:
            assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), want[r.doc_id]), r
            assert r.kept == (r.doc_id == r.component_id)
    assert near_dedup.near_groups(docs.limit(0)).count() == 0
    left = near_dedup.without_near_copies(docs, words=4)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {i for i in texts if want[i] == i} | {None}


def test_copies_of_one_original_that_are_unlike_each_other(spark):
    """Each of many copies is linked with the original only, which is not the smallest id."""
    rng = random.Random(11)
    base = [f"w{rng.randrange(5000)}" for _ in range(200)]
    texts = {500: " ".join(base)}
    for i in range(400):
        copy = list(base)
        for k in range(5):  # each changed word breaks four shingles
            copy[rng.randrange(40) + 40 * k] = f"x{i}_{k}"
        texts[i if i < 500 else i + 1] = " ".join(copy)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    sets = {i: shingles(t, 4) for i, t in texts.items()}
    links = [(500, i) for i in texts if i != 500 and 100 * len(sets[i] & sets[500]) >= 80 * len(sets[i] | sets[500])]
    links += [(a, b) for a in texts for b in texts if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = closure(links, texts)
    assert sum(w == want[500] for w in want.values()) > 350
    assert {r.doc_id: r.component_id for r in near_dedup.near_groups(docs, words=4).collect()} == want
