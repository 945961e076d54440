import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordloom.llm import near_dedup as nd
from wordloom.llm.components import components


def classes(texts, sketch, n=5, least=0.8, strength=0.25):
    """Components of all pairs, compared one by one."""
    weights = nd.Weights(sketch, len(texts), strength)
    bags = []
    for t in texts:
        _, h, tf = nd.shingles([(t or "").encode()], n)
        bags.append((h, weights.of(h, tf)))
    root = list(range(len(texts)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    border = set()
    for i in range(len(texts)):
        for j in range(i):
            if len(bags[i][0]) and len(bags[j][0]):
                s = nd.similarity(bags[i], bags[j])
                if s >= least:
                    root[max(find(i), find(j))] = min(find(i), find(j))
                if least <= s < least + 0.03:
                    border |= {i, j}
    return [find(i) for i in range(len(texts))], border


def test_against_brute_force(table_of):
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(40):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([6, 60, 150]))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 6)):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    df = table_of(texts)
    got = {r.doc_id: r.class_id for r in nd.near_groups(df).collect()}
    want, border = classes(texts, nd.document_frequencies(df, 5))
    wrong = {i for i in range(len(texts)) if got[i] != want[i]}
    assert wrong <= border, wrong - border
    assert len(wrong) <= 2


def test_a_star_and_its_copies(table_of):
    rng = random.Random(12)
    base = [f"w{rng.randrange(10_000)}" for _ in range(120)]
    texts = []
    for i in range(150):
        copy = list(base)
        for at in rng.sample(range(120), 2):
            copy[at] = f"x{i}-{at}"
        texts.append(" ".join(copy))
    texts.append(" ".join(base))
    texts += ["  ".join(base)] * 5
    out = nd.near_groups(table_of(texts)).collect()
    assert {r.class_id for r in out} == {0} and {r.class_size for r in out} == {156}
    assert [r.doc_id for r in out if r.kept] == [0]


def test_large_buckets_lose_no_pair(table_of, monkeypatch):
    """Pairs inside one template: many share only a band that most other texts have too."""
    rng = random.Random(13)
    words = lambda n: [f"w{rng.randrange(10 ** 9)}" for _ in range(n)]
    template, texts = words(78), []
    for _ in range(80):
        both = words(14)
        texts += [" ".join(template + both + words(8)) for _ in range(2)]
    df = table_of(texts)
    want = {r.doc_id: r.class_id for r in nd.near_groups(df).collect()}
    assert len(set(want.values())) < 85
    monkeypatch.setattr(nd, "_BLOCK", 3)
    assert {r.doc_id: r.class_id for r in nd.near_groups(df).collect()} == want


def test_all_that_must_meet_meet_in_bounded_buckets(spark):
    rows = [(5, i, 0 if i % 4 else i, [i], 200) for i in range(200)] + [(6, i, i, [i], 3) for i in range(3)]
    made = nd._meetings(spark.createDataFrame(rows, "bucket bigint, node int, root int, sample array<int>, n int"), 40).collect()
    held = defaultdict(set)
    for r in made:
        held[r.bucket].add((r.node, r.root))
    assert max(map(len, held.values())) < 80
    met = {(a, b) for rows in held.values() for a, _ in rows for b, _ in rows}
    roots = {i: 0 if i % 4 else i for i in range(200)}
    assert all((a, b) in met for a in range(200) for b in range(200) if roots[a] != roots[b])


def test_samples_agree_as_often_as_the_similarity():
    rng = np.random.default_rng(3)
    keys = np.sort(rng.integers(0, 1 << 62, 3000).astype(np.uint64))
    agree, expect = [], []
    for _ in range(60):
        a, b = rng.random(3000) < 0.5, rng.random(3000) < 0.5
        b[:2000] = a[:2000]
        w = rng.uniform(1, 3, 3000).astype(np.float32)
        keys = np.sort(rng.integers(0, 1 << 62, 3000).astype(np.uint64))
        x, y = (nd.samples(np.zeros(m.sum(), np.int64), keys[m], w[m], 1)[0] for m in (a, b))
        agree.append((x == y).mean())
        expect.append(nd.similarity((keys[a], w[a]), (keys[b], w[b])))
    assert abs(np.mean(agree) - np.mean(expect)) < 0.04


def test_shingles():
    text, hashes, tf = nd.shingles([b"a b c d e f", b"", b"a b", b"x x x x x x x"], 5)
    assert list(text) == [0, 0, 2, 3] and list(tf) == [1, 1, 1, 3]


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 90), (90, 95)] + [(200, i) for i in range(201, 260)]
    got = dict(components(spark.createDataFrame(edges, "a int, b int")).collect())
    assert all(got[i] == 0 for i in range(31)) and {got[90], got[95], got[100]} == {90}
    assert all(got[i] == 200 for i in range(200, 260)) and len(got) == 31 + 3 + 60
    assert components(spark.createDataFrame([], "a int, b int")).collect() == []


def test_odd_rows(odd, odd_rows, none):
    got = nd.near_groups(odd).collect()
    assert len(got) == len(odd_rows)
    assert sum(r.kept for r in got) == len({r.class_id for r in got}) == 5
    same = [r for r in got if r.class_size == 4]
    assert {r.doc_id for r in same} == {1, 2, None} and {r.class_id for r in same} == {1}
    blank = [r for r in got if r.doc_id in (3, 4)]
    assert {r.class_id for r in blank} == {3}
    left = nd.drop_near_copies(odd)
    rows = [tuple(r) for r in left.collect()]
    assert left.columns == odd.columns and set(rows) <= set(odd_rows)
    assert sorted(r[0] for r in rows) == [1, 3, 5, 6, 7]
    assert nd.near_groups(none).collect() == [] and nd.drop_near_copies(none).collect() == []
