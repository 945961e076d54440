import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from wordloom.llm import lm


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + [None]


def scored(df, training, **more):
    return lm.score_texts(df, training, bits=1 << 18, **more).collect()


def test_base_and_model_against_brute_force(table_of):
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["the", "The", "cat", "sat", "É", "on", f"w{rng.randint(0, 50)}"]) for _ in range(rng.randint(0, 40)))
             for _ in range(300)]
    got = {r.doc_id: r for r in scored(table_of(texts), F.col("doc_id") % 3 != 2)}
    train = [tokens(t) for i, t in enumerate(texts) if i % 3 != 2]
    one, two = Counter(x for t in train for x in t), Counter(p for t in train for p in zip([None] + t[:-1], t))
    n, v = sum(one.values()), len(one)
    for i, text in enumerate(texts):
        r, t = got[i], tokens(text)
        assert (r.n_tokens, r.n_known, r.train_tokens, r.is_training) == (len(t), sum(one[x] > 0 for x in t), n, i % 3 != 2)
        assert math.isclose(r.base_score, sum(math.log10((one[x] + 1) / (n + v + 1)) for x in t), rel_tol=1e-9)
        want = 0.0
        for u, x in zip([None] + t[:-1], t):
            c = two[u, x]
            joint = min(2 * 2 ** int(math.log2(c / 2)), one[u]) if c >= 2 else 0
            p = (one[x] + 1) / (n + v + 1)
            want += math.log10(0.5 * p + 0.5 * joint / one[u] if one[u] else p)
        assert abs(r.score - want) < 0.02 * abs(want) + 1e-9  # but for the filter's false positives


def test_better_than_unigrams_where_words_follow_each_other(table_of):
    rng = random.Random(8)
    texts = [" ".join(f"{a} {a}{a}" for a in rng.choices("abcdefghij", k=30)) for _ in range(200)]
    held = [r for r in scored(table_of(texts), F.col("doc_id") % 3 != 2) if not r.is_training]
    assert sum(r.score for r in held) > 0.8 * sum(r.base_score for r in held)


def test_filter_never_forgets():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 62, 5000).astype(np.uint64)
    counts = rng.integers(2, 500, 5000)
    bits, buckets, hashes = 1 << 16, 16, 5
    data = np.zeros((buckets, bits // 8), np.uint8)
    at = lm.bucket_of(keys, buckets)
    for b in range(buckets):
        batch = lm.batch(lm._MERGED, [(1, b, lm.planes(keys[at == b]), lm.planes(counts[at == b]), 0, 0, [])])
        [out] = lm._segment(2, hashes, bits)(iter([batch]))
        data[b] = np.frombuffer(out.column("data")[0].as_py(), np.uint8)
    made = lm.LogFrequencyFilter(data, bits, hashes, 2)
    level = made.level(keys)
    assert (level >= lm.levels(counts, 2)).all()
    assert (level == lm.levels(counts, 2)).mean() > 0.9
    others = rng.integers(0, 1 << 62, 5000).astype(np.uint64)
    assert (made.level(others) > 0).mean() < 0.05


def test_levels():
    assert list(lm.levels(np.array([1, 2, 3, 4, 7, 8, 16]), 2)) == [0, 1, 1, 2, 2, 3, 4]


def test_seen_successors_have_no_more_than_all_probability(table_of):
    rng = random.Random(6)
    texts = [" ".join(f"w{min(int(rng.paretovariate(0.7)), 80)}" for _ in range(60)) for _ in range(50)] + [f"x y{i}" for i in range(100)]
    two = Counter(p for x in texts for t in [tokens(x)] for p in zip([None] + t[:-1], t))
    one = Counter(x for t in texts for x in tokens(t))
    for least in (1, 2):
        counts = np.array(list(two.values()))
        quantised = lm.least_count(lm.levels(counts, least), least)
        mass: Counter = Counter()
        for (u, _), q in zip(two, quantised):
            mass[u] += q
        assert all(mass[u] <= one[u] for u in mass) and (quantised <= counts).all()
    assert mass["x"] == 0.0 and (lm.least_count(lm.levels(np.array([1]), 1), 1) == 1).all()


def test_every_bigram_counts_however_many(table_of):
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(60)}" for _ in range(100)) for _ in range(40)]
    two = Counter(p for x in texts for t in [tokens(x)] for p in zip([None] + t[:-1], t))
    one = Counter(x for t in texts for x in tokens(t))
    n, v = sum(one.values()), len(one)
    assert len(two) * 5 / math.log(2) > 4 * (1 << 12) and min(two.values()) == 1
    few, many = ({r.doc_id: r.score for r in lm.score_texts(
        table_of(texts), F.lit(True), bits=bits, buckets=16, least=1).collect()} for bits in (1 << 12, 1 << 20))
    for i, text in enumerate(texts):
        want = 0.0
        for u, x in zip([None] + tokens(text)[:-1], tokens(text)):
            joint = min(2 ** int(math.log2(two[u, x])), one[u])
            want += math.log10(0.5 * (one[x] + 1) / (n + v + 1) + 0.5 * joint / one[u])
        assert math.isclose(many[i], want, rel_tol=1e-3)
        assert want - 1e-9 <= few[i] <= want + 0.02 * abs(want)  # no level is lost; false positives only add


def test_the_filter_follows_the_levels():
    keys, counts = np.arange(3, dtype=np.uint64), np.array([1, 1, 5])
    rows = [(lm.BIGRAM, 0, -1, lm.planes(keys), lm.planes(counts))] * 2
    [merged] = lm._merge(iter([lm.batch(lm._COUNTS, rows[:1])]), 1)
    assert merged.column("levels").to_pylist() == [[3, 1, 1]]
    [made] = lm._build(1, 5, 0)(iter([lm.batch(lm._COUNTS, rows)]))
    assert 8 * len(made.column("keys")[0].as_py()) == math.ceil(sum([3, 3, 1, 1]) * 5 / math.log(2) / 8) * 8


def test_odd_rows(odd, odd_rows, none):
    got = scored(odd, F.col("doc_id") < 5)
    assert len(got) == len(odd_rows) and all(math.isfinite(r.score) for r in got)
    assert sum(r.doc_id is None for r in got) == 2 and not any(r.is_training for r in got if r.doc_id is None)
    assert all(r.n_tokens == 1 for r in got if r.doc_id in (3, 4, 5))
    nothing = scored(odd, F.lit(False))
    assert all(r.n_known == 0 and r.train_tokens == 0 and r.score == 0.0 for r in nothing)
    assert scored(none, F.lit(True)) == []
