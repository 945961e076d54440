import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordloom.llm import common, substring_dedup as sd

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, k):
    """Rows of (id, text) in order; equal rows count once. The words that stay."""
    seen, out = set(), {}
    for id_, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        words = WORD.findall(text or "")
        gone = set()
        for i in range(len(words) - k + 1):
            window = tuple(words[i:i + k])
            if window in seen:
                gone |= set(range(i, i + k))
            seen.add(window)
        out[id_, text] = [w for i, w in enumerate(words) if i not in gone], len(words)
    return out


def same(got, want):
    assert len(got) > 0
    for r, (id_, text) in got:
        kept, n = want[id_, text]
        assert (r.n_words, r.n_removed) == (n, n - len(kept)), (id_, text)
        assert r.kept == " ".join(kept)
        assert r.kept_sha256 == hashlib.sha256(r.kept.encode()).hexdigest()
        words = WORD.findall(text or "")
        cut = {i for s in r.spans for i in range(s.start, s.end)}
        assert [w for i, w in enumerate(words) if i not in cut] == kept


@pytest.mark.parametrize("k,letters,seed", [(1, 5, 1), (3, 2, 2), (4, 3, 3), (8, 2, 4), (20, 1, 5), (20, 2, 6)])
def test_random_texts(table_of, k, letters, seed):
    rng = random.Random(seed)
    base = [[rng.choice("abcdefg"[:letters]) for _ in range(rng.randint(0, 60))] for _ in range(20)]
    texts = []
    for _ in range(60):
        a, b = rng.choice(base), rng.choice(base)
        texts.append(rng.choice([" ", "\n", "  \t"]).join(a[:rng.randint(0, 60)] + b[rng.randint(0, 30):]))
    got = sd.remove_repeats(table_of(texts), k).collect()
    assert len(got) == len(texts)
    same([(r, (r.doc_id, texts[r.doc_id])) for r in got], brute(list(enumerate(texts)), k))


def test_hot_passage_with_many_surroundings(table_of):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    passage = " ".join(word() for _ in range(40))
    texts = [" ".join([word() for _ in range(rng.randint(5, 25))] + [passage] + [word() for _ in range(rng.randint(5, 25))]) for _ in range(300)]
    got = sd.remove_repeats(table_of(texts), 20).collect()
    same([(r, (r.doc_id, texts[r.doc_id])) for r in got], brute(list(enumerate(texts)), 20))


def test_odd_rows(odd, odd_rows, none):
    got = sd.remove_repeats(odd, 3).collect()
    assert len(got) == len(odd_rows)
    rows = [(r[0], r[1]) for r in odd_rows]
    want = brute(rows, 3)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r)
    for id_ in (1, 2, 3, 4, 5, 6, 7):
        same([(r, (id_, next(t for i, t in rows if i == id_))) for r in by_id[id_]], want)
    assert sorted(r.n_words for r in by_id[None]) == [0, 8] and len(by_id[1]) == 2
    assert all(r.n_removed == 0 for r in by_id[None])  # null ids come first
    assert sd.remove_repeats(none).collect() == []


def test_texts_that_share_an_id(spark):
    rows = [(1, "a b c d", None, None, None, None, None), (1, "x a b c", None, None, None, None, None)]
    got = sd.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string, a int, b int, c int, d int, e int"), 3).collect()
    assert sorted(r.n_removed for r in got) == [0, 3]


def test_hash_of_ids_is_sparks(spark):
    ids = [0, 1, -1, 5, 2 ** 62, -(1 << 63)]
    df = spark.createDataFrame([(i,) for i in ids], "i bigint").select("i", F.xxhash64("i").alias("h"))
    got = dict(df.collect())
    assert [got[i] for i in ids] == list(common.xxhash_long(np.array(ids, np.int64)))


def thue_morse(letters):
    """2,048 letters; with the letters exchanged, polynomial hashes modulo 2^64 are the same for any multiplier."""
    return "".join(letters[bin(i).count("1") % 2] for i in range(2048))


def test_equal_hashes_of_different_words_remove_nothing(table_of):
    a, b = thue_morse("ab"), thue_morse("ba")
    words = common.Words([a.encode(), b.encode()])
    for seed in (0, 1):
        one, other = words.run(np.array([0, 1]), np.array([1, 2]), seed)
        assert one == other
    texts = [f"x {a} y", f"x {b} y", f"x {b} y", f"q x {b} y z", f"x {a} y", f"n {b} n"]
    got = sd.remove_repeats(table_of(texts), 3).collect()
    same([(r, (r.doc_id, texts[r.doc_id])) for r in got], brute(list(enumerate(texts)), 3))
    assert [r.n_removed for r in sorted(got, key=lambda r: r.doc_id)] == [0, 0, 3, 3, 3, 0]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_texts_with_equal_hashes(table_of, seed):
    rng = random.Random(seed)
    letters = [thue_morse("ab"), thue_morse("ba"), "c", "d"]
    texts = [" ".join(rng.choice(letters) for _ in range(rng.randint(0, 14))) for _ in range(40)]
    got = sd.remove_repeats(table_of(texts), 4).collect()
    assert len(got) == len(texts)
    same([(r, (r.doc_id, texts[r.doc_id])) for r in got], brute(list(enumerate(texts)), 4))


def test_spans_merge_on_their_diagonal_only():
    begin, end = np.array([0, 2, 10, 3]), np.array([5, 7, 14, 6])
    src, place = np.array([1, 1, 1, 2]), np.array([100, 102, 110, 50])
    got = [tuple(map(int, r)) for r in zip(*sd._spans(begin, end, src, place))]
    assert got == [(0, 7, 1, 100), (10, 4, 1, 110), (3, 3, 2, 50)]
