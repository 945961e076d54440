"""Small numeric kernels against brute force."""

import math
import random
import re

import numpy as np
import pytest

from wordloom.functions.kernels import edit_fraction, levenshtein, spaced_distance
from wordloom.operators.subword.merging import apply_merges, pack_merges
from wordloom.operators.subword.unigram import best_path, digamma, expected_counts


def slow_levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_levenshtein():
    rng = random.Random(1)
    for _ in range(400):
        a, b = ("".join(rng.choice("abc é😀") for _ in range(rng.randint(0, 90))) for _ in "ab")
        assert levenshtein(a, b) == slow_levenshtein(a, b)
    assert edit_fraction("kitten", "sitting") == 3 / 7
    assert edit_fraction("😀a", "a") == 0.5 and edit_fraction("", "") == 0.0


def test_digamma():
    x = np.array([0.3, 0.5, 1.0, 2.0, 5.5, 40.0, 1e6])
    step = 1e-5
    slope = [(math.lgamma(v + step) - math.lgamma(v - step)) / (2 * step) for v in x[:-1]] + [math.log(1e6)]
    assert np.allclose(digamma(x), slope, rtol=1e-5, atol=1e-5)


def merged(word, left, right, new):
    out, i = [], 0
    while i < len(word):
        if i + 1 < len(word) and (word[i], word[i + 1]) == (left, right):
            out.append(new)
            i += 2
        else:
            out.append(word[i])
            i += 1
    return out


def test_apply_merges_against_lists():
    """Merges that build on each other, also ones that spell a symbol which is there already."""
    rng = random.Random(2)
    for _ in range(400):
        words = [[rng.randint(1, 4) for _ in range(rng.randint(1, 12))] for _ in range(8)]
        merges, known = [], 4
        for _ in range(rng.randint(1, 6)):
            pair = rng.randint(1, known), rng.randint(1, known)
            if any(m[:2] == pair for m in merges):
                continue
            if rng.random() < 0.8:
                known += 1
            merges.append((*pair, known))
        ids = np.array([i for w in words for i in w], dtype=np.int64)
        word = np.repeat(np.arange(8), [len(w) for w in words])
        got_ids, got_word = apply_merges(ids, word, pack_merges(merges))
        for k, w in enumerate(words):
            for m in merges:
                w = merged(w, *m)
            assert got_ids[got_word == k].tolist() == w


def test_distance_of_other_spacing():
    rng = random.Random(4)
    for _ in range(1500):
        base = [rng.choice("ab") for _ in range(rng.randint(0, 14))]
        a, b = ("".join(c + rng.choice(gaps) for c in base) for gaps in (["", "", " ", "\n", "  ", "\n\n"], ["", " ", " ##"]))
        if rng.random() < 0.3:
            a = b[:rng.randint(0, 9)] + a
        assert levenshtein(a, b) == slow_levenshtein(a, b) == levenshtein(b, a)
    long = "ab cd\nefg " * 100_000
    assert levenshtein(long, long.replace("b", "b ").replace("\n", " ")) == 200_000


def segmentations(word, scores):
    if not word:
        yield []
    for n in range(1, len(word) + 1):
        if word[:n] in scores:
            for rest in segmentations(word[n:], scores):
                yield [word[:n], *rest]


def test_unigram_lattice():
    rng = random.Random(3)
    pieces = ["a", "b", "c", "ab", "bc", "abc", "ca", "aa", "bca"]
    scores = {p: math.log(rng.uniform(0.01, 0.3)) for p in pieces}
    for word in ["a", "abc", "abcabc", "aabca", "cabcaab"]:
        paths = list(segmentations(word, scores))
        weights = [math.exp(sum(scores[p] for p in path)) for path in paths]
        want = {}
        for path, w in zip(paths, weights):
            for p in path:
                want[p] = want.get(p, 0) + w / sum(weights)
        got = expected_counts(word, scores, 3)
        assert got.keys() == want.keys()
        assert all(got[p] == pytest.approx(want[p]) for p in want)
        best = max(zip(weights, paths))[1]
        assert [word[a:b] for a, b, _ in best_path(word, scores, 3)] == best


def test_spaced_distance():
    """Lines and their tokens joined by spaces, with and without marks, also where the line holds the mark."""
    rng, proven = random.Random(5), 0
    for _ in range(1500):
        gaps = ["", " ", " ", "\n"] + ["  ", "\n\n", " \t"] * (rng.random() < 0.2)
        line = "".join(rng.choice(["ab", "b", "#", ",", "a#b"]) + rng.choice(gaps) for _ in range(rng.randint(0, 9))) + rng.choice(["", "b", "b"])
        mark = rng.choice(["", "##"])
        words = re.findall(r"\w+|[^\w\s]+", line)
        tokens, marks = [], 0
        for word in words:
            cuts = sorted(rng.sample(range(1, len(word)), rng.randint(0, len(word) - 1)))
            pieces = [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)])]
            tokens += [pieces[0], *(mark + p for p in pieces[1:])]
            marks += len(mark) * len(cuts)
        got = spaced_distance(line, "".join(words), len(tokens), marks)
        assert got is None or got == slow_levenshtein(line, " ".join(tokens))
        proven += got is not None
        if tokens and not re.search(r"^\s|\s\s|\s$", line):
            assert got is not None
    assert proven > 900
    long = "a #b, c\n" * 50_000 + "a"
    assert spaced_distance(long, "".join(long.split()), 200_001, 0) == 100_000
    assert spaced_distance("a b", "xb", 2, 0) is None
