"""The automaton's matches against a plain search for every pattern at every word."""

import random

from wordloom.llm.toxicity import Lexicon, fold, matches


def plain(lexicon, folded):
    """Weight by the start of each word that a pattern begins at, less those inside exception phrases."""
    starts = [i for i in range(len(folded) - 1) if folded[i] == " "]
    hits = {}
    for i in starts:
        weights = [w for p, w in lexicon.weights.items() if folded.startswith(p, i)]
        if weights:
            hits[i] = max(weights)
    for phrase in lexicon.exceptions:
        for i in starts:
            if folded.startswith(phrase, i):
                hits = {s: w for s, w in hits.items() if not i <= s < i + len(phrase) - 1}
    return hits


def test_same_as_a_plain_search():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("ab1А!") for _ in range(rng.randint(1, 5)))
    for _ in range(400):
        words = [word() for _ in range(12)]
        inner = [w for w in (fold(x).strip() for x in words) if w and " " not in w]
        weights = {}
        for w in rng.sample(inner, min(5, len(inner))):
            weights[f" {w} " if rng.random() < 0.5 else f" {w[:rng.randint(1, 4)]}"] = float(rng.randint(1, 9))
        exceptions = tuple({f" {rng.choice(inner)} {rng.choice(inner)} " for _ in range(3)} if inner else ())
        lexicon = Lexicon(weights, exceptions)
        text = fold(" ".join(rng.choice(words) + rng.choice(["", ",", "-", "​"]) for _ in range(rng.randint(0, 40))))
        assert matches(lexicon.automaton(), text) == plain(lexicon, text)


def test_empty_lexicon_matches_nothing():
    assert Lexicon().automaton() is None and matches(None, fold("any text")) == {}
