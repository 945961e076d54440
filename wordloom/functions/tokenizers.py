"""Tokenizers: text column -> array<string> column, and the registry the grid uses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from wordloom import rules
from wordloom.functions import text as tx

Tokenizer = Callable[[Column], Column]


def naive(text: Column) -> Column:
    """White-space words with punctuation stripped from both ends."""
    stripped = F.transform(tx.words(text), lambda w: F.btrim(w, F.lit(rules.NAIVE_STRIP)))
    return F.array_remove(stripped, "")


def regex_pattern(extra_letters: str = "") -> str:
    letters = rules.WORD_ALPHABET + extra_letters
    # Possessive: a chain of any length is matched without recursion, and alike.
    return f"[{letters}]++(?:[-'][{letters}]++)*+"


def regex_words(text: Column, extra_letters: str = "") -> Column:
    return F.regexp_extract_all(text, F.lit(regex_pattern(extra_letters)), 0)


RULES_PATTERN = (
    r"\p{Nd}++(?:[.,]\p{Nd}++)*+"
    r"|\p{L}[\p{L}\p{M}]*+(?:-\p{L}[\p{L}\p{M}]*+)*+"
    rf"|[^{rules.WS}]"
)


def rule_tokens(text: Column) -> Column:
    """Numbers, (hyphenated) words and single punctuation marks."""
    return F.regexp_extract_all(text, F.lit(RULES_PATTERN), 0)


SENTENCE_PATTERN = (
    r"(?:\p{L}{1,3}\.){2,}"
    r"|\p{Nd}++(?:[.,:]\p{Nd}++)*+"
    r"|\p{L}[\p{L}\p{M}\p{Nd}]*+(?:['’-]\p{L}[\p{L}\p{M}\p{Nd}]*+)*+"
    r"|\.{2,}"
    rf"|[^{rules.WS}]"
)


def sentence_tokens(text: Column) -> Column:
    """Words and punctuation of running text: dotted abbreviations, numbers, words with their inner
    apostrophes and hyphens and runs of full stops stay whole; any other mark is a token, also at the end of a sentence."""
    return F.regexp_extract_all(text, F.lit(SENTENCE_PATTERN), 0)


def sentence_words(text: Column, language: str = "ru", country: str = "RU") -> Column:
    """Locale-aware sentences, then words; punctuation is dropped."""
    return F.flatten(F.sentences(text, F.lit(language), F.lit(country)))


WORDPUNCT_PATTERN = r"(?U)\w+|[^\w\s]+"


def wordpunct(text: Column) -> Column:
    """Runs of word characters and runs of punctuation: the subword pre-tokenizer."""
    return F.regexp_extract_all(text, F.lit(WORDPUNCT_PATTERN), 0)


def subword_pretokens(text: Column) -> Column:
    return wordpunct(tx.nfkc(text))


TOKENIZERS: dict[str, Tokenizer] = {
    "naive": naive,
    "regex": regex_words,
    "sentences": sentence_tokens,
    "rules": rule_tokens,
    "wordpunct": wordpunct,
}


def resolve(name: str | Tokenizer) -> Tokenizer:
    """A registered tokenizer by name, or any Column -> Column callable as it is
    (wrap a Python tokenizer with ``pandas_udf('array<string>')``)."""
    if callable(name):
        return name
    try:
        return TOKENIZERS[name]
    except KeyError:
        raise ValueError(f"unknown tokenizer {name!r}; known: {sorted(TOKENIZERS)}") from None
