"""Encoding with a trained model.

A whole corpus is encoded where it lies: no shuffle, no join of token occurrences;
each Python worker remembers the words it has met, within a bound, which in natural text is nearly
every next word. Statistics encode the distinct words only, and remember none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from heapq import heapify, heappop, heappush
from math import inf
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession, functions as F
from pyspark.sql.functions import arrow_udf, pandas_udf

from wordloom import rules
from wordloom.functions import tokenizers as tk
from wordloom.functions.kernels import edit_fraction, gap_distances, spacing
from wordloom.operators.subword.batch import Counter
from wordloom.operators.subword.model import SubwordModel
from wordloom.operators.subword.unigram import UNKNOWN_PENALTY

Encoded = tuple[list[str], list[int]]
# Characters of the words that a worker remembers for a model: at most some 200 bytes each with their tokens and ids.
_REMEMBER = 400_000


def bpe_encoder(model: SubwordModel) -> Callable[[str], Encoded]:
    """Lowest-ranked merge first; an unknown character becomes the unknown token."""
    index = {t: i for i, t in enumerate(model.vocab)}
    rank = {pair: (i, new) for i, (pair, new) in enumerate(zip(model.merges, model.merge_ids))}

    def encode(word: str) -> Encoded:
        # The pairs wait in a heap; a linked list says which are still neighbours.
        ids = [index.get(c, 0) for c in word]
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        gone = len(ids)
        waiting = [(*rank[pair], at, *pair) for at, pair in enumerate(zip(ids, ids[1:])) if pair in rank]
        heapify(waiting)
        while waiting:
            _, new, at, left, right = heappop(waiting)
            other = after[at]
            if ids[at] != left or other >= gone or ids[other] != right:
                continue
            ids[at], ids[other] = new, -1
            after[at] = following = after[other]
            if following < gone:
                before[following] = at
            for i in (before[at], at):
                if i >= 0 and after[i] < gone and (pair := (ids[i], ids[after[i]])) in rank:
                    heappush(waiting, (*rank[pair], i, *pair))
        ids = [i for i in ids if i >= 0]
        return [model.vocab[i] for i in ids], ids

    return encode


def wordpiece_encoder(model: SubwordModel) -> Callable[[str], Encoded]:
    """Greedy longest match; one unknown token for a word that cannot be covered."""
    index = {t: i for i, t in enumerate(model.vocab)}
    unknown = ([rules.UNK], [0])

    def encode(word: str) -> Encoded:
        if len(word) > rules.WORDPIECE_MAX_CHARS:
            return unknown
        tokens, start = [], 0
        while start < len(word):
            prefix = rules.CONTINUATION if start else ""
            end = next(
                (e for e in range(len(word), start, -1) if prefix + word[start:e] in index), None
            )
            if end is None:
                return unknown
            tokens.append(prefix + word[start:end])
            start = end
        return tokens, [index[t] for t in tokens]

    return encode


def unigram_encoder(model: SubwordModel) -> Callable[[str], Encoded]:
    """Most likely segmentation; a run of unknown characters keeps its surface, id 0."""
    index = {t: i for i, t in enumerate(model.vocab)}
    scores = dict(zip(model.vocab[1:], model.scores[1:]))
    longest = max(map(len, scores), default=1)
    unknown = min(scores.values(), default=0.0) - UNKNOWN_PENALTY

    find = scores.get

    def encode(word: str) -> Encoded:
        # As best_path with an unknown score: of equals, the piece that starts first.
        best, back = [0.0], [0]
        for end in range(1, len(word) + 1):
            low = end - longest if end > longest else 0
            top, at = -inf, low
            for start in range(low, end - 1):
                score = find(word[start:end])
                if score is not None and (found := best[start] + score) > top:
                    top, at = found, start
            if (found := best[-1] + find(word[end - 1], unknown)) > top:
                top, at = found, end - 1
            best.append(top)
            back.append(at)
        path, end = [], len(word)
        while end:
            path.append((back[end], end))
            end = back[end]
        tokens, ids = [], []
        for start, end in reversed(path):
            piece = word[start:end]
            known = piece in scores
            if not known and ids and ids[-1] == 0:
                tokens[-1] += piece
            else:
                tokens.append(piece)
                ids.append(index[piece] if known else 0)
        return tokens, ids

    return encode


_ENCODERS = {"bpe": bpe_encoder, "wordpiece": wordpiece_encoder, "unigram": unigram_encoder}


def encoder(model: SubwordModel, remember: int = _REMEMBER) -> Callable[[str], Encoded]:
    """Word encoder that remembers words of so many characters in all; 0 for rows that are distinct words."""
    plain, seen, room = _ENCODERS[model.kind](model), {}, remember
    if not remember:
        return plain

    def encode(word: str) -> Encoded:
        nonlocal room
        found = seen.get(word)
        if found is None:
            room -= len(word)
            if room < 0:
                seen.clear()
                room = remember - len(word)
            found = seen[word] = plain(word)
        return found

    return encode


def _stripped(token: str) -> str:
    return token[2:] if len(token) > 2 and token.startswith(rules.CONTINUATION) else token


class Shape(NamedTuple):
    """What statistics need of a word's tokens: how many, how many characters of continuation marks they add, whether
    they spell the word but for these, and whether they do without all prefixes."""

    tokens: int
    marks: int
    spelled: bool
    stripped: bool


def shape(word: str, tokens: list[str]) -> Shape:
    known, mark, tail, joined = rules.UNK not in tokens, rules.CONTINUATION, tokens[1:], "".join(tokens)
    stripped = (joined if mark not in joined else "".join(map(_stripped, tokens))) == word
    if joined == word:
        return Shape(len(tokens), 0, known, stripped)
    spelled = known and all(t.startswith(mark) for t in tail) and "".join([*tokens[:1], *(t[len(mark):] for t in tail)]) == word
    return Shape(len(tokens), len(mark) * len(tail), spelled, stripped)


class _Words:
    """The words of a batch's rows as places in the list of its distinct words."""

    def __init__(self, pretokens: pa.ListArray):
        self.pretokens = pretokens
        coded = pretokens.flatten().dictionary_encode()
        self.dictionary, self.distinct, self.at = coded.dictionary, coded.dictionary.to_pylist(), coded.indices.to_numpy()
        sizes = pc.fill_null(pc.list_value_length(pretokens), 0).to_numpy()
        self.ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])

    def sums(self, values: np.ndarray) -> np.ndarray:
        """For each row, the sum of its words' values."""
        before = np.concatenate([[0], np.cumsum(values.astype(np.int64)[self.at])])
        return before[self.ends[1:]] - before[self.ends[:-1]]

    def of(self, row: int) -> Iterator[str]:
        return (self.distinct[k] for k in self.at[self.ends[row]:self.ends[row + 1]].tolist())


def _shapes(words: _Words, model: SubwordModel, counts: np.ndarray, encode: Callable[[str], Encoded]) -> Shape:
    """Arrays over the distinct words; ``counts`` has the numbers of tokens where these are known to spell the word."""
    left = np.flatnonzero(counts < 0)
    marks = len(rules.CONTINUATION) * (counts - 1) if model.kind == "wordpiece" else np.zeros_like(counts)
    out = Shape(counts.copy(), marks, np.ones(len(counts), bool), np.ones(len(counts), bool))
    if len(left):
        for column, values in zip(out, zip(*(shape(w, encode(w)[0]) for w in map(words.distinct.__getitem__, left.tolist())))):
            column[left] = values
    return out


_RESULT = "tokens array<string>, ids array<int>"


class Shared:
    """Models broadcast once for any number of columns. As a context it releases them at its end, when
    what uses the columns must have run."""

    def __init__(self, spark: SparkSession, models: Mapping[str, SubwordModel]):
        self.names = list(models)
        self._models = spark.sparkContext.broadcast(dict(models))

    def __enter__(self) -> "Shared":
        return self

    def __exit__(self, *_) -> None:
        self._models.destroy()

    def encoded(self, pretokens: Column, remember: int = _REMEMBER) -> Column:
        """One row ``(model, enc)`` for each model; texts go to Python once for all of them."""
        shared = self._models

        @pandas_udf(f"array<struct<{_RESULT.replace(' ', ':').replace(',:', ',')}>>")
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            encoders = {key: encoder(model, remember) for key, model in shared.value.items()}
            for pretokens in batches:
                out = []
                for words in pretokens:
                    row = []
                    for encode in encoders.values():
                        tokens, ids = [], []
                        for word in words if words is not None else ():
                            t, i = encode(word)
                            tokens += t
                            ids += i
                        row.append({"tokens": tokens, "ids": ids})
                    out.append(row)
                yield pd.Series(out)

        keys = F.array(*[F.lit(n) for n in self.names])
        return F.explode(F.arrays_zip(keys.alias("model"), run(pretokens).alias("enc")))

    def _shaped(self, returns: str, name: str, rows: Callable, pretokens: Column, line: Column | None = None, prepare: Callable | None = None) -> Column:
        """A row for each model: its name and a value of ``rows(words, lines, prepared, encode, shapes of the distinct words)``, an
        Arrow array; ``prepare(words, lines)`` is what all models share.

        Only the distinct words of a batch come to Python; they are counted for all models together."""
        shared = self._models

        @arrow_udf(f"array<{returns}>")
        def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            models = list(shared.value.values())
            encoders, counter = [encoder(model, 0) for model in models], Counter(shared.value)
            for pretokens, lines in batches:
                words = _Words(pretokens)
                prepared = prepare(words, lines) if prepare else None
                found = [rows(words, lines, prepared, encode, _shapes(words, model, counts, encode))
                         for model, encode, counts in zip(models, encoders, counter.counts(words.dictionary, words.distinct))]
                place = np.arange(len(found) * len(lines)).reshape(len(found), len(lines)).T.ravel()
                offsets = np.arange(0, len(place) + 1, len(found), dtype=np.int32)
                yield pa.ListArray.from_arrays(pa.array(offsets), pa.concat_arrays(found).take(pa.array(place)))

        keys = F.array(*[F.lit(n) for n in self.names])
        return F.explode(F.arrays_zip(keys.alias("model"), run(pretokens, F.lit("") if line is None else line).alias(name)))

    def counted(self, pretokens: Column) -> Column:
        """One row ``(model, n_tokens)`` for each model."""
        def rows(words: _Words, _, __, encode: Callable, shapes: Shape) -> pa.Array:
            return pa.array(words.sums(shapes.tokens))

        return self._shaped("bigint", "n_tokens", rows, pretokens)

    def restored(self, pretokens: Column, line: Column, lossless: bool = False) -> Column:
        """One row ``(model, back)`` for each model: whether the tokens give the line back, and how far they are from it.

        Tokens are joined by spaces, the unknown token left out; ``lossless`` joins them without spaces or prefixes."""
        def prepare(words: _Words, lines: pa.Array) -> tuple:
            spelled = lines.to_pylist()
            plain = [x or "" for x in pc.binary_join(words.pretokens, "").to_pylist()]
            gaps = None if lossless else np.array([spacing(a, b) for a, b in zip(spelled, plain)], np.int64).reshape(len(spelled), 4)
            return spelled, plain, gaps, *(np.fromiter(map(len, x), np.int64, len(x)) for x in (spelled, plain))

        def rows(words: _Words, _, prepared: tuple, encode: Callable, shapes: Shape) -> pa.Array:
            lines, plain, gaps, line_sizes, plain_sizes = prepared
            tokens, marks = words.sums(shapes.tokens), words.sums(shapes.marks)
            unlike = words.sums(~(shapes.stripped if lossless else shapes.spelled)) > 0
            if lossless:
                distance, longest = np.array([0 if a == b else -1 for a, b in zip(lines, plain)], np.int64), line_sizes
            else:
                distance, longest = gap_distances(gaps, tokens, marks), np.maximum(line_sizes, plain_sizes + marks + tokens - 1)
            distance[unlike] = -1
            same, fractions = distance == 0, distance / np.maximum(longest, 1)
            for i in np.flatnonzero(distance < 0).tolist():
                found = [t for w in words.of(i) for t in encode(w)[0]]
                if lossless:
                    back = "".join(map(_stripped, found))
                else:
                    back = " ".join(t for t in found if t != rules.UNK)
                same[i], fractions[i] = back == lines[i], edit_fraction(lines[i], back)
            return pa.StructArray.from_arrays([pa.array(same), pa.array(fractions)], names=["same", "distance"])

        return self._shaped("struct<same:boolean,distance:double>", "back", rows, pretokens, line, prepare)


def encode_udf(spark: SparkSession, models: Mapping[str, SubwordModel], remember: int = _REMEMBER):
    """``udf(model_key, pretokens) -> struct<tokens, ids>`` for a set of models."""
    shared = spark.sparkContext.broadcast(dict(models))

    @pandas_udf(_RESULT)
    def encode(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        encoders = {key: encoder(model, remember) for key, model in shared.value.items()}
        for keys, pretokens in batches:
            all_tokens, all_ids = [], []
            for key, words in zip(keys, pretokens):
                tokens, ids = [], []
                for word in words if words is not None else ():
                    t, i = encoders[key](word)
                    tokens += t
                    ids += i
                all_tokens.append(tokens)
                all_ids.append(ids)
            yield pd.DataFrame({"tokens": all_tokens, "ids": all_ids})

    return encode


def encode_column(spark: SparkSession, model: SubwordModel, text: Column) -> Column:
    """Tokens and ids of a text column."""
    return encode_udf(spark, {model.kind: model})(F.lit(model.kind), tk.subword_pretokens(text))
