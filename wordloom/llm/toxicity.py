"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded text.

*Folding* lower-cases, maps look-alike letters, full-width forms and digit or sign substitutions to
one letter, drops invisible characters and turns everything else into single spaces, so that
``1d!0t`` and ``idiot`` are one string. i, l and 1 are one letter.

*Learning*: from at most ``sample`` labelled rows (a documented bound; the hash of the id decides
which), two thirds give the lexicon: whole words and word beginnings whose log odds between toxic and
other texts, less their standard error, are high, with at least ``support`` different toxic texts. On the last third the weights' sums
are calibrated, by logistic regression on the sum and on the sum normalised by length. Phrases of
a term and its neighbour that clean texts use are exceptions: terms inside them don't count.

*Scoring* is one pass over the texts without a shuffle; lexicon and calibration are bounded.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wordloom.llm.common import free_name, whole

#: Letters of other scripts that look like Latin ones.
HOMOGLYPHS = dict(zip("авсԁеһіјӏкмнорԛѕтѵԝхуαβεικνορτυχ", "abcdehijlkmhopqstvwxyabeikvoptux"))
SUBSTITUTES = dict(zip("0134578@$", "oieastbas"))
_INVISIBLE = "­​‌‍⁠﻿"
_FOLD = (
    {ord(a): b for a, b in HOMOGLYPHS.items()} | {ord(a.upper()): b for a, b in HOMOGLYPHS.items()}
    | {ord(a): b for a, b in SUBSTITUTES.items()} | {ord(c): None for c in _INVISIBLE}
    | {0xFF21 + i: chr(97 + i) for i in range(26)} | {0xFF41 + i: chr(97 + i) for i in range(26)}
    | {ord("l"): "i", ord("L"): "i"}
)
_INNER_SIGN = re.compile(r"(?<=[^\W_])[!|](?=[^\W_])")
_OTHER = re.compile(r"[\W_]+")
STEMS = (4, 5, 6, 7, 8, 9)


def fold(text: str) -> str:
    """The folded words between single spaces, with a space at either end."""
    if "!" in text or "|" in text:
        text = _INNER_SIGN.sub("i", text)
    return f" {_OTHER.sub(' ', text.lower().translate(_FOLD)).strip()} "


@dataclass(frozen=True)
class Lexicon:
    """Patterns of folded text: `` word `` is a whole word, `` stem`` the beginning of one."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    bias: float = -4.0
    slopes: tuple[float, float] = (1.0, 1.0)

    def automaton(self) -> ahocorasick.Automaton | None:
        made = ahocorasick.Automaton()
        for p, w in self.weights.items():
            made.add_word(p, (len(p), w))
        for p in self.exceptions:
            made.add_word(p, (len(p), None))
        if not len(made):
            return None
        made.make_automaton()
        return made


def matches(automaton: ahocorasick.Automaton | None, folded: str) -> dict[int, float]:
    """Weight of each word that matches, by its start; the heaviest pattern counts."""
    hits: dict[int, float] = {}
    spared: list[tuple[int, int]] = []
    for end, (length, weight) in automaton.iter(folded) if automaton else ():
        start = end - length + 1
        if weight is None:
            spared.append((start, end))
        else:
            hits[start] = max(weight, hits.get(start, 0.0))
    for a, b in spared:
        for start in [s for s in hits if a <= s < b]:
            del hits[start]
    return hits


def _features(total: float, words: int) -> tuple[float, float]:
    return math.log1p(total), math.log1p(100 * total / max(words, 1))


def score(lexicon: Lexicon, total: float, words: int) -> float:
    a, b = _features(total, words)
    z = lexicon.bias + lexicon.slopes[0] * a + lexicon.slopes[1] * b
    return 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """pattern, toxic, how many texts hold it."""
    found: Counter = Counter()
    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            words = set(fold(text).split())
            patterns = {f" {w} " for w in words}
            for n in STEMS:
                patterns |= {f" {w[:n]}" for w in words if len(w) > n}
            found.update((p, toxic) for p in patterns)
    rows = list(found.items())
    yield pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k, _ in rows], pa.string()), pa.array([k[1] for k, _ in rows], pa.int32()),
         pa.array([n for _, n in rows], pa.int64())], ["pattern", "toxic", "n"])


def _phrases(lexicon: Lexicon):
    """Pairs of a term's word with its neighbours, toxic, count; and one row with the sum."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        found: Counter = Counter()
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                folded = fold(text)
                pairs = set()
                for start in matches(automaton, folded):
                    end = folded.index(" ", start + 1)
                    before, after = folded.rfind(" ", 0, start), folded.find(" ", end + 1)
                    if before >= 0:
                        pairs.add(folded[before:end + 1])
                    if after >= 0:
                        pairs.add(folded[start:after + 1])
                found.update((p, toxic) for p in pairs)
        rows = list(found.items())
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k, _ in rows], pa.string()), pa.array([k[1] for k, _ in rows], pa.int32()),
             pa.array([n for _, n in rows], pa.int64())], ["pattern", "toxic", "n"])

    return run


def _totals(lexicon: Lexicon, keep: list[str]):
    """The columns ``keep``, the score and the number of matching words of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            scores, hits, totals, words = [], [], [], []
            for text in batch.column("text").to_pylist():
                folded = fold(text)
                found = matches(automaton, folded)
                totals.append(sum(found[s] for s in sorted(found)))
                words.append(max(folded.count(" ") - 1, 0))
                scores.append(score(lexicon, totals[-1], words[-1]))
                hits.append(len(found))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(scores, pa.float64()), pa.array(hits, pa.int32()),
                 pa.array(totals, pa.float64()), pa.array(words, pa.int32())],
                [*keep, "score", "hits", "total", "words"])

    return run


def _calibrate(rows: list[tuple[float, int, int]]) -> tuple[float, tuple[float, float]]:
    """Logistic regression with a small ridge, by Newton's method."""
    if not rows:
        return -4.0, (1.0, 1.0)
    x = np.array([(1.0, *_features(t, n)) for t, n, _ in rows])
    y = np.array([label for _, _, label in rows], float)
    w, ridge = np.zeros(3), np.diag([0.01, 0.05, 0.05])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge, x.T @ (p - y) + ridge @ w)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    w = np.round(w, 9)
    return float(w[0]), (float(w[1]), float(w[2]))


def learn(
    docs: DataFrame, labels: DataFrame, trainable: Column, id_column: str = "doc_id", text_column: str = "text",
    label_column: str = "toxic", sample: int = 20_000, max_terms: int = 4_000, support: int = 3,
    least_weight: float = 2.0,
) -> Lexicon:
    """A lexicon from the labelled rows for which ``trainable`` (over the id) holds.

    Rows without id or label are left out; an id with several labels counts as toxic if one of
    them does; texts that several labelled rows share count once. Without labels the lexicon is empty.
    """
    ids = (labels.select(F.col(id_column).alias("id"), F.col(label_column).alias("toxic"))
           .filter(F.col("id").isNotNull() & F.col("toxic").isNotNull())
           .groupBy("id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    ids = ids.withColumnRenamed("id", id_column).filter(trainable).withColumnRenamed(id_column, "id")
    ids = ids.orderBy(F.xxhash64("id"), "id").limit(sample)  # bounded, so it may be broadcast
    rows = (docs.select(F.col(id_column).alias("id"), whole(text_column).alias("text"))
            .join(F.broadcast(ids), "id").groupBy("text").agg(F.max("toxic").alias("toxic")))
    calibrating = F.pmod(F.xxhash64("text"), F.lit(3)) == 0
    rows = rows.persist()
    try:
        first = rows.filter(~calibrating)
        size = {r.toxic: r.n for r in first.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
        odds = lambda a, b: F.log((F.col(a) + 0.5) / (size.get(1, 0) + 1)) - F.log((F.col(b) + 0.5) / (size.get(0, 0) + 1))

        error = F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5))

        def by_label(df: DataFrame, run) -> DataFrame:
            n = df.select("text", "toxic").mapInArrow(run, "pattern string, toxic int, n bigint")
            sums = lambda k: F.coalesce(F.sum(F.when(F.col("toxic") == k, F.col("n"))), F.lit(0))
            return n.groupBy("pattern").agg(sums(1).alias("a"), sums(0).alias("b"))

        terms = (by_label(first, _counts).filter(F.col("a") >= support)
                 .withColumn("w", F.round(odds("a", "b") - error, 6)).filter(F.col("w") >= least_weight)
                 .orderBy(F.desc("w"), "pattern").limit(max_terms).collect())
        lexicon = Lexicon({r.pattern: r.w for r in terms})
        spared = (by_label(first, _phrases(lexicon)).filter(F.col("b") >= support)
                  .withColumn("w", odds("a", "b")).filter("w < 0")
                  .orderBy("w", "pattern").limit(max_terms).collect())
        lexicon = Lexicon(lexicon.weights, tuple(r.pattern for r in spared))
        sums = rows.filter(calibrating).select("text", "toxic").mapInArrow(
            _totals(lexicon, ["toxic"]), "toxic int, score double, hits int, total double, words int")
        told = sorted((r.total, r.words, r.toxic) for r in sums.select("total", "words", "toxic").collect())
        return Lexicon(lexicon.weights, lexicon.exceptions, *_calibrate(told))
    finally:
        rows.unpersist()


def with_scores(docs: DataFrame, lexicon: Lexicon, text_column: str = "text") -> tuple[DataFrame, str, str]:
    """docs with a score and a number of matches in columns of free names, and those names.

    A null or empty text has the score of a text without matches. Repeated rows score alike;
    an empty table gives no rows; other columns pass through.
    """
    from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

    names = free_name(docs, "score"), free_name(docs, "hits")
    inside = {c: f"c{i}" for i, c in enumerate(docs.columns)}  # no name can clash inside
    packed = docs.select(*[F.col(c).alias(a) for c, a in inside.items()], whole(text_column).alias("text"))
    schema = StructType([StructField(inside[f.name], f.dataType, True) for f in docs.schema.fields] + [
        StructField("score", DoubleType()), StructField("hits", IntegerType()),
        StructField("total", DoubleType()), StructField("words", IntegerType())])
    out = packed.mapInArrow(_totals(lexicon, list(inside.values())), schema)
    return out.select(*[F.col(a).alias(c) for c, a in inside.items()],
                      F.col("score").alias(names[0]), F.col("hits").alias(names[1])), *names
