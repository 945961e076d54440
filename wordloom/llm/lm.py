"""Language-model scores from a log-frequency Bloom filter.

Training counts bigrams of all training texts in the cluster. A bigram seen c times is put into a
Bloom filter at the levels 1 .. 1 + floor(log2(c / t)) for a chosen smallest count t; to read it back, its
levels are probed until one is missing. The filter is one segment for each bucket of hashes, and a segment
has as many bits as its levels need, so the filter grows with the corpus and is as full at every size.

P(v | u) interpolates the quantised bigram estimate, over the count of u, with the add-one unigram
probability. A level reads as the smallest count that has it, so seen successors of u have no more than all
of its probability; what the filter takes for seen by mistake, at 2 ** -hashes a probe of a new pair, comes on top.
The filter is asked by bucket, not broadcast: it grows with the corpus, so no bound on its size could hold. Unigram counts are exact: the texts are dealt out to shards, each shard asks for the counts
of its distinct words and the levels of its distinct bigrams, bucket by bucket, and the answers meet its
texts again. So a word that is everywhere is one record for each shard, no task holds the vocabulary or
the filter, and nothing of either goes to the driver.

Words and bigrams are 64-bit hashes; two of n words share one with probability n * n / 2 ** 65.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wordloom.llm.common import (
    Words, batch, bucket_of, by_bucket, byte_lists, mix, partitions, planes, slices, unplanes, whole)
from wordloom.session import materialize

_U = np.uint64
#: Stands for the end of a text, and for what comes before its first word.
END = mix(np.array([0x656E64], _U))[0]
UNIGRAM, BIGRAM, REQUEST = 0, 1, 2
_COUNTS = [("kind", pa.int32()), ("bucket", pa.int64()), ("shard", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())]
_COUNTS_SQL = "kind int, bucket bigint, shard bigint, keys binary, counts binary"
#: What a shard is told by a bucket: its known words and, in the order of their hashes, the level of each bigram.
_ANSWERS = [("bucket", pa.int64()), ("part", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary()), ("levels", pa.binary())]
_ANSWERS_SQL = "bucket bigint, part bigint, keys binary, counts binary, levels binary"
_LEVELS = 40
_FLUSH = 8_000_000


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, an end after each text; and the tokens of each text."""
    words = Words([t.lower() for t in texts])  # ASCII letters only
    each = words.counts + 1
    ends = np.cumsum(each) - 1
    out = np.empty(int(each.sum()), _U)
    inner = np.ones(len(out), bool)
    inner[ends] = False
    out[ends] = END
    if len(words):
        low = np.arange(len(words))
        out[inner] = words.run(low, low + 1)
    return out, each


def before(token: np.ndarray, each: np.ndarray) -> np.ndarray:
    """The token before each one; the end stands before the first of a text."""
    out = np.empty_like(token)
    out[1:] = token[:-1]
    out[np.cumsum(each) - each] = END
    return out


def pair(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    return mix(mix(u + _U(0x632BE59BD9B4E019)) ^ (v * _U(0xFF51AFD7ED558CCD)))


def _tally(keys: list[np.ndarray], counts: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    all_keys = np.concatenate(keys)
    if counts is None:
        found, n = np.unique(all_keys, return_counts=True)
        return found, n.astype(np.int64)
    order = np.argsort(all_keys, kind="stable")
    all_keys, n = all_keys[order], np.concatenate(counts)[order]
    first = np.flatnonzero(np.concatenate(([True], np.diff(all_keys.view(np.int64)) != 0))) if len(all_keys) else order
    return all_keys[first], np.add.reduceat(n, first) if len(first) else n


def _count(buckets: int):
    """Training texts to unigram and bigram counts, combined in the task."""
    def flush(held) -> pa.RecordBatch:
        rows = []
        for kind, keys in held.items():
            found, n = _tally(keys)
            for b, (k, c) in by_bucket(bucket_of(found, buckets), found, n):
                rows.append((kind, b, -1, planes(k), planes(c)))
        return batch(_COUNTS, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {UNIGRAM: [], BIGRAM: []}, 0
        for b in batches:
            texts = byte_lists(b.column("text"))
            for low, high in slices(texts):
                token, each = tokens(texts[low:high])
                held[UNIGRAM].append(token)
                held[BIGRAM].append(pair(before(token, each), token))
                size += len(token)
                if size > _FLUSH:
                    yield flush(held)
                    held, size = {UNIGRAM: [], BIGRAM: []}, 0
        if size:
            yield flush(held)

    return run


_MERGED = [("kind", pa.int32()), ("bucket", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary()),
           ("n", pa.int64()), ("total", pa.int64()), ("levels", pa.list_(pa.int64()))]
_MERGED_SQL = "kind int, bucket bigint, keys binary, counts binary, n bigint, total bigint, levels array<bigint>"


def levels(counts: np.ndarray, least: int) -> np.ndarray:
    """How many levels a count takes: 1 + floor(log2(count / least)), none below."""
    return np.where(counts >= least, np.frexp(np.maximum(counts // least, 1).astype(np.float64))[1], 0)


def _merge(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Counts by kind and bucket. ``levels`` has how many bigrams take the levels 1, 2 and so on."""
    held: dict[tuple, list] = {}
    for b in batches:
        for kind, bucket, _, keys, counts in zip(*[b.column(n).to_pylist() for n, _ in _COUNTS]):
            held.setdefault((kind, bucket), []).append((unplanes(keys, _U), unplanes(counts)))
    while held:
        (kind, bucket), rows = held.popitem()
        keys, counts = _tally(*map(list, zip(*rows)))
        top = np.bincount(levels(counts, least)) if kind == BIGRAM else np.zeros(1, np.int64)
        taken = top[:0:-1].cumsum()[::-1].tolist()
        yield batch(_MERGED, [(kind, bucket, planes(keys), planes(counts), len(keys), int(counts.sum()), taken)])


def _start(keys: np.ndarray, level: int) -> np.ndarray:
    return mix(keys ^ _U((0x9E3779B97F4A7C15 * (level + 1)) & (2 ** 64 - 1)))


def _bit(start: np.ndarray, step: np.ndarray, i: int, bits: int) -> np.ndarray:
    """The bit number of hash ``i`` inside a segment of fewer than 2 ** 32 bits, without a division."""
    x = start + _U(i) * step if i else start
    return ((x >> _U(32)) * _U(bits) >> _U(32)).astype(np.int64)


def _places(keys: np.ndarray, level: int, hashes: int, bits: int) -> np.ndarray:
    """Bit numbers inside a segment, ``hashes`` for each key, at one level."""
    start = _start(keys, level)
    step = mix(start) | _U(1)
    return np.stack([_bit(start, step, i, bits) for i in range(hashes)])


def _segment(least: int, hashes: int, bits: int):
    """Bigram counts of a bucket to the filter's segment for it: half full, or of ``bits`` if that is more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for bucket, keys, counts, taken in zip(*[b.column(n).to_pylist() for n in ("bucket", "keys", "counts", "levels")]):
                keys, top = unplanes(keys, _U), levels(unplanes(counts), least)
                size = max(bits, int(np.ceil(sum(taken) * hashes / np.log(2) / 8)) * 8, 8)
                if size >= 1 << 32:
                    raise ValueError("a segment of this size needs more buckets")
                on = np.zeros(size, bool)
                for level in range(1, int(top.max(initial=0)) + 1):
                    on[_places(keys[top >= level], level, hashes, size).ravel()] = True
                yield batch([("bucket", pa.int64()), ("data", pa.binary())], [(bucket, np.packbits(on).tobytes())])

    return run


def _build(least: int, hashes: int, bits: int):
    """Merged counts of words, and of bigrams the segment in place of hashes and counts."""
    segment = _segment(least, hashes, bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _merge(batches, least):
            [row] = b.to_pylist()
            if row["kind"] == BIGRAM:
                [made] = segment(iter([b]))
                row |= {"keys": made.column("data")[0].as_py(), "counts": b""}
            yield batch(_MERGED, [tuple(row.values())])

    return run


class LogFrequencyFilter:
    """Quantised counts of bigrams: one segment of ``bits`` bits for each bucket of hashes."""

    def __init__(self, data: np.ndarray, bits: int, hashes: int, least: int):
        self.data, self.bits, self.hashes, self.least = data, bits, hashes, least
        self.buckets = len(data)

    def level(self, keys: np.ndarray) -> np.ndarray:
        """The highest level up to which every level is there. A hash is probed only for keys that had all before."""
        out = np.zeros(len(keys), np.int64)
        left = np.arange(len(keys))
        flat, width = self.data.ravel(), self.bits // 8
        base = bucket_of(keys, self.buckets) * width if self.buckets > 1 else None
        for level in range(1, _LEVELS + 1):
            start = _start(keys[left], level)
            step = None
            for i in range(self.hashes):
                if i == 1:
                    step = mix(start) | _U(1)
                at = _bit(start, step, i, self.bits)
                byte = flat[(at >> 3) if base is None else base[left] + (at >> 3)]
                there = (byte >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
                left, start = left[there], start[there]
                step = step[there] if i else None
            if not len(left):
                break
            out[left] = level
        return out


def least_count(level: np.ndarray, least: int) -> np.ndarray:
    """The smallest count that has the level, 0 for none. No more than the count that was put in, so the
    counts of a word's successors sum to no more than its own."""
    return np.where(level > 0, least * 2.0 ** (level - 1), 0.0)


def _ask(buckets: int):
    """Shards to the distinct words they ask counts for, and (in ``counts``) the distinct bigrams."""
    def flush(held) -> pa.RecordBatch:
        rows = []
        for shard, (words, pairs) in held.items():
            asked = []
            for keys in (words, pairs):
                found = np.unique(np.concatenate(keys))
                asked.append({b: planes(k) for b, (k,) in by_bucket(bucket_of(found, buckets), found)})
            rows += [(REQUEST, b, shard, asked[0].get(b, b""), asked[1].get(b, b"")) for b in asked[0] | asked[1]]
        return batch(_COUNTS, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0
        for b in batches:
            shards, texts = b.column("bucket").to_numpy(zero_copy_only=False), byte_lists(b.column("text"))
            order = np.argsort(shards, kind="stable")  # texts of one shard side by side, so tokens need no sorting by shard
            shards, texts = shards[order], [texts[i] for i in order]
            for low, high in slices(texts):
                token, each = tokens(texts[low:high])
                both = pair(before(token, each), token)
                change = np.flatnonzero(np.diff(shards[low:high])) + 1
                cuts = np.concatenate(([0], np.cumsum(each)))
                for a, z in zip([0, *change], [*change, high - low]):
                    part = slice(cuts[a], cuts[z])
                    words, pairs = held.setdefault(int(shards[low + a]), ([], []))
                    words.append(np.unique(token[part]))
                    pairs.append(np.unique(both[part]))
                size += len(token)
                if size > _FLUSH:
                    yield flush(held)
                    held, size = {}, 0
        if held:
            yield flush(held)

    return run


def _answer(hashes: int, least: int):
    """Requests, counts and segment of a bucket meet: what each shard asked for and is known. Rows come sorted
    by bucket, kind and shard, so a task holds one bucket's counts and one shard's requests at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, known, found = None, None, None
        asker, words, pairs = None, [], []

        def answer() -> pa.RecordBatch:
            keys, counts = known
            k, p = (np.unique(np.concatenate([unplanes(x, _U) for x in xs])) for xs in (words, pairs))
            place = np.minimum(np.searchsorted(keys, k), max(len(keys) - 1, 0))
            hit = keys[place] == k if len(keys) else np.zeros(len(k), bool)
            level = found.level(p) if found else np.zeros(len(p), np.int64)
            return batch(_ANSWERS, [(asker, at, planes(k[hit]), planes(counts[place[hit]]), level.astype(np.uint8).tobytes())])

        for b in batches:
            for kind, bucket, shard, keys, counts in zip(*[b.column(n).to_pylist() for n, _ in _COUNTS]):
                if asker is not None and (bucket, shard) != (at, asker):
                    yield answer()
                    asker, words, pairs = None, [], []
                if bucket != at:
                    at, known, found = bucket, (np.zeros(0, _U), np.zeros(0, np.int64)), None
                if kind == UNIGRAM:
                    known = unplanes(keys, _U), unplanes(counts)
                elif kind == BIGRAM:
                    found = LogFrequencyFilter(np.frombuffer(keys, np.uint8)[None, :], 8 * len(keys), hashes, least)
                else:  # a shard may ask in several parts
                    asker = shard
                    words.append(keys)
                    pairs.append(counts)
        if asker is not None:
            yield answer()

    return run


_SCORES = [("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]


def _score(least: int, train_tokens: int, vocabulary: int, weight: float, columns: list[str]):
    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        # Buckets are ranges of hashes, so in their order the answers are in the order of the hashes.
        told = sorted(zip(*[answers.column(n).to_pylist() for n in ("part", "keys", "counts", "levels")]), key=lambda r: r[0])
        keys, counts = _tally([unplanes(r[1], _U) for r in told], [unplanes(r[2]) for r in told]) if told else (np.zeros(0, _U),) * 2
        keys, counts = (keys, counts) if len(keys) else (np.zeros(1, _U), np.zeros(1, np.int64))
        level = np.frombuffer(b"".join(r[3] for r in told), np.uint8)
        below = float(train_tokens + vocabulary + 1)

        def known(token: np.ndarray) -> np.ndarray:
            at = np.minimum(np.searchsorted(keys, token), len(keys) - 1)
            return np.where(keys[at] == token, counts[at], 0)

        parts = [[], [], [], []]
        bodies = [x for c in texts.column("text").chunks for x in byte_lists(c)]
        held = []  # tokens once: texts' tokens, and the distinct bigrams of each slice with the places of all
        for low, high in slices(bodies):
            token, each = tokens(bodies[low:high])
            held.append((token, each, *np.unique(pair(before(token, each), token), return_inverse=True)))
        pairs = np.unique(np.concatenate([np.zeros(0, _U), *[h[2] for h in held]]))
        if len(pairs) != len(level):
            raise RuntimeError(f"{len(pairs)} bigrams, {len(level)} answers")
        for token, each, own, place in held:
            at = np.searchsorted(pairs, own)[place]
            c = known(token)
            one = (c + 1) / below
            first = np.cumsum(each) - each
            of_u = known(np.array([END], _U)).repeat(len(token))  # texts begin after an end
            of_u[1:] = c[:-1]
            of_u[first] = known(np.array([END], _U))[0]
            joint = np.minimum(least_count(level[at].astype(np.int64), least), of_u)
            p = np.where(of_u > 0, (1 - weight) * one + weight * joint / np.maximum(of_u, 1), one)
            for out, values in zip(parts, (each, np.add.reduceat((c > 0).astype(np.int64), first),
                                           np.add.reduceat(np.log10(one), first), np.add.reduceat(np.log10(p), first))):
                out.append(values)
        made = [pa.array(np.concatenate(v) if v else [], t) for v, (_, t) in zip(parts, _SCORES)]
        return pa.Table.from_arrays([texts.column(c).combine_chunks() for c in columns] + made,
                                    names=columns + [n for n, _ in _SCORES])

    return run


def score_texts(
    docs: DataFrame, training: Column, id_column: str = "doc_id", text_column: str = "text",
    bits: int = 0, hashes: int = 5, weight: float = 0.5, buckets: int | None = None, least: int = 2,
) -> DataFrame:
    """id, ``is_training``, n_tokens, n_known, train_tokens, base_score and score of each row.

    ``training`` says which rows are learned from; null counts as no. A null or empty text is one end
    token. Without training rows all counts are 0 and both scores are those of one unknown token
    for each token. Repeated rows count and score each for itself; empty tables give no rows;
    other columns are not read. Bigrams count from ``least`` on, 1 for all. The filter has ``hashes`` bits for each level
    and is half full; ``bits`` is the least size of the whole filter, for fewer false positives.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(training, F.lit(False)).alias("learn"),
                       whole(text_column).alias("text"))
    deal = partitions(docs)
    buckets = buckets or max(256, deal)
    counted = rows.filter("learn").select("text").mapInArrow(_count(buckets), _COUNTS_SQL)
    merged = materialize(counted.repartition(deal, "bucket").mapInArrow(
        _build(least, hashes, bits // buckets // 8 * 8), _MERGED_SQL), "ngrams")
    size = merged.filter(F.col("kind") == UNIGRAM).agg(F.sum("n").alias("v"), F.sum("total").alias("n")).first()

    texts = rows.withColumn("bucket", F.pmod(F.xxhash64("id", "text"), F.lit(4 * deal)).cast("bigint")).repartition(deal, "bucket")
    asked = texts.mapInArrow(_ask(buckets), _COUNTS_SQL)
    known = merged.select("kind", "bucket", F.lit(-1).cast("bigint").alias("shard"), "keys", "counts")
    answers = asked.unionByName(known).repartition(deal, "bucket").sortWithinPartitions("bucket", "kind", "shard").mapInArrow(
        _answer(hashes, least), _ANSWERS_SQL)
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, learn boolean, n_tokens bigint, n_known bigint, base_score double, score double"
    scored = texts.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(
        _score(least, size.n or 0, size.v or 0, weight, ["id", "learn"]), schema)
    return scored.select(F.col("id").alias(id_column), F.col("learn").alias("is_training"), "n_tokens", "n_known",
                         F.lit(size.n or 0).cast("bigint").alias("train_tokens"), "base_score", "score")
