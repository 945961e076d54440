"""Training by pair merging (BPE and WordPiece) as a sequence of Spark rounds.

State is a table of symbol-id arrays with counts, kept as files in the shared work folder. A round
is two jobs and decides many merges, also ones that build on each other, exactly as
one-at-a-time training would pick them:

1. Adjacent pairs are counted (per Arrow batch, per task, over the cluster) and ranked by count, then
   ids. The first ``top`` of them are the *likely* pairs; the best of the others is the *bar*.
2. Words are cut wherever two neighbours aren't a likely pair. What is left are short *contexts*, which
   are counted like the pairs. The driver merges in the contexts until the bar is the best pair.

Any pair that merging makes covers a border between two neighbours, and is no more frequent than
that border's pair is now. So pairs that come before the bar lie within contexts as a whole, and
their counts there are their counts in the corpus. The one exception is a merge that spells a
symbol which is there already and so adds to that symbol's pairs: such a merge ends its round.

``contexts`` bounds how many distinct contexts come to the driver; where there are more, fewer
pairs are taken as likely. Pending merges are applied while the state is read and written
into it every few rounds, words of one symbol dropping out. Nothing is cached and no lineage grows, so
a lost executor costs the repetition of its tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wordloom import rules
from wordloom.operators.subword.model import SubwordModel
from wordloom.operators.subword.types import alphabet
from wordloom.session import discard, store, store_spread

_REWRITE_EVERY = 4
_FIRST_TOP, _MOST_TOP = 128, 50_000
_STATE = "symbols array<int>, cnt bigint"
_SHIFT = np.int64(32)
_LOW = np.int64(0xFFFFFFFF)

#: Merges of one round as sorted pair codes, with their places in the round and new ids.
Merges = tuple[np.ndarray, np.ndarray, np.ndarray]


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Concatenated symbols of a batch and the word each belongs to."""
    symbols = batch.column("symbols")
    lengths = np.diff(symbols.offsets.to_numpy())
    return symbols.flatten().to_numpy().astype(np.int64), np.repeat(np.arange(len(lengths)), lengths)


def pack_merges(merges: Sequence[tuple[int, int, int]]) -> Merges:
    left, right, new = (np.array(x, np.int64) for x in zip(*merges))
    code = (left << _SHIFT) | right
    order = np.argsort(code)
    return code[order], order, new


def _found(code: np.ndarray, sought: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each sought code is in a sorted array, and whether it is there."""
    slot = np.minimum(np.searchsorted(code, sought), len(code) - 1)
    return slot, code[slot] == sought


def apply_merges(ids: np.ndarray, word: np.ndarray, merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """The symbols after all merges of a round, in their order, and the words they belong to.

    Each step applies to every word the first merge, after those it had, that it has a pair for.
    """
    code, place, new = merges
    none = len(new)
    done: list[tuple[np.ndarray, np.ndarray]] = []
    last = np.full(int(word[-1]) + 1 if len(word) else 0, -1)
    while len(ids) > 1:
        slot, hit = _found(code, (ids[:-1] << _SHIFT) | ids[1:])
        rank = np.where(hit & (word[:-1] == word[1:]), place[slot], none)
        rank[rank <= last[word[:-1]]] = none
        rank = np.append(rank, none)
        starts = np.flatnonzero(np.diff(word, prepend=-1))
        best = np.minimum.reduceat(rank, starts)
        sizes = np.diff(np.append(starts, len(word)))
        active = np.repeat(best < none, sizes)
        if not active.all():
            done.append((ids[~active], word[~active]))
            ids, word, rank = ids[active], word[active], rank[active]
            sizes, best = sizes[best < none], best[best < none]
        if not len(ids):
            break
        at = np.flatnonzero(rank == np.repeat(best, sizes))
        # Runs of one symbol merge left to right: every second match of a run counts.
        first = np.diff(at, prepend=-2) != 1
        run = np.arange(len(at))
        at = at[(run - np.maximum.accumulate(np.where(first, run, 0))) % 2 == 0]
        last[word[at]] = rank[at]
        ids[at] = new[rank[at]]
        keep = np.ones(len(ids), bool)
        keep[at + 1] = False
        ids, word = ids[keep], word[keep]
    done.append((ids, word))
    ids, word = (np.concatenate(x) for x in zip(*done))
    order = np.argsort(word, kind="stable")
    return ids[order], word[order]


def _apply(batch: pa.RecordBatch, pending: Sequence[Merges]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, word = _flat(batch)
    for merges in pending:
        ids, word = apply_merges(ids, word, merges)
    return ids, word, batch.column("cnt").to_numpy()


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1))
    return keys[first], np.add.reduceat(counts, first)


def _pair_counts(pending) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, word, cnt = _apply(batch, pending)
            inside = word[:-1] == word[1:]
            pairs = ((ids[:-1] << _SHIFT) | ids[1:])[inside]
            if not len(pairs):
                continue
            unique, total = _summed(pairs, cnt[word[:-1][inside]])
            yield pa.RecordBatch.from_arrays(
                [pa.array((unique >> _SHIFT).astype(np.int32)), pa.array((unique & _LOW).astype(np.int32)),
                 pa.array(total)], names=["l", "r", "c"])

    return run


def _contexts(pending, likely: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Runs of likely pairs as binary keys of symbol ids, with counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, word, cnt = _apply(batch, pending)
            if len(ids) < 2:
                continue
            code = (ids[:-1] << _SHIFT) | ids[1:]
            _, hit = _found(likely, code)
            hit &= word[:-1] == word[1:]
            edges = np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))
            low, high = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)  # symbols low .. high
            totals: dict[bytes, int] = {}
            single = high - low == 1
            if single.any():
                found, n = _summed(code[low[single]], cnt[word[low[single]]])
                both = np.stack((found >> _SHIFT, found & _LOW), 1).astype("<i4")
                totals.update(zip((row.tobytes() for row in both), n.tolist()))
            data = ids.astype("<i4").tobytes()
            for a, b, n in zip(low[~single].tolist(), high[~single].tolist(), cnt[word[low[~single]]].tolist()):
                key = data[4 * a:4 * b + 4]
                totals[key] = totals.get(key, 0) + n
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(totals), pa.binary()), pa.array(list(totals.values()), pa.int64())], names=["key", "c"])

    return run


def decide(
    contexts: Sequence[tuple[Sequence[int], int]], bar: tuple[int, int, int] | None, least: int,
    spell: Callable[[int, int], tuple[int, bool] | None],
) -> list[tuple[int, int, int]]:
    """Merges (left, right, new) of counted contexts, in order, as long as they come before the bar.

    The bar is (count, left, right) of a pair outside; ``least`` the smallest count. ``spell`` gives a merge's id and
    whether that symbol was there already, or None when there is no room for it.
    """
    words = [list(ids) for ids, _ in contexts]
    weight = [n for _, n in contexts]
    counts: dict[tuple[int, int], int] = {}
    holders: dict[tuple[int, int], set[int]] = {}
    for i, ids in enumerate(words):
        for pair in zip(ids, ids[1:]):
            counts[pair] = counts.get(pair, 0) + weight[i]
            holders.setdefault(pair, set()).add(i)
    heap = [(-n, *pair) for pair, n in counts.items()]
    heapify(heap)
    limit = (-bar[0], *bar[1:]) if bar else None
    made: list[tuple[int, int, int]] = []
    while heap:
        top = heappop(heap)
        pair = top[1:]
        n = counts.get(pair, 0)
        if n != -top[0]:
            if n:
                heappush(heap, (-n, *pair))
            continue
        if n < least or (limit and top > limit):
            break
        spelled = spell(*pair)
        if spelled is None:
            break
        new, known = spelled
        made.append((*pair, new))
        if known:
            break
        touched: set[tuple[int, int]] = set()
        for i in holders.pop(pair):
            ids = words[i]
            for p in zip(ids, ids[1:]):
                counts[p] -= weight[i]
            merged, k = [], 0
            while k < len(ids):
                if k + 1 < len(ids) and ids[k] == pair[0] and ids[k + 1] == pair[1]:
                    merged.append(new)
                    k += 2
                else:
                    merged.append(ids[k])
                    k += 1
            words[i] = merged
            for p in zip(merged, merged[1:]):
                counts[p] = counts.get(p, 0) + weight[i]
                if new in p:
                    touched.add(p)
                    holders.setdefault(p, set()).add(i)
        for p in touched:
            heappush(heap, (-counts[p], *p))
    return made


def _rewrite(pending) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, word, cnt = _apply(batch, pending)
            sizes = np.bincount(word, minlength=len(cnt)) if len(word) else np.zeros(len(cnt), int)
            keep = sizes > 1
            kept_ids = ids[keep[word]] if len(ids) else ids
            offsets = np.concatenate([[0], np.cumsum(sizes[keep])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(kept_ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([lists, pa.array(cnt[keep])], names=["symbols", "cnt"])

    return run


def _initial_state(types: DataFrame, first: dict[str, int], later: dict[str, int]) -> DataFrame:
    """Words as symbol ids; ``later`` holds the ids of non-initial characters."""
    codes = np.array(sorted(map(ord, first)), np.uint32)
    ids = [np.array([of.get(chr(c), -1) for c in codes.tolist()], np.int32) for of in (first, later)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            words = batch.column("word").to_pylist()
            offsets = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))]).astype(np.int32)
            at = np.searchsorted(codes, np.frombuffer("".join(words).encode("utf-32-le"), np.uint32))
            symbols = ids[1][at]
            symbols[offsets[:-1]] = ids[0][at[offsets[:-1]]]
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array(offsets), pa.array(symbols)), batch.column("cnt")], names=["symbols", "cnt"]
            )

    return types.select("word", "cnt").filter(F.length("word") > 1).mapInArrow(run, _STATE)


def train(
    types: DataFrame, vocab_size: int, min_frequency: int = 2, kind: str = "bpe", contexts: int = 100_000,
) -> SubwordModel:
    """Learn merges from a ``(word, cnt)`` table until the vocabulary is full or no pair
    reaches ``min_frequency``. At most ``contexts`` distinct contexts come to the driver at a time."""
    prefix = rules.CONTINUATION if kind == "wordpiece" else ""
    spark = types.sparkSession
    types, types_path = store_spread(types.select("word", "cnt"), "types")
    chars = alphabet(types)
    vocab = [rules.UNK, *chars]
    if prefix:
        tails = types.select(
            F.explode(F.split(F.expr("substring(word, 2)"), "")).alias("c")
        ).filter(F.col("c") != "").distinct()
        vocab += [prefix + c for c in sorted(r.c for r in tails.collect())]
    index = {t: i for i, t in enumerate(vocab)}
    base = len(vocab)
    first = {c: index[c] for c in chars}
    later = {c: index[prefix + c] for c in chars if prefix + c in index}

    state, state_path = store(_initial_state(types, first, later), f"{kind}-state")
    discard(spark, types_path)
    merges, merge_ids, pending = [], [], []

    def spell(left: int, right: int) -> tuple[int, bool] | None:
        tail = vocab[right]
        text = vocab[left] + (tail[len(prefix):] if prefix and tail.startswith(prefix) else tail)
        if len(vocab) >= vocab_size:  # a full vocabulary ends training, also where a merge would need no room
            return None
        if text in index:
            return index[text], True
        index[text] = len(vocab)
        vocab.append(text)
        return index[text], False

    top, least = _FIRST_TOP, max(min_frequency, 1)
    while len(vocab) < vocab_size:
        ranked = (
            state.mapInArrow(_pair_counts(pending), "l int, r int, c bigint")
            .groupBy("l", "r").agg(F.sum("c").alias("c")).filter(F.col("c") >= least)
            .orderBy(F.desc("c"), "l", "r").limit(_MOST_TOP + 1).collect()
        )
        if not ranked:
            break
        while True:
            top = min(top, _MOST_TOP, len(ranked))
            likely = np.sort(np.array([(r.l << 32) | r.r for r in ranked[:top]], np.int64))
            found = (state.mapInArrow(_contexts(pending, likely), "key binary, c bigint")
                     .groupBy("key").agg(F.sum("c").alias("c")).limit(contexts + 1).collect())
            # One pair alone has no contexts but itself, or runs of one symbol.
            if len(found) <= contexts or top == 1:
                break
            top = max(top // 4, 1)
        bar = (ranked[top].c, ranked[top].l, ranked[top].r) if top < len(ranked) else None
        made = decide([(np.frombuffer(r.key, "<i4").tolist(), r.c) for r in found], bar, least, spell)
        if not made:
            break
        merges += [(left, right) for left, right, _ in made]
        merge_ids += [new for *_, new in made]
        pending.append(pack_merges(made))
        if 4 * len(found) < contexts:
            top *= 2
        if len(pending) == _REWRITE_EVERY:
            replaced = state_path
            state, state_path = store(state.mapInArrow(_rewrite(pending), _STATE), f"{kind}-state")
            discard(spark, replaced)
            pending = []
    discard(spark, state_path)
    return SubwordModel(kind, vocab, merges, merge_ids, [], base)


def train_bpe(types: DataFrame, vocab_size: int = 16_000, min_frequency: int = 2) -> SubwordModel:
    return train(types, vocab_size, min_frequency, "bpe")


def train_wordpiece(types: DataFrame, vocab_size: int = 16_000, min_frequency: int = 2) -> SubwordModel:
    return train(types, vocab_size, min_frequency, "wordpiece")


def first_pairs(types: DataFrame) -> DataFrame:
    """Adjacent character pairs with their counts: the ranking of the first merge."""
    chars = F.split("word", "")
    pairs = F.zip_with(
        F.slice(chars, 1, F.size(chars) - 1), F.slice(chars, 2, F.size(chars) - 1),
        lambda a, b: F.struct(a.alias("left"), b.alias("right")),
    )
    return (
        types.filter(F.length("word") > 1).select("cnt", F.explode(pairs).alias("p"))
        .groupBy("p.left", "p.right").agg(F.sum("cnt").alias("cnt"))
    )
