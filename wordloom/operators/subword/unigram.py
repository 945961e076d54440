"""Unigram language model training (Kudo 2018) as Spark rounds over the word types.

The seeds are repeated substrings, found on a sorted suffix array that is spread over range
partitions. The pieces that a word holds are looked up once and stored as its lattice. Each round runs two
expectation steps over the lattices and drops a quarter of the pieces, those whose loss costs least likelihood, until
the wanted size is near. Steps are arrays over a batch of words, position by position. Sums of
expectations are of integers, so the model doesn't depend on how the data are dealt out.
What the driver holds is the piece table, at most ``seeds`` rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from math import exp, inf, log, log1p

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from wordloom import rules
from wordloom.operators.subword.model import SubwordModel
from wordloom.session import discard, store, store_spread

# fixed values of the published procedure
MAX_PIECE = 16
SEEDS = 1_000_000
EM_PASSES = 2
KEEP_SHARE = 0.75
NEAR_SIZE = 1.1
MIN_EXPECTED = 0.5
UNKNOWN_PENALTY = 10.0


def _suffixes(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Each position of each word with the characters from there on, combined by the thousand words."""
    def out(totals: dict[str, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(totals), pa.string()), pa.array(list(totals.values()), pa.int64())], names=["suffix", "cnt"])

    totals: dict[str, int] = {}
    for batch in batches:
        for word, cnt in zip(batch.column("word").to_pylist(), batch.column("cnt").to_pylist()):
            for i in range(len(word)):
                suffix = word[i:i + length]
                totals[suffix] = totals.get(suffix, 0) + cnt
                if len(totals) >= 100_000:
                    yield out(totals)
                    totals = {}
    yield out(totals)


def _repeats(longest: int, every: bool):
    """Sorted suffixes to the prefixes they share: a walk over the suffix array, neighbour by neighbour.

    A prefix of length k is open from the first suffix that has it to the last. It is a repeat of its own if it
    is followed by different characters, or by none (``every`` takes the others too); ``low`` and ``high`` are the characters that follow
    the first and the last of its suffixes. Prefixes of a partition's first or last suffix may go on in
    another partition and come out as open, with what is known here.
    """
    names = ["piece", "cnt", "low", "high", "open"]
    kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.bool_())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, total, front = None, 0, longest  # the first suffix's prefixes up to ``front`` are still open
        start, low, high = [0] * (longest + 1), [""] * (longest + 1), [""] * (longest + 1)
        rows: list[tuple] = []

        def close(suffix: str, shared: int, last: bool = False) -> None:
            for k in range(min(len(suffix), longest), shared, -1):
                is_open = last or k <= front
                if is_open or k == 1 or (every and total - start[k] > 1) or low[k] != high[k] or not low[k]:
                    rows.append((suffix[:k], total - start[k], low[k], high[k], is_open))

        for batch in batches:
            for suffix, cnt in zip(batch.column("suffix").to_pylist(), batch.column("cnt").to_pylist()):
                shared = 0
                if before is not None:
                    most = min(len(before), len(suffix), longest)
                    while shared < most and before[shared] == suffix[shared]:
                        shared += 1
                    close(before, shared)
                    front = min(front, shared)
                    high[shared] = suffix[shared:shared + 1]
                else:
                    front = min(longest, len(suffix))
                for k in range(shared + 1, min(len(suffix), longest) + 1):
                    start[k], low[k] = total, suffix[k:k + 1]
                    high[k] = low[k]
                total += cnt
                before = suffix
            if len(rows) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)
                rows.clear()
        if before is not None:
            close(before, 0, last=True)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    return run


def seed_pieces(types: DataFrame, max_len: int = MAX_PIECE, every: bool = False) -> DataFrame:
    """(piece, cnt, score): repeated substrings that no one-character extension always follows, as the published
    procedure has them, or ``every`` repeated substring.

    Counts are weighted by the words', the score is count x length, single characters always stay. All
    suffixes, cut one character beyond ``max_len``, are sorted over range partitions, and neighbours compared; no row
    is longer than that, however long a word is.
    """
    suffixes = types.select("word", "cnt").mapInArrow(lambda b: _suffixes(b, max_len + 1), "suffix string, cnt bigint")
    suffixes = suffixes.groupBy("suffix").agg(F.sum("cnt").alias("cnt"))
    parts = int(types.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = (suffixes.repartitionByRange(parts, "suffix").sortWithinPartitions("suffix")
             .mapInArrow(_repeats(max_len, every), "piece string, cnt bigint, low string, high string, open boolean"))
    # What comes out open is a few prefixes of each partition; the others are not split.
    return (
        found.groupBy("piece").agg(
            F.sum("cnt").alias("cnt"), F.min("low").alias("low"), F.max("high").alias("high"), F.max("low").alias("top"))
        .filter((F.length("piece") == 1) | ((F.col("cnt") >= 2) & (F.lit(every) | (F.col("low") == "") | (F.col("low") != F.greatest("high", "top")))))
        .select("piece", "cnt", (F.col("cnt") * F.length("piece")).alias("score"))
    )


def top_seeds(seeds: DataFrame, n: int) -> DataFrame:
    return seeds.orderBy(F.length("piece") > 1, F.desc("score"), "piece").limit(n)


def digamma(x: np.ndarray) -> np.ndarray:
    """Recurrence up to 6, then the asymptotic series."""
    x = np.asarray(x, dtype=np.float64).copy()
    shift = np.zeros_like(x)
    while (small := x < 6).any():
        shift[small] -= 1 / x[small]
        x[small] += 1
    inverse = 1 / (x * x)
    series = inverse * (1 / 12 - inverse * (1 / 120 - inverse * (1 / 252 - inverse / 240)))
    return shift + np.log(x) - 0.5 / x - series


def _log_add(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a if b == -inf else a + log1p(exp(b - a))


def expected_counts(word: str, scores: dict[str, float], longest: int) -> dict[str, float]:
    """Posterior expected use of each piece in a word (forward-backward)."""
    n, find = len(word), scores.get
    forward, backward = [0.0] + [-inf] * n, [-inf] * n + [0.0]
    for end in range(1, n + 1):
        total = -inf
        for start in range(max(0, end - longest), end):
            if forward[start] > -inf and (score := find(word[start:end])) is not None:
                total = _log_add(total, forward[start] + score)
        forward[end] = total
    if forward[n] == -inf:
        return {}
    out: dict[str, float] = {}
    for end in range(n, 0, -1):  # all that follows ``end`` is known by now
        after = backward[end]
        if after == -inf:
            continue
        for start in range(max(0, end - longest), end):
            piece = word[start:end]
            if forward[start] > -inf and (score := find(piece)) is not None:
                backward[start] = _log_add(backward[start], after + score)
                out[piece] = out.get(piece, 0.0) + exp(forward[start] + score + after - forward[n])
    return out


def best_path(word: str, scores: dict[str, float], longest: int, skip: str | None = None, unknown: float | None = None):
    """Most likely segmentation as (start, end, known) triples, or None if there is
    none. ``unknown`` is the score of an uncovered character."""
    n = len(word)
    best, back = [0.0] + [-inf] * n, [None] * (n + 1)
    for end in range(1, n + 1):
        for start in range(max(0, end - longest), end):
            if best[start] == -inf:
                continue
            piece = word[start:end]
            score, known = scores.get(piece), True
            if piece == skip:
                score = None
            if score is None and unknown is not None and end - start == 1:
                score, known = unknown, False
            if score is not None and best[start] + score > best[end]:
                best[end], back[end] = best[start] + score, (start, end, known)
    if best[n] == -inf:
        return None
    path, at = [], n
    while at:
        path.append(back[at])
        at = back[at][0]
    return path[::-1]


#: Expected counts are summed as integers, in parts of 2 ** -30, so that no order of tasks changes a sum.
_ONE = 1 << 30
_HALF = 40  # a sum travels as two longs, of so many bits and of the rest
_MASK = (1 << _HALF) - 1

# Words that are longer, or more frequent, are worked through one by one; so are those whose
# likelihood is too small for sums of probabilities.
_LONGEST_WORD, _MOST_COUNT, _TINY = 256, 1 << 32, 1e-200
_AT = 5  # bits of an edge's length
_AT_ONCE = 2_500  # words, of about one length, whose edges stay near the processor
_ROWS_PER_TASK = 100_000  # a task returns the sums of all pieces that its words hold
_CARRY_AFTER = 1 << 22  # additions; the lower part of a sum has room for twice as many
_LATTICE = "id int, word string, cnt bigint, at array<int>, piece array<int>"


def _lattices(names: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Words to the pieces they hold: place and length of each, by its end and then its start, and its number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {piece: i for i, piece in enumerate(names.value)}
        longest, find = max(map(len, place), default=1), place.get
        for batch in batches:
            at, piece, ends = [], [], [0]
            for word in batch.column("word").to_pylist():
                if len(word) <= _LONGEST_WORD:
                    for end in range(1, len(word) + 1):
                        for start in range(max(0, end - longest), end):
                            if (i := find(word[start:end])) is not None:
                                at.append(start << _AT | (end - start))
                                piece.append(i)
                ends.append(len(at))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("word"), batch.column("cnt"),
                 pa.ListArray.from_arrays(offsets, pa.array(at, pa.int32())), pa.ListArray.from_arrays(offsets, pa.array(piece, pa.int32()))],
                names=["id", "word", "cnt", "at", "piece"])

    return run


def _thinned(scores) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Lattices without the pieces that are gone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alive = ~np.isnan(scores.value)
        for batch in batches:
            lists, piece = batch.column("at"), batch.column("piece").flatten().to_numpy()
            keep = alive[piece]
            word = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))[keep]
            offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(word, minlength=batch.num_rows))]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("id", "word", "cnt")),
                 pa.ListArray.from_arrays(offsets, pa.array(lists.flatten().to_numpy()[keep])),
                 pa.ListArray.from_arrays(offsets, pa.array(piece[keep]))], names=["id", "word", "cnt", "at", "piece"])

    return run


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    return (batch.slice(low, _AT_ONCE) for low in range(0, batch.num_rows, _AT_ONCE))


class _Edges:
    """The edges of a batch's short words, by end, word and start. Those of pieces that are gone stay, without a chance."""

    def __init__(self, batch: pa.RecordBatch):
        self.sizes = pc.utf8_length(batch.column("word")).to_numpy().astype(np.int64)
        self.words = len(self.sizes)
        at, piece = (batch.column(c).flatten().to_numpy() for c in ("at", "piece"))
        word = np.repeat(np.arange(self.words), np.diff(batch.column("at").offsets.to_numpy()))
        start = at >> _AT
        end = start + (at & ((1 << _AT) - 1))
        order = np.argsort(end.astype(np.uint16), kind="stable")  # by radix, as words are short
        self.piece, self.word, start, self.end = piece[order], word[order], start[order], end[order]
        self.longest = int(self.end[-1]) if len(order) else 0
        # Cells are laid out position by position.
        self.source, self.target, self.last = start * np.int64(self.words) + self.word, self.end * np.int64(self.words) + self.word, self.sizes * self.words + np.arange(self.words)
        self.last = np.where(self.sizes <= self.longest, self.last, 0)
        cuts = np.searchsorted(self.end, np.arange(1, self.longest + 2))
        self.parts = [(p, slice(a, b)) for p, a, b in zip(range(1, self.longest + 1), cuts[:-1].tolist(), cuts[1:].tolist()) if a < b]

    def cells(self, fill: float) -> np.ndarray:
        return np.full((self.longest + 1) * self.words, fill)

    def posteriors(self, chance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each edge's expected use, and the words that sums of probabilities are good for."""
        p, n = chance[self.piece], self.words
        forward, backward = self.cells(0.0), self.cells(0.0)
        forward[:n] = 1.0
        for end, part in self.parts:
            forward[end * n:(end + 1) * n] = np.bincount(self.word[part], forward[self.source[part]] * p[part], n)
        total = forward[self.last]
        good = (self.sizes <= self.longest) & (total > _TINY) & (total < 1 / _TINY)
        backward[self.last] = np.where(good, 1.0, 0.0)
        onward = np.empty(len(p))
        for _, part in reversed(self.parts):  # all that follows an end is known by now
            onward[part] = backward[self.target[part]] * p[part]
            np.add.at(backward, self.source[part], onward[part])
        safe = np.where(good, total, 1.0)
        with np.errstate(invalid="ignore"):  # where sums are no good
            return np.nan_to_num(forward[self.source] * onward / safe[self.word]), good

    def best(self, scores: np.ndarray, skip: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Each word's best score and the edge that best ends at each cell, the one that starts first of equals.
        ``skip`` is a piece that a word must not use."""
        n, s = self.words, scores[self.piece]
        if skip is not None:
            s = np.where(self.piece == skip[self.word], -inf, s)
        best, back = self.cells(-inf), np.full((self.longest + 1) * self.words, -1)
        best[:n] = 0.0
        for end, part in self.parts:
            word, found = self.word[part], best[self.source[part]] + s[part]
            first = np.flatnonzero(np.diff(word, prepend=-1))
            most = np.maximum.reduceat(found, first)
            which = np.where(found == np.repeat(most, np.diff(np.append(first, len(word)))), np.arange(len(word)), len(word))
            cell = end * n + word[first]
            best[cell] = most
            back[cell] = np.where(most > -inf, np.minimum.reduceat(which, first) + part.start, -1)
        return np.where(self.sizes <= self.longest, best[self.last], -inf), back

    def uses(self, back: np.ndarray) -> np.ndarray:
        """The edges on the best paths."""
        out, at = [], self.last.copy()
        while True:
            edge = back[at]
            on = edge >= 0
            if not on.any():
                return np.concatenate(out) if out else np.zeros(0, np.int64)
            out.append(edge[on])
            at = np.where(on, self.source[np.maximum(edge, 0)], 0)


class _Sums:
    """Sums of integers for each piece, in two parts; the lower one is carried over before it overflows."""

    def __init__(self, pieces: int):
        self.low, self.high, self.added = np.zeros(pieces, np.int64), np.zeros(pieces, np.int64), 0

    def add(self, piece: np.ndarray, value: np.ndarray) -> None:
        large = np.flatnonzero(value > _MASK)
        np.add.at(self.high, piece[large], value[large] >> _HALF)
        for at in range(0, len(value), _CARRY_AFTER):
            part = value[at:at + _CARRY_AFTER]
            if self.added + len(part) > _CARRY_AFTER:
                self.carry()
            self.added += len(part)
            np.add.at(self.low, piece[at:at + _CARRY_AFTER], part & _MASK)

    def add_one(self, piece: int, value: int) -> None:
        """Of a Python integer, which may be too large for an array."""
        self.carry()
        low = int(self.low[piece]) + (value & _MASK)
        self.low[piece] = low & _MASK
        self.high[piece] += (value >> _HALF) + (low >> _HALF)

    def carry(self) -> None:
        if self.added:
            self.high += self.low >> _HALF
            self.low &= _MASK
            self.added = 0

    def parts(self, parts: int) -> pa.RecordBatch:
        """The sums as a row of lists for each part of the pieces."""
        self.carry()
        met = np.flatnonzero(self.low | self.high)
        cuts = np.searchsorted(met, np.linspace(0, len(self.low), parts + 1).astype(np.int64)).astype(np.int32)
        lists = (pa.ListArray.from_arrays(pa.array(cuts), x) for x in (pa.array(met.astype(np.int32)), pa.array(self.low[met]), pa.array(self.high[met])))
        return pa.RecordBatch.from_arrays([pa.array(np.arange(parts, dtype=np.int32)), *lists], names=["part", "i", "low", "high"])


_SUMS = "part int, i array<int>, low array<bigint>, high array<bigint>"


def _added(rows: pa.Table) -> pa.Table:
    """The tasks' sums of one part of the pieces."""
    at, low, high = (pc.list_flatten(rows.column(c)).to_numpy() for c in ("i", "low", "high"))
    met, slot = np.unique(at, return_inverse=True)
    sums = [np.zeros(len(met), np.int64) for _ in range(2)]
    for total, values in zip(sums, (low, high)):
        np.add.at(total, slot, values)
    lists = [pa.array([x.tolist()], pa.list_(kind)) for x, kind in zip((met, *sums), (pa.int32(), pa.int64(), pa.int64()))]
    return pa.Table.from_arrays([rows.column("part").slice(0, 1), *lists], names=["part", "i", "low", "high"])


def _count_job(lattice: DataFrame, names, lengths: np.ndarray, scores: np.ndarray, viterbi: bool) -> np.ndarray:
    """Weighted use of each piece over all words; tasks return one row per piece they met."""
    alive = ~np.isnan(scores)
    # A chance for each character keeps the sums of common lengths near 1.
    weight = np.where(alive, np.exp(scores), 0.0)
    shift = -float(np.sum(np.where(alive, scores, 0.0) * weight)) / max(float(np.sum(lengths * weight)), 1e-9)
    chance = np.exp(np.where(alive, scores + shift * lengths, -inf))
    shared = lattice.sparkSession.sparkContext.broadcast((scores, chance))
    parts = lattice.sparkSession.sparkContext.defaultParallelism

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores, chance = shared.value
        alive = ~np.isnan(scores)
        living = np.where(alive, scores, -inf)
        counts, table, longest = _Sums(len(scores)), None, 0
        for batch in (part for whole in batches for part in _slices(whole)):
            edges, cnt = _Edges(batch), batch.column("cnt").to_numpy()
            one_by_one = (edges.sizes > _LONGEST_WORD) | (cnt >= _MOST_COUNT)
            if viterbi:
                on = edges.uses(edges.best(living)[1])
                on = on[~one_by_one[edges.word[on]]]
                counts.add(edges.piece[on], cnt[edges.word[on]] * _ONE if len(on) else np.zeros(0, np.int64))
            else:
                use, good = edges.posteriors(chance)
                one_by_one |= ~good
                value = np.rint(use * _ONE).astype(np.int64) * np.where(one_by_one, 0, cnt)[edges.word]
                counts.add(edges.piece, value)
            for i in np.flatnonzero(one_by_one).tolist():
                if table is None:
                    spelled = names.value
                    table = {spelled[j]: (j, float(scores[j])) for j in np.flatnonzero(alive).tolist()}
                    longest = max(map(len, table))
                plain = {}
                word = batch.column("word")[i].as_py()
                for start in range(len(word)):
                    for end in range(start + 1, min(start + longest, len(word)) + 1):
                        if (hit := table.get(word[start:end])) is not None:
                            plain[word[start:end]] = hit[1]
                if viterbi:
                    uses = [(word[x:y], _ONE) for x, y, _ in best_path(word, plain, longest) or ()]
                else:
                    uses = [(piece, round(x * _ONE)) for piece, x in expected_counts(word, plain, longest).items()]
                for piece, x in uses:
                    counts.add_one(table[piece][0], x * int(cnt[i]))
        yield counts.parts(parts)

    # A task's sums are a row for each part of the pieces, not one for each piece.
    rows = lattice.mapInArrow(run, _SUMS).groupBy("part").applyInArrow(_added, _SUMS)
    found = rows.toArrow()
    shared.destroy()
    out = np.zeros(len(scores))
    at, low, high = (pc.list_flatten(found.column(c)).to_numpy() for c in ("i", "low", "high"))
    # Both terms are whole numbers of bits that a double holds, so only their sum is rounded.
    out[at] = (high + (low >> _HALF)) * float(1 << _HALF) / _ONE + (low & _MASK) / _ONE
    return out


def _em_pass(lattice: DataFrame, names, lengths: np.ndarray, scores: np.ndarray) -> np.ndarray:
    expected = _count_job(lattice, names, lengths, scores, viterbi=False)
    alive = ~np.isnan(scores)
    # A character the corpus holds keeps a small count even if larger pieces cover it.
    expected = np.where(lengths == 1, np.maximum(expected, MIN_EXPECTED), expected)
    kept = np.flatnonzero(alive & (expected >= MIN_EXPECTED))
    out = np.full(len(scores), np.nan)
    out[kept] = digamma(expected[kept]) - digamma(np.array([expected[kept].sum()]))
    return out


def _losses(pieces: DataFrame, scores: np.ndarray, used: np.ndarray) -> np.ndarray:
    """Likelihood lost by segmenting each piece into its best alternative; infinite where there is none."""
    total = float(used.sum()) or 1.0
    shared = pieces.sparkSession.sparkContext.broadcast((scores, used))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores, used = shared.value
        alive = ~np.isnan(scores)
        living = np.where(alive, scores, -inf)
        for batch in (part for whole in batches for part in _slices(whole.filter(pa.array(alive[whole.column("id").to_numpy()])))):
            own = batch.column("id").to_numpy()
            other = _Edges(batch).best(living, own)[0]
            lost = np.where(other == -inf, inf, used[own] / total * (scores[own] - np.where(other == -inf, 0.0, other)))
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(lost)], names=["id", "x"])

    found = pieces.mapInArrow(run, "id int, x double").toArrow()
    shared.destroy()
    out = np.full(len(scores), np.nan)
    out[found.column("id").to_numpy()] = found.column("x").to_numpy()
    return out


def _pruned(scores: np.ndarray, lengths: np.ndarray, loss: np.ndarray, size: int) -> np.ndarray:
    """The characters and the pieces of largest loss, ``size`` in all where characters leave room."""
    chars = np.flatnonzero(~np.isnan(scores) & (lengths == 1))
    long = np.flatnonzero(~np.isnan(loss))
    # Pieces are numbered in their order, by which ties are broken.
    keep = np.concatenate([chars, long[np.argsort(-loss[long], kind="stable")][:max(size - len(chars), 0)]])
    out = np.full(len(scores), np.nan)
    out[keep] = scores[keep]
    return out


def _finished(names: Sequence[str], lengths: np.ndarray, scores: np.ndarray, wanted: int) -> SubwordModel:
    alive = np.flatnonzero(~np.isnan(scores))
    ranked = alive[np.argsort(-scores[alive], kind="stable")]
    room = max(wanted - int((lengths[ranked] == 1).sum()), 0)
    kept = ranked[(lengths[ranked] == 1) | (np.cumsum(lengths[ranked] > 1) <= room)].tolist()
    return SubwordModel("unigram", [rules.UNK, *(names[i] for i in kept)], [], [], [0.0, *(float(scores[i]) for i in kept)])


def train_unigram_sizes(types: DataFrame, sizes: Sequence[int], seeds: int = SEEDS) -> dict[int, SubwordModel]:
    """A model for each vocabulary size, from a ``(word, cnt)`` table and at most so many seeds.

    Pruning for one size is pruning for a larger one until that is near, so all sizes share the
    rounds and each model is what training it alone gives. Which pieces a word holds is looked up once
    and kept as a table of lattices, which is written anew, without the pieces that are gone, as these fall to half.
    """
    spark = types.sparkSession
    types, types_path = store_spread(types.select("word", "cnt"), "types", _ROWS_PER_TASK)
    found = top_seeds(seed_pieces(types), seeds).toArrow()
    found = dict(zip(found.column("piece").to_pylist(), found.column("score").to_pylist()))
    total = float(sum(found.values())) or 1.0
    names = sorted(found)
    lengths = np.array([len(p) for p in names], np.int64)
    scores = np.array([log(found[p] / total) for p in names])
    shared = spark.sparkContext.broadcast(names)
    paths: list[str] = []

    def lattice(rows: DataFrame, label: str) -> DataFrame:
        table, path = store(rows.mapInArrow(_lattices(shared), _LATTICE), label)
        paths.append(path)
        return table

    words = lattice(types.select(F.lit(0).alias("id"), "word", "cnt").sortWithinPartitions(F.length("word")), "lattice")
    discard(spark, types_path)
    pieces, written = None, len(names)

    def list_pieces(scores: np.ndarray) -> None:
        """The lattices of the pieces that the first passes leave."""
        nonlocal pieces
        multiple = np.flatnonzero(~np.isnan(scores) & (lengths > 1)).tolist()
        listed = pa.table([pa.array(multiple, pa.int32()), pa.array([names[i] for i in multiple], pa.string())], names=["id", "word"])
        parts = max(spark.sparkContext.defaultParallelism, len(multiple) // 20_000)
        pieces = lattice(spark.createDataFrame(listed).repartition(parts).sortWithinPartitions(F.length("word")).select(
            "id", "word", F.lit(1).cast("bigint").alias("cnt")), "pieces")

    def thin(scores: np.ndarray) -> None:
        nonlocal words, pieces, written
        if pieces is None:
            list_pieces(scores)
        if 2 * int((~np.isnan(scores)).sum()) > written:
            return
        gone, paths[:] = paths[:], []
        now = spark.sparkContext.broadcast(scores)
        (words, one), (pieces, two) = (store(t.mapInArrow(_thinned(now), _LATTICE), label)
                                       for t, label in ((words, "lattice"), (pieces, "pieces")))
        paths.extend([one, two])
        now.destroy()
        for path in gone:
            discard(spark, path)
        written = int((~np.isnan(scores)).sum())

    def expect(scores: np.ndarray) -> np.ndarray:
        for _ in range(EM_PASSES):
            scores = _em_pass(words, shared, lengths, scores) if len(scores) else scores
        return scores

    # One place is the unknown token's; characters are never dropped.
    target = {size: max(int(NEAR_SIZE * (size - 1)), 1) for size in sizes}
    models: dict[int, SubwordModel] = {}
    scores = expect(scores)
    while len(models) < len(target):
        left = [s for s in sorted(target, reverse=True) if s not in models]
        size, chars = int((~np.isnan(scores)).sum()), int((~np.isnan(scores) & (lengths == 1)).sum())
        done = [s for s in left if size <= target[s] or size == chars]
        if not done:
            thin(scores)
            loss, smaller = _losses(pieces, scores, _count_job(words, shared, lengths, scores, viterbi=True)), int(KEEP_SHARE * size)
            for s in left:
                if smaller <= target[s]:
                    models[s] = _finished(names, lengths, expect(_pruned(scores, lengths, loss, target[s])), s - 1)
            if len(models) < len(target):
                scores = expect(_pruned(scores, lengths, loss, smaller))
        for s in done:
            models[s] = _finished(names, lengths, scores, s - 1)
    for path in paths:
        discard(spark, path)
    shared.destroy()
    return {size: models[size] for size in sizes}


def train_unigram(types: DataFrame, vocab_size: int = 16_000, seeds: int = SEEDS) -> SubwordModel:
    """Learn pieces and log probabilities from a ``(word, cnt)`` table."""
    return train_unigram_sizes(types, [vocab_size], seeds)[vocab_size]
