"""Numbers of tokens of many words at once, for several models.

Evaluation needs of a word's tokens only how many they are, where they spell it. Models of a kind share what they can:
unigram and WordPiece models one walk through a trie of all their pieces, BPE models that are cut from one training its
merges. Words that are long, or hold a character that a model doesn't know or a mark, are left to the encoders.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from wordloom import rules
from wordloom.operators.subword.merging import _found, pack_merges
from wordloom.operators.subword.model import SubwordModel

_LONGEST = rules.WORDPIECE_MAX_CHARS
_AT_ONCE = 20_000  # words whose arrays stay near the processor
_CODE = 21  # bits of a code point


class _Trie:
    """Pieces as paths of characters; a step is a search in the sorted edges of all nodes."""

    def __init__(self, pieces: Sequence[str]):
        nodes = {"": 0}
        edges = []
        for piece in pieces:
            for end in range(len(piece), 0, -1):
                if piece[:end] in nodes:
                    break
                nodes[piece[:end]] = len(nodes)
        for path, node in nodes.items():
            if path:
                edges.append((nodes[path[:-1]] << _CODE | ord(path[-1]), node))
        edges.sort()
        self.nodes = nodes
        self.keys, self.child = (np.array(x, np.int64) for x in zip(*edges)) if edges else (np.zeros(0, np.int64),) * 2
        self.piece = np.full(len(nodes), -1)
        self.piece[[nodes[p] for p in pieces]] = np.arange(len(pieces))

    def walk(self, codes: np.ndarray, left: np.ndarray, node: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
        """(places, length, pieces) of the pieces that begin at each place, by length; ``left`` says how many characters a
        place's word has from there on, ``node`` where its walk begins."""
        at, length = np.arange(len(codes)), 0
        while len(at) and len(self.keys):
            slot, hit = _found(self.keys, node << _CODE | codes[at + length])
            node, at, length = self.child[slot[hit]], at[hit], length + 1
            piece = self.piece[node]
            ends = piece >= 0
            yield at[ends], length, piece[ends]
            more = left[at] > length
            node, at = node[more], at[more]


class _Words:
    """Code points of words one after the other."""

    def __init__(self, words: Sequence[str]):
        self.codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        self.sizes = np.fromiter(map(len, words), np.int64, len(words))
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        self.word = np.repeat(np.arange(len(words)), self.sizes)
        self.left = self.ends[self.word] - np.arange(len(self.codes))


class _Unigram:
    def __init__(self, models: Sequence[SubwordModel]):
        pieces = sorted({t for m in models for t in m.vocab[1:]})
        place = {p: i for i, p in enumerate(pieces)}
        self.trie, self.scores = _Trie(pieces), np.full((len(models), len(pieces)), -np.inf)
        for scores, model in zip(self.scores, models):
            scores[[place[t] for t in model.vocab[1:]]] = model.scores[1:]

    def count(self, words: _Words) -> np.ndarray:
        found = list(self.trie.walk(words.codes, words.left, np.zeros(len(words.codes), np.int64)))
        out = np.full((len(self.scores), len(words.sizes)), -1)
        if not found:
            return out
        start = np.concatenate([at for at, *_ in found])
        length = np.repeat([n for _, n, _ in found], [len(at) for at, *_ in found])
        piece = np.concatenate([p for *_, p in found])
        # By the end within the word, and of those that end there the longest first: of equals, it is taken.
        end = words.sizes[words.word[start]] - words.left[start] + length
        group = (end * (length.max() + 1) - length).astype(np.uint16 if _LONGEST * (length.max() + 1) < 1 << 16 else np.int64)
        order = np.argsort(group, kind="stable")
        group, piece = group[order], piece[order]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(group)]])
        # A word has a cell more than it has characters.
        source = (start + words.word[start])[order]
        target = source + length[order]
        first, last = words.starts + np.arange(len(words.sizes)), words.ends + np.arange(len(words.sizes))
        for row, scores in zip(out, self.scores):
            score = scores[piece]
            best, tokens = np.full(len(words.codes) + len(words.sizes), -np.inf), np.zeros(len(words.codes) + len(words.sizes), np.int64)
            best[first] = 0.0
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                s, t = source[a:b], target[a:b]
                sums = best[s] + score[a:b]
                better = sums > best[t]
                s, t = s[better], t[better]
                best[t], tokens[t] = sums[better], tokens[s] + 1
            row[:] = np.where(np.isfinite(best[last]), tokens[last], -1)
        # What an unknown character would cost is the encoder's business.
        known = np.zeros((len(self.scores), len(words.codes)), bool)
        at, _, single = found[0]
        known[:, at] = np.isfinite(self.scores[:, single])
        for row, k in zip(out, known):
            row[words.word[~k]] = -1
        return out


class _WordPiece:
    def __init__(self, models: Sequence[SubwordModel]):
        pieces = sorted({t for m in models for t in m.vocab[1:]})
        place = {p: i for i, p in enumerate(pieces)}
        self.trie, self.has = _Trie(pieces), np.zeros((len(models), len(pieces)), bool)
        for has, model in zip(self.has, models):
            has[[place[t] for t in model.vocab[1:]]] = True

    def count(self, words: _Words) -> np.ndarray:
        out = np.full((len(self.has), len(words.sizes)), -1)
        node = np.full(len(words.codes), self.trie.nodes.get(rules.CONTINUATION, -1))
        node[words.starts] = 0
        longest = np.zeros((len(self.has), len(words.codes) + 1), np.int64)
        for at, length, piece in self.trie.walk(words.codes, words.left, node):
            for row, has in zip(longest, self.has):
                row[at[has[piece]]] = length
        for row, step in zip(out, longest):
            which, at, n = np.arange(len(words.sizes)), words.starts, 0
            while len(which):
                n += 1
                width = step[at]
                on = width > 0  # the others cannot be covered
                which, at = which[on], (at + width)[on]
                ended = at == words.ends[which]
                row[which[ended]] = n
                which, at = which[~ended], at[~ended]
        return out


class _Merged:
    """BPE models whose merges are the first of the largest one's."""

    def __init__(self, models: Sequence[SubwordModel]):
        largest = max(models, key=lambda m: len(m.merges))
        characters = sorted((ord(t), i) for i, t in enumerate(largest.vocab[:largest.base_size]) if i and len(t) == 1)
        self.codes, self.ids = (np.array(x, np.int64) for x in zip(*characters)) if characters else (np.zeros(0, np.int64),) * 2
        self.merges = pack_merges([(*pair, new) for pair, new in zip(largest.merges, largest.merge_ids)]) if largest.merges else None
        self.cuts = [len(m.merges) for m in models]

    def count(self, words: _Words) -> np.ndarray:
        out = np.tile(words.sizes, (len(self.cuts), 1))
        if not len(self.codes):
            out[:] = -1
            return out
        slot, known = _found(self.codes, words.codes)
        ids, word = self.ids[slot], words.word
        if self.merges is not None:
            self._merge(ids, word, out)
        out[:, words.word[~known]] = -1
        return out

    def _merge(self, ids: np.ndarray, word: np.ndarray, out: np.ndarray) -> None:
        code, place, new = self.merges
        none = len(new)
        while len(ids) > 1:
            slot, hit = _found(code, (ids[:-1] << 32) | ids[1:])
            rank = np.append(np.where(hit & (word[:-1] == word[1:]), place[slot], none), none)
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            best, sizes = np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(word)))
            on = best < none
            active = np.repeat(on, sizes)
            ids, word, rank, best, sizes = ids[active], word[active], rank[active], best[on], sizes[on]
            if not len(ids):
                return
            at = np.flatnonzero(rank == np.repeat(best, sizes))
            # Runs of one symbol merge left to right: every second match of a run counts.
            first, run = np.diff(at, prepend=-2) != 1, np.arange(len(at))
            at = at[(run - np.maximum.accumulate(np.where(first, run, 0))) % 2 == 0]
            ids[at] = new[rank[at]]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids, word = ids[keep], word[keep]
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            sizes = np.diff(np.append(starts, len(word)))
            for row, cut in zip(out, self.cuts):
                now = best < cut
                row[word[starts[now]]] = sizes[now]


def _groups(models: Sequence[SubwordModel]) -> Iterator[tuple[list[int], type]]:
    """Numbers of the models that are counted together, and how. A merge whose symbol was there before it
    is in no group: what it makes may go into earlier merges."""
    for kind, how in (("unigram", _Unigram), ("wordpiece", _WordPiece)):
        if same := [i for i, m in enumerate(models) if m.kind == kind]:
            yield same, how
    rest = [i for i, m in enumerate(models) if m.kind == "bpe" and m.merge_ids == list(range(m.base_size, m.base_size + len(m.merges)))]
    while rest:
        largest = models[max(rest, key=lambda i: len(models[i].merges))]
        same = [i for i in rest if (m := models[i]).merges == largest.merges[:len(m.merges)]
                and m.vocab[:m.base_size] == largest.vocab[:largest.base_size]]
        yield same, _Merged
        rest = [i for i in rest if i not in same]


class Counter:
    """How many tokens words have by each model."""

    def __init__(self, models: Mapping[str, SubwordModel]):
        self.models = list(models.values())
        self.groups = [(same, how([self.models[i] for i in same])) for same, how in _groups(self.models)]

    def counts(self, words: pa.Array, spelled: Sequence[str]) -> np.ndarray:
        """A row for each model, -1 for the words that are left to its encoder; the others' tokens spell them."""
        out = np.full((len(self.models), len(spelled)), -1)
        size = pc.utf8_length(words).to_numpy()
        marked = pc.or_(pc.match_substring(words, rules.CONTINUATION), pc.match_substring(words, rules.UNK)).to_numpy(zero_copy_only=False)
        plain = np.flatnonzero((size > 0) & (size <= _LONGEST) & ~marked)
        for low in range(0, len(plain), _AT_ONCE):
            part = plain[low:low + _AT_ONCE]
            batch = _Words([spelled[i] for i in part.tolist()])
            for same, group in self.groups:
                for i, row in zip(same, group.count(batch)):
                    out[i, part] = row
        return out
