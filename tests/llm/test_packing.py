import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from wordloom.llm import packing

JSON, RANKS = (public_tokenizers.path(f"byte_bpe_50k.{x}") for x in ("json", "tiktoken"))


def check_plan(counts, capacity):
    counts = {s: n for s, n in counts.items() if n}
    places = packing.plan(counts, capacity)
    bins, total = {}, 0
    for s, n in counts.items():
        numbers = [p[0] for p in places[s]] + [n]
        assert numbers == sorted(numbers) and (not n or numbers[0] == 0)
        for (start, first, each, offset), end in zip(places[s], numbers[1:]):
            for i in range(end - start):
                bins.setdefault(first + i // each, []).append((offset + i % each * s, s))
        total += s * n
    for pieces in bins.values():
        at = 0
        for offset, s in sorted(pieces):
            assert offset == at
            at += s
        assert at <= capacity
    assert sum(len(p) for p in bins.values()) == sum(counts.values())
    return len(bins), -(-total // capacity)


def first_fit(counts, capacity):
    gaps = []
    for s in sorted((s for s, n in counts.items() for _ in range(n)), reverse=True):
        fits = [i for i, g in enumerate(gaps) if g >= s]
        if fits:
            gaps[min(fits, key=lambda i: gaps[i])] -= s
        else:
            gaps.append(capacity - s)
    return len(gaps)


@pytest.mark.parametrize("seed", range(25))
def test_plans(seed):
    rng = random.Random(seed)
    capacity = rng.choice([1, 2, 7, 30, 100])
    counts = {s: rng.randint(0, rng.choice([1, 3, 40])) for s in range(1, capacity + 1) if rng.random() < 0.6}
    used, least = check_plan(counts, capacity)
    assert least <= used <= first_fit(counts, capacity) + max(1, used // 20)


def test_large_pieces_go_in_pairs():
    assert check_plan({60: 10, 40: 10}, 100)[0] == 10
    assert check_plan({50: 7}, 100)[0] == 4
    assert check_plan({}, 100)[0] == 0


def test_cut():
    assert packing.cut(10, 4) == [(0, 2), (2, 4), (6, 4)]
    assert packing.cut(8, 4) == [(0, 4), (4, 4)]
    assert packing.cut(3, 4) == [(0, 3)]


def test_ids_are_the_tokenizers(spark):
    rng = random.Random(3)
    parts = ["the ", "Ünï", "\n\n", "  ", "123", "'s", "<|endoftext|>", "😀", "\t", "a" * 50, "§", "مرحبا", "​", " \r\n"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(400)]
    own, fast = Tokenizer.from_file(JSON), packing.encoder(JSON, RANKS)
    assert all(own.encode(t, add_special_tokens=False).ids == fast(t) for t in texts)


@pytest.mark.parametrize("ranks", [None, RANKS])
def test_documents(odd, odd_rows, ranks):
    own = Tokenizer.from_file(JSON)
    got = packing.pack(odd, JSON, ranks, capacity=64).collect()
    sequences, pieces = {}, {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.setdefault(r.doc_id, []).append(r)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    for id_, text in {r[0]: r[1] for r in odd_rows if r[0] not in (None, 1)}.items():
        ids = np.array(own.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        mine = sorted(pieces[id_], key=lambda r: r.piece)
        assert [(r.start, r.length) for r in mine] == packing.cut(len(ids), 64)
        assert [r.ids_crc32 for r in mine] == [zlib.crc32(ids[r.start:r.start + r.length].tobytes()) for r in mine]
    assert len(pieces[1]) == 2 and len(pieces[None]) == 2


def test_empty_table(none):
    assert packing.pack(none, JSON, RANKS).collect() == []
