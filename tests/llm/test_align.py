import hashlib
from collections import Counter
from itertools import accumulate

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

import public_tokenizers as P
from tests.llm.conftest import LONG
from wordloom.llm import align

RANKS, JSON, MODEL = (P.path(n) for n in ("byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "piece_bpe_32k.model"))


def byte_of():
    """The byte that each character of a byte-level vocabulary stands for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@pytest.fixture(scope="module")
def tools():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(JSON), SentencePieceProcessor(model_file=MODEL)
    a.encode_special_tokens = True
    of = byte_of()
    bytes_a = {i: bytes(of[c] for c in t) for t, i in a.get_vocab().items() if not t.startswith("<|end")}
    bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
               for i, p in ((i, b.id_to_piece(i)) for i in range(b.get_piece_size()))]
    return a, b, bytes_a, bytes_b


def groups_of(tools, text):
    a, b, bytes_a, bytes_b = tools
    if not text:
        return None
    ia, ib = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    want = (" " + text).encode()
    if b"".join(bytes_a[i] for i in ia) != want or b"".join(bytes_b[i] for i in ib) != want:
        return None
    ea, eb = list(accumulate(len(bytes_a[i]) for i in ia)), list(accumulate(len(bytes_b[i]) for i in ib))
    out, i, j = [], 0, 0
    for end in sorted(set(ea) & set(eb)):
        ni, nj = ea.index(end, i) + 1, eb.index(end, j) + 1
        out.append((ia[i:ni], ib[j:nj]))
        i, j = ni, nj
    return ia, ib, out


def brute(tools, texts):
    found = [groups_of(tools, t) for t in texts]
    links = [[(g[0][-1], g[1][-1]) for g in f[2]] if f else [] for f in found]
    count = Counter(x for own in links for x in own)
    best = {}
    for (_, b), n in count.items():
        best[b] = max(n, best.get(b, 0))
    rows = []
    for f, own in zip(found, links):
        spelled = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in f[2]) if f else ""
        rows.append((len(f[0]) if f else 0, len(f[1]) if f else 0, len(own), len(own), sum(count[x] == best[x[1]] for x in own),
                     sum(count[x] for x in own), hashlib.sha256(spelled.encode()).hexdigest() if f else ""))
    return rows, count


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = ["a", " ", "  a  b ", "\n\n x", "Ünïcödé — 日本 😀😀", "▁", "a▁b", "<s> x </s>", "<|endoftext|> y", "\x00a\x7f", "don't 12,345.67",
       "x" * 3000, "é" * 2000, "\t \r\n", "ab " * 500, "ab  " * 500, LONG[:20_000], "é ​﻿", "٣ ½ ²", "<0x41>"]


def test_same_as_brute_force(spark, tools):
    sample = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()]
    texts = [None, "", *ODD, *ODD[:5], *sample]
    rows, count = brute(tools, texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(5)
    for size in (1 << 25, 2_000):  # also with many small shards
        out, pairs = align.align(docs, RANKS, MODEL, shard_bytes=size)
        assert [tuple(r[c] for c in COLUMNS) for r in out.orderBy("doc_id").collect()] == rows
        assert {(r.a_id, r.b_id): r.n for r in pairs.collect()} == count


def test_tables_are_the_tokenizers(tools):
    _, _, bytes_a, bytes_b = tools
    pair = align._pair(RANKS, MODEL)
    assert dict(enumerate(pair.codecs[0].table)) == bytes_a and pair.codecs[1].table == bytes_b
    for a in np.flatnonzero(pair.same >= 0)[::97]:
        assert pair.codecs[0].table[a] == pair.codecs[1].table[pair.same[a]]
    assert set(pair.codecs[0].table) & set(bytes_b) == {pair.codecs[0].table[a] for a in np.flatnonzero(pair.same >= 0)}
    assert pair.same[pair.codecs[0].table.index(b"A")] == bytes_b.index(b"A", 300)


@given(st.text(max_size=60), st.integers(1, 40))
@settings(max_examples=150, deadline=None)
def test_encoders_same_as_the_tokenizers(tools, text, times):
    a, b, *_ = tools
    pair = align._pair(RANKS, MODEL)
    text = text * times
    assert list(pair.codecs[0].encode([text])[0]) == a.encode(" " + text, add_special_tokens=False).ids
    assert list(pair.codecs[1].encode([text])[0]) == b.encode(text)


def test_odd_rows(spark, odd, none, tools):
    out, _ = align.align(odd, RANKS, MODEL)
    want, _ = brute(tools, [r.text for r in odd.collect()])
    assert sorted(tuple(r[c] for c in COLUMNS) for r in out.collect()) == sorted(want)
    out, pairs = align.align(none, RANKS, MODEL)
    assert out.count() == pairs.count() == 0
