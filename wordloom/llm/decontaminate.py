"""Benchmark decontamination with one Aho-Corasick automaton over normalised test items.

Texts and items are lower-cased (A-Z) and cut into words of letters, digits and anything outside
ASCII. Every run of ``window`` words of an item is a pattern (an item of fewer words is one
pattern), written with a space at either end, so that a match begins and ends at words. All patterns are
in one automaton, and a text is scanned once, whatever the number of patterns; matches become ranges
of words, and ranges become offsets of the original text.

Texts stay where they are: the scan is map-only. The items are broadcast, which is bounded: an automaton
takes items of at most ``most_bytes`` times their overlap, as measured; where there are more of them, they
are dealt into blocks and the texts are scanned once for each block, each pass adding to what the
former ones found.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from wordloom.llm.common import byte_lists, free_name, whole
from wordloom.session import discard, store

_FOLD = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
_SPAN = StructType([StructField("start", LongType()), StructField("end", LongType())])
_ADDED = (("words", LongType()), ("hit", LongType()), ("spans", ArrayType(_SPAN)), ("items", ArrayType(StringType())),
          ("ranges", ArrayType(LongType())))
_ARROW = (pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])),
          pa.list_(pa.string()), pa.list_(pa.int64()))


def folded(text: bytes) -> bytes:
    """The words of a text between single spaces, with a space at either end."""
    return b" " + b" ".join(text.translate(_FOLD).split()) + b" "


def windows(item: bytes, window: int) -> list[bytes]:
    """The patterns of an item; none if it has no words."""
    words = folded(item).split()
    return [b" " + b" ".join(words[k:k + window]) + b" " for k in range(max(len(words) - window, 0) + 1)] if words else []


def automaton(items: Sequence[tuple[str | None, bytes]], window: int) -> ahocorasick.Automaton:
    """Each pattern with its length in bytes and the names of the items that hold it."""
    holders: dict[bytes, set] = {}
    for name, text in items:
        for pattern in windows(text, window):
            holders.setdefault(pattern, set()).add(name)
    made = ahocorasick.Automaton()
    for pattern, names in holders.items():
        made.add_word(pattern.decode("latin-1"), (len(pattern), tuple(n for n in names if n is not None)))
    if len(made):
        made.make_automaton()
    return made


def scan(made: ahocorasick.Automaton, line: bytes) -> tuple[list[int], list[int], set[str]]:
    """First words and ends (exclusive) of the matches in a folded text, and the items matched."""
    starts, ends, names = [], [], set()
    if len(made):
        for last, (length, holders) in made.iter(line.decode("latin-1")):
            starts.append(last - length + 1)
            ends.append(last)
            names.update(holders)
    if starts:
        gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
        return np.searchsorted(gaps, starts).tolist(), np.searchsorted(gaps, ends).tolist(), names
    return [], [], names


def merged(low: Sequence[int], high: Sequence[int]) -> list[tuple[int, int]]:
    """The union of ranges, ascending; ranges that touch are one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(zip(low, high)):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def located(text: bytes, ranges: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges of words as offsets of the original text, in code points."""
    data = np.frombuffer(text, np.uint8)
    inside = np.concatenate(([False], np.frombuffer(text.translate(_FOLD), np.uint8) != 32, [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])  # starts and ends of words in turn
    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    return [(int(points[edges[2 * a]]), int(points[edges[2 * b - 1]])) for a, b in ranges]


_made: dict[str, ahocorasick.Automaton] = {}


def _scanner(items, key: str, window: int, keep: list[str], again: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _made:
            _made.clear()  # a worker holds one automaton at a time
            _made[key] = automaton(items.value, window)
        made = _made[key]
        for batch in batches:
            texts = byte_lists(batch.column("text"))
            before = zip(batch.column("ranges").to_pylist(), batch.column("items").to_pylist()) if again else (((), ()) for _ in texts)
            rows = []
            for text, (flat, old) in zip(texts, before):
                line = folded(text)
                low, high, names = scan(made, line)
                ranges = merged([*low, *flat[::2]], [*high, *flat[1::2]]) if low or flat else []
                rows.append((line.count(b" ") - (1 if len(line) > 2 else 2), sum(b - a for a, b in ranges),
                             [dict(start=a, end=b) for a, b in located(text, ranges)] if ranges else [],
                             sorted(names.union(old)), [x for r in ranges for x in r]))
            columns = list(zip(*rows)) if rows else [[]] * len(_ADDED)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], *[pa.array(c, t) for c, t in zip(columns, _ARROW)]],
                [*keep, *[n for n, _ in _ADDED]])

    return run


def find_leaks(
    docs: DataFrame, items: DataFrame, window: int = 10, most_bytes: int = 8 << 20, text_column: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> tuple[DataFrame, dict[str, str]]:
    """docs with what they share with ``items``, and the names of the added columns.

    ``words`` and ``hit`` count the words and those inside any occurrence of a window; ``spans`` are the runs
    of hit words as offsets (code points, end exclusive) of the original text; ``items`` are the ids, as
    strings, of the items with an occurring window, sorted. The names differ where docs have such a column.

    A null or empty text has no words; a null or empty item no windows. An item without an id marks words but
    isn't listed; items with one id are listed once. Repeated rows of docs are found alike; other columns, whatever
    their names, pass through. Empty docs give no rows; without items nothing is hit. ``most_bytes`` bounds the
    bytes of patterns in one automaton (about 40 bytes of memory each); beyond it the items are dealt into
    blocks, each of which has a pass over the texts.
    """
    spark = docs.sparkSession
    names = {n: free_name(docs, n) for n, _ in _ADDED}
    inside = {c: f"c{i}" for i, c in enumerate(docs.columns)}  # no name can clash inside
    tests = items.select(F.col(item_id).cast("string").alias("name"), whole(item_text).alias("text"))
    size = tests.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size * window // most_bytes))
    kinds = StructType([StructField(inside[f.name], f.dataType, True) for f in docs.schema.fields]
                       + [StructField("text", StringType())] + [StructField(n, t) for n, t in _ADDED])
    out = docs.select(*[F.col(c).alias(a) for c, a in inside.items()], whole(text_column).alias("text"))
    path = None
    for block in range(blocks):
        part = tests.filter(F.pmod(F.xxhash64("name", "text"), F.lit(blocks)) == block) if blocks > 1 else tests
        shared = spark.sparkContext.broadcast([(r.name, r.text.encode()) for r in part.collect()])
        scanned = out.mapInArrow(_scanner(shared, uuid.uuid4().hex, window, [*inside.values(), "text"], block > 0), kinds)
        if block + 1 < blocks:
            former = path
            out, path = store(scanned, "leaks")
            if former:
                discard(spark, former)
    return scanned.select(*[F.col(a).alias(c) for c, a in inside.items()],
                          *[F.col(n).alias(names[n]) for n, _ in _ADDED if n != "ranges"]), names
