"""Best-fit packing of tokenised documents into sequences of one capacity.

*Large-item matching*: pieces above a third of the capacity fit at most twice into one
sequence; the largest is matched with the largest partner that fits. Smaller pieces then go,
largest first, to the tightest gap that holds them, and to new sequences when none does.

Only lengths matter for this, so it works on the histogram of lengths: ``capacity`` counters
whatever the input. Each step of the plan uses up a length or a run of equal gaps, so the plan
is bounded too. Each piece then finds its place by its length and its number among the pieces
of that length: tasks number their own pieces, and sums over the tasks' counts, joined to the pieces by
hash, do the rest. The texts are read once and never shuffled; small rows, one for each piece, are.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from wordloom.llm.common import whole
from wordloom.session import materialize

_PIECES = ("id {id}, piece int, start bigint, length bigint, ids_crc32 bigint, part int, slot bigint")
_encoders: dict[tuple, Callable[[str], list[int]]] = {}


def encoder(tokenizer: str, ranks: str | None = None) -> Callable[[str], list[int]]:
    """ids of a text without added special tokens. With ``ranks``, the same vocabulary as
    ranks of byte strings, ordinary text takes a faster way to the same ids; a text that
    holds a special token's string goes to the tokenizer itself."""
    key = tokenizer, ranks
    if key not in _encoders:
        from tokenizers import Tokenizer

        own = Tokenizer.from_file(tokenizer)
        plain = lambda text: own.encode(text, add_special_tokens=False).ids
        _encoders[key] = plain
        if ranks:
            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
            special = [t.content for t in own.get_added_tokens_decoder().values()]
            _encoders[key] = lambda text: (
                plain(text) if any(s in text for s in special) else fast.encode_ordinary(text))
    return _encoders[key]


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones, the first may be shorter."""
    first = total % capacity or capacity
    if total <= capacity:
        return [(0, total)]
    return [(0, first)] + [(s, capacity) for s in range(first, total, capacity)]


def _pieces_of(capacity: int, end_id: int, tokenizer: str, ranks: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(tokenizer, ranks), TaskContext.get().partitionId()
        slots: dict[int, int] = {}
        for batch in batches:
            rows, of = [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                ids = np.array(encode(text) + [end_id], "<u4")
                for piece, (start, length) in enumerate(cut(len(ids), capacity)):
                    slot = slots.get(length, 0)
                    slots[length] = slot + 1
                    rows.append((piece, start, length, zlib.crc32(ids[start:start + length].tobytes()), part, slot))
                    of.append(i)
            columns = list(zip(*rows)) if rows else [[]] * 6
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(of, pa.int64()))] + [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["id", "piece", "start", "length", "ids_crc32", "part", "slot"])

    return run


def plan(counts: dict[int, int], capacity: int) -> dict[int, list[tuple[int, int, int, int]]]:
    """For each length the list of (first number, first sequence, pieces in each, offset).

    The pieces numbered from the first number on go, so many in each, to the sequences
    from the first on, starting at the offset.
    """
    left = {s: n for s, n in counts.items() if n}
    used: dict[int, int] = dict.fromkeys(left, 0)
    places: dict[int, list[tuple[int, int, int, int]]] = {s: [] for s in left}
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> runs of sequences (first, how many)
    order: list[int] = []  # gaps that occur, ascending
    opened = 0

    def put(size: int, many: int, first: int, each: int, offset: int) -> None:
        places[size].append((used[size], first, each, offset))
        used[size] += many * each
        left[size] -= many * each

    def free(gap: int, first: int, many: int) -> None:
        if gap and many:
            if gap not in gaps:
                gaps[gap] = []
                insort(order, gap)
            gaps[gap].append((first, many))

    large = sorted(s for s in left if 3 * s > capacity)
    while large:
        s = large[-1]
        at = bisect_right(large, capacity - s) - 1
        t = large[at] if at >= 0 else None
        if t is None:
            many, gap = left[s], capacity - s
            put(s, many, opened, 1, 0)
        elif t == s:
            if left[s] == 1:
                large.pop(at)
                t = large[at - 1] if at else None  # the largest partner below
                many = 1
                put(s, 1, opened, 1, 0)
                gap = capacity - s - (t or 0)
                if t:
                    put(t, 1, opened, 1, s)
            else:
                many, gap = left[s] // 2, capacity - 2 * s
                put(s, many, opened, 2, 0)
        else:
            many, gap = min(left[s], left[t]), capacity - s - t
            put(s, many, opened, 1, 0)
            put(t, many, opened, 1, s)
        free(gap, opened, many)
        opened += many
        large = [x for x in large if left[x]] if not (left[s] and (t is None or left[t])) else large

    for s in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        while left[s]:
            at = bisect_left(order, s)
            if at < len(order):
                gap = order[at]
                first, many = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap]
                    order.pop(at)
                fresh = False
            else:
                gap, first, many, fresh = capacity, opened, -(-left[s] // (capacity // s)), True
                opened += many
            each = gap // s
            full = min(many, left[s] // each)
            if full:
                put(s, full, first, each, capacity - gap)
                free(gap - each * s, first, full)
            rest = left[s]
            if full < many and rest:
                put(s, 1, first + full, rest, capacity - gap)
                free(gap - rest * s, first + full, 1)
                full += 1
            if not fresh:
                free(gap, first + full, many - full)
    return places


def _placed(places: dict[int, list[tuple[int, int, int, int]]], out_schema: list[str]):
    tables = {s: np.array(rows, np.int64).T for s, rows in places.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "number"))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            by = np.argsort(length, kind="stable")
            bounds = np.flatnonzero(np.diff(length[by])) + 1
            for group in np.split(by, bounds) if len(by) else []:
                size = int(length[group[0]])
                first_number, first, each, at = tables[size]
                k = np.searchsorted(first_number, number[group], "right") - 1
                i = number[group] - first_number[k]
                sequence[group] = first[k] + i // each[k]
                offset[group] = at[k] + i % each[k] * size
            keep = [batch.column(c) for c in out_schema]
            yield pa.RecordBatch.from_arrays(
                keep + [pa.array(sequence), pa.array(offset)], [*out_schema, "sequence_id", "offset"])

    return run


def pack(
    docs: DataFrame, tokenizer: str, ranks: str | None = None, capacity: int = 2048, end_id: int = 0,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """One row for each piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is a document of one end token. Repeated rows and null ids are
    packed like others, each row for itself. An empty table gives no rows; other columns
    are not read.
    """
    rows = docs.select(F.col(id_column).alias("id"), whole(text_column).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    pieces = materialize(rows.mapInArrow(_pieces_of(capacity, end_id, tokenizer, ranks), _PIECES.format(id=kind)), "pieces")
    tally = materialize(pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "lengths")
    # At most ``capacity`` rows reach the driver.
    counts = {r.length: r.n for r in tally.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")
    # One row for each length of each task: no bound to broadcast them under, few in each partition of their own key.
    key = (F.col("part").cast("bigint") * (capacity + 1) + F.col("length")).alias("key")
    tally = tally.select(key, before.alias("before")).hint("shuffle_hash")
    numbered = pieces.select("*", key).join(tally, "key").select(
        "id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("slot")).alias("number"))
    keep = ["id", "piece", "start", "length", "ids_crc32"]
    schema = f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    out = numbered.mapInArrow(_placed(plan(counts, capacity), keep), schema)
    return out.withColumnRenamed("id", id_column)
