"""Fill-in-the-middle by a piece table.

A document is a list of descriptors ``(buffer, start, length)`` over two buffers that never change: its
text and the sentinels. Cutting splits a descriptor, an arrangement permutes the descriptors and puts
sentinels between them, and the inverse permutation restores the text; hashes read the buffers through
the descriptors, so no arranged copy is made for them.

Where a document is cut, and into which form it goes, follows from a hash of its id, so a lost task is redone
alike. Everything is one pass over the texts without a shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from wordloom.llm.common import byte_lists, free_name, whole

TEXT, MARKS = 0, 1
SENTINELS = (b"<P>", b"<S>", b"<M>")
_MARK_BUFFER = b"".join(SENTINELS)
PREFIX, SUFFIX, MIDDLE = range(3)
#: The order of the parts in each form, each after its sentinel but for the middle of ``spm``.
_ORDER = {"psm": ((PREFIX, PREFIX), (SUFFIX, SUFFIX), (MIDDLE, MIDDLE)),
          "spm": ((SUFFIX, SUFFIX), (PREFIX, PREFIX), (MIDDLE, MIDDLE))}
#: Which parts, in the order of the text, the arranged parts are.
_IN_TEXT = (PREFIX, MIDDLE, SUFFIX)

Piece = tuple[int, int, int]


def units(text: bytes) -> np.ndarray:
    """Where the units start: runs of ASCII letters, and any other single character."""
    data = np.frombuffer(text, np.uint8)
    lower = data | 32
    letter = (lower >= 97) & (lower <= 122)
    start = (data & 0xC0) != 0x80
    start[1:] &= ~(letter[1:] & letter[:-1])
    return np.flatnonzero(start)


def cut(pieces: Sequence[Piece], at: int) -> list[Piece]:
    """The descriptors with a border at an offset of what they describe; an empty one where it falls on a border."""
    out, before = [], 0
    for i, (buffer, start, length) in enumerate(pieces):
        if before <= at <= before + length:
            k = at - before
            return [*out, (buffer, start, k), (buffer, start + k, length - k), *pieces[i + 1:]]
        out.append((buffer, start, length))
        before += length
    raise ValueError("outside of the text")


def arrange(parts: Sequence[Piece], form: str) -> list[Piece]:
    """Prefix, middle and suffix as the form has them, sentinels included."""
    by_part = dict(zip(_IN_TEXT, parts))
    out = []
    for mark, part in _ORDER[form]:
        out += [(MARKS, sum(map(len, SENTINELS[:mark])), len(SENTINELS[mark])), by_part[part]]
    return out


def read(pieces: Sequence[Piece], buffers: Sequence[bytes]) -> Iterator[memoryview]:
    for buffer, start, length in pieces:
        yield memoryview(buffers[buffer])[start:start + length]


def digest(pieces: Sequence[Piece], buffers: Sequence[bytes]) -> str:
    made = hashlib.sha256()
    for part in read(pieces, buffers):
        made.update(part)
    return made.hexdigest()


def disarrange(output: bytes, form: str) -> list[Piece]:
    """Descriptors over an output that give its text: parts between the sentinels, permuted back."""
    if form == "plain":
        return [(TEXT, 0, len(output))]
    marks = [SENTINELS[mark] for mark, _ in _ORDER[form]]
    starts = [0, *[output.index(m) for m in marks[1:]]]
    if output[:len(marks[0])] != marks[0] or starts != sorted(starts):
        raise ValueError(f"not of the form {form}")
    parts = {part: (TEXT, s + len(m), e - s - len(m))
             for (_, part), m, s, e in zip(_ORDER[form], marks, starts, [*starts[1:], len(output)])}
    return [parts[p] for p in _IN_TEXT]


def draws(seed: str, name: str) -> list[int]:
    """Four numbers of 32 bits from a document's name."""
    digits = hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()
    return [int(digits[k:k + 8], 16) for k in range(0, 32, 8)]


def points(text: bytes, start: int, length: int) -> int:
    """Code points of a part."""
    return int(np.count_nonzero((np.frombuffer(text, np.uint8)[start:start + length] & 0xC0) != 0x80))


def descriptors(text: bytes, name: str, seed: str, rate: int, spm: int) -> tuple[int, str, list[Piece]]:
    """Number of units, form, and the parts prefix, middle and suffix (the whole text if plain)."""
    at = units(text)
    n, (h1, h2, h3, h4) = len(at), draws(seed, name)
    if not n or h3 % 100 >= rate or any(s in text for s in SENTINELS):
        return n, "plain", [(TEXT, 0, len(text))]
    edges = [int(at[k]) if k < n else len(text) for k in sorted((h1 % (n + 1), h2 % (n + 1)))]
    return n, "spm" if h4 % 100 < spm else "psm", cut(cut([(TEXT, 0, len(text))], edges[1]), edges[0])


_PIECE = StructType([StructField("buffer", IntegerType()), StructField("start", LongType()), StructField("length", LongType())])
_PIECES = pa.list_(pa.struct([("buffer", pa.int32()), ("start", pa.int64()), ("length", pa.int64())]))
_ADDED = (("units", LongType(), pa.int64()), ("form", StringType(), pa.string()), ("prefix_chars", LongType(), pa.int64()),
          ("middle_chars", LongType(), pa.int64()), ("output_sha256", StringType(), pa.string()),
          ("pieces", ArrayType(_PIECE), _PIECES), ("output", StringType(), pa.large_string()))
_RESTORED = (("restored", StringType(), pa.large_string()), ("restored_sha256", StringType(), pa.string()))


def _with(batch: pa.RecordBatch, keep: list[str], added, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(added)
    return pa.RecordBatch.from_arrays(
        [*[batch.column(c) for c in keep], *[pa.array(c, t) for c, (_, _, t) in zip(columns, added)]],
        [*keep, *[n for n, *_ in added]])


def _transformer(seed: str, rate: int, spm: int, keep: list[str], with_output: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, name in zip(byte_lists(batch.column("text")), batch.column("name").to_pylist()):
                n, form, parts = descriptors(text, name, seed, rate, spm)
                pieces = parts if form == "plain" else arrange(parts, form)
                sizes = (None, None) if form == "plain" else tuple(points(text, s, k) for _, s, k in parts[:2])
                buffers = text, _MARK_BUFFER
                rows.append((n, form, *sizes, digest(pieces, buffers), [dict(buffer=b, start=s, length=k) for b, s, k in pieces],
                             b"".join(read(pieces, buffers)).decode() if with_output else None))
            yield _with(batch, keep, _ADDED, rows)

    return run


def _restorer(keep: list[str], with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for output, form in zip(byte_lists(batch.column("text")), batch.column("form").to_pylist()):
                pieces = disarrange(output, form)
                rows.append((b"".join(read(pieces, (output,))).decode() if with_text else None, digest(pieces, (output,))))
            yield _with(batch, keep, _RESTORED, rows)

    return run


def _mapped(docs: DataFrame, more: dict, run, added, last: int) -> tuple[DataFrame, dict[str, str]]:
    """docs with the added columns under free names; ``more`` are columns that only the function sees."""
    names = {n: free_name(docs, n) for n, *_ in added}
    inside = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    kinds = StructType([StructField(inside[f.name], f.dataType, True) for f in docs.schema.fields]
                       + [StructField(n, t) for n, t, _ in added])
    out = docs.select(*[F.col(c).alias(a) for c, a in inside.items()], *[c.alias(n) for n, c in more.items()])
    out = out.mapInArrow(run(list(inside.values())), kinds)
    return out.select(*[F.col(a).alias(c) for c, a in inside.items()],
                      *[F.col(n).alias(names[n]) for n, *_ in added[:last]]), names


def transform(
    docs: DataFrame, seed: str = "1", rate: int = 90, spm: int = 20, with_output: bool = True,
    id_column: str = "doc_id", text_column: str = "text",
) -> tuple[DataFrame, dict[str, str]]:
    """docs with units, form, sizes, digest, descriptors and the output, and the names of these columns.

    ``rate`` and ``spm`` are percentages: of documents that are arranged, and of these in the form spm.
    Descriptors count bytes of UTF-8; buffer 0 is the text, 1 the sentinels. Without ``with_output``
    the arranged text is hashed from the descriptors but not built.

    A null or empty text is plain and empty; so is, unchanged, a text that holds a sentinel. A null id draws
    as the name ``null``. Rows that repeat are treated alike; an empty table gives no rows; other columns
    pass through, and the added ones take other names where they would clash.
    """
    more = {"text": whole(text_column), "name": F.coalesce(F.col(id_column).cast("string"), F.lit("null"))}
    return _mapped(docs, more, lambda keep: _transformer(seed, rate, spm, keep, with_output), _ADDED,
                   len(_ADDED) - (not with_output))


def restore(
    docs: DataFrame, output_column: str, form_column: str, with_text: bool = True,
) -> tuple[DataFrame, dict[str, str]]:
    """docs with the texts rebuilt from outputs and forms alone, their digests, and the names of these columns.

    A null output is empty, a null form plain; an output that isn't of its form is an error. An empty table gives no rows.
    """
    more = {"text": whole(output_column), "form": F.coalesce(F.col(form_column), F.lit("plain"))}
    out, names = _mapped(docs, more, lambda keep: _restorer(keep, with_text), _RESTORED, len(_RESTORED))
    return (out if with_text else out.drop(names["restored"])), names
