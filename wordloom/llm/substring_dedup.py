"""Substring de-duplication by De Bruijn compaction.

Runs of ``k`` words are the edges of a De Bruijn graph of the corpus. A window is removed if its
words also start earlier, so the first place of every repeated edge is wanted, without a shuffle
of all edges:

1. *Compaction.* Each window has a minimizer, the smallest hash among its short runs. Consecutive
   windows that share one are a nonbranching path: where their words repeat, they repeat together. Such
   a segment travels as one record (minimizer, content, place), about an eighth of the windows.
2. *Join by minimizer.* Equal segments: all but the first place are removed. A minimizer with several
   contents is a branching point; only there single edges are looked at.
3. *Edges at the branches.* The first place of each content sends its single windows, by
   a 128-bit hash; all but the first place of each edge are removed.
4. *Source coordinates verify.* A removed window carries the earlier place it was found equal to. Windows on
   one diagonal merge to long spans; a span and its source are compared by the SHA-256 of their words, in
   the group of the source's text. Only what agrees is cut from the text it came from.
5. *What doesn't agree* (64-bit hashes of different words that fell together) is decided anew: all windows of
   the corpus with such a hash are grouped by the SHA-256 of their words. This pass runs only if there are any.

Equal windows have equal minimizers, and the first place of a segment is the first of all its windows,
so nothing is lost. Hot passages: a task sends each content once and settles its own repeats, and of a
minimizer that branches often it sends a few contents and opens the others at once, so a key has at most a
few records of each task, and the places that one source has to verify are those of one task or one for each
task. Texts are shuffled by id twice: for the edges and their verification, and for the cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wordloom.llm.common import (
    Words, batch, bucket_of, by_bucket, byte_lists, partitions, planes, slices, unplanes, whole, xxhash_long)
from wordloom.session import discard, store

NO_ID = -(1 << 63)
_SHORT = 6
_OPEN = 16
_START_BITS = 32
_PLACES = [("kind", pa.int32()), ("bucket", pa.int64()), ("a", pa.binary()), ("g", pa.binary()),
           ("doc", pa.binary()), ("at", pa.binary()), ("n", pa.binary())]
_PLACES_SQL = "kind int, bucket bigint, a binary, g binary, doc binary, at binary, n binary"
#: Kinds of records: equal words to be found, runs of windows to remove (``a`` and ``g`` are the source's id and
#: place), runs of windows to open, runs whose words are not those of their source.
SEEK, REMOVE, OPEN, DIFFERENT = 0, 1, 2, 3
_CLAIMS = [("bucket", pa.int64()), ("src", pa.binary()), ("src_at", pa.binary()), ("doc", pa.binary()),
           ("at", pa.binary()), ("n", pa.binary()), ("digest", pa.binary())]
_CLAIMS_SQL = "bucket bigint, src binary, src_at binary, doc binary, at binary, n binary, digest binary"


def _rows(kind: int, bucket: np.ndarray, a, g, doc, at, n) -> Iterator[tuple]:
    for b, parts in by_bucket(bucket, a, g, doc, at, n):
        yield (kind, b, *map(planes, parts))


def segments(texts: list[bytes], k: int) -> tuple[np.ndarray, ...]:
    """minimizer, content hash, text, start, number of windows of each segment."""
    words = Words(texts)
    none = np.zeros(0, np.int64)
    if len(words) < k:
        return none.view(np.uint64), none.view(np.uint64), none, none, none
    short = min(_SHORT, k)
    m = len(words) - short + 1
    low = np.arange(m)
    value = words.run(low, low + short)
    place, width = low, 1
    span = k - short + 1  # short runs in a window
    while width < span:  # smallest value, the leftmost place on ties, in doubling steps
        step = min(width, span - width)
        size = len(value) - step
        left = value[:size] <= value[step:]
        value, place = np.where(left, value[:size], value[step:]), np.where(left, place[:size], place[step:])
        width += step
    start = np.arange(len(value))
    text = words.text_of(start)
    inside = start + k <= words.first[text + 1]
    start, text, value, place = start[inside], text[inside], value[inside], place[inside]
    if not len(start):
        return none.view(np.uint64), none.view(np.uint64), none, none, none
    new = np.concatenate(([True], (np.diff(place) != 0) | (np.diff(text) != 0)))
    first = np.flatnonzero(new)
    n = np.diff(np.concatenate((first, [len(start)])))
    begin = start[first]
    content = words.run(begin, begin + n + k - 1, seed=1)
    return value[first], content, text[first], begin - words.first[text[first]], n


def _first_of(order_keys: tuple[np.ndarray, ...], doc: np.ndarray, at: np.ndarray):
    """Order by key and place; for each record whether a new key starts, whether the record
    stands at another place than the first of its key, and which record is that first."""
    order = np.lexsort((at, doc, *order_keys[::-1]))
    new = np.zeros(len(order), bool)
    if len(order):
        new[0] = True
        for key in order_keys:
            new[1:] |= np.diff(key[order].view(np.int64)) != 0
    first = np.flatnonzero(new)[np.cumsum(new) - 1] if len(order) else order
    later = (doc[order] != doc[order][first]) | (at[order] != at[order][first])
    return order, new, later, first


def _remove(later, first, doc, at, n, shards: int) -> list[tuple]:
    """Records to remove, each with the first place of its key."""
    return list(_rows(REMOVE, _shard(doc[later], shards), doc[first][later], at[first][later],
                      doc[later], at[later], n[later]))


def _find(k: int, buckets: int, shards: int):
    """Texts to segment records, after what the task can settle alone."""
    def flush(parts: list[tuple]) -> pa.RecordBatch:
        a, g, doc, at, n = (np.concatenate(c) for c in zip(*parts))
        order, new, later, first = _first_of((a, g), doc, at)
        a, g, doc, at, n = (c[order] for c in (a, g, doc, at, n))
        rows = _remove(later, first, doc, at, n, shards)
        a, g, doc, at, n = (c[new] for c in (a, g, doc, at, n))
        run = np.flatnonzero(np.concatenate(([True], np.diff(a.view(np.int64)) != 0)))
        many = np.diff(np.concatenate((run, [len(a)])))
        rank = np.arange(len(a)) - np.repeat(run, many)
        opened = (np.repeat(many, many) > _OPEN)
        send = ~opened | (rank < 2)
        rows += _rows(OPEN, _shard(doc[opened], shards), a[opened], g[opened], doc[opened], at[opened], n[opened])
        rows += _rows(SEEK, bucket_of(a[send], buckets), a[send], g[send], doc[send], at[send], n[send])
        return batch(_PLACES, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for b in batches:
            texts = byte_lists(b.column("text"))
            ids, ties = (b.column(c).to_numpy(zero_copy_only=False) for c in ("id", "tie"))
            for low, high in slices(texts):
                a, g, text, start, n = segments(texts[low:high], k)
                text = text + low
                parts.append((a, g, ids[text], (ties[text] << _START_BITS) + start, n))
                size += len(a)
                if size > 4_000_000:
                    yield flush(parts)
                    parts, size = [], 0
        if parts:
            yield flush(parts)

    return run


def _shard(doc: np.ndarray, shards: int) -> np.ndarray:
    return np.mod(xxhash_long(np.ascontiguousarray(doc)), shards)


def _gather(batches: Iterator[pa.RecordBatch]) -> tuple[list[tuple], dict[int, list[tuple]]]:
    """Records that only pass through, and the others' columns by bucket."""
    done, held = [], {}
    for b in batches:
        for row in zip(*[b.column(name).to_pylist() for name, _ in _PLACES]):
            if row[0] == SEEK:
                held.setdefault(row[1], []).append(row[2:])
            else:
                done.append(row)
    return done, held


def _columns(rows: list[tuple]) -> list[np.ndarray]:
    kinds = (np.uint64, np.uint64, np.int64, np.int64, np.int64)
    return [np.concatenate([unplanes(r[i], t) for r in rows]) for i, t in enumerate(kinds)]


def _settle(shards: int, branching: bool):
    """All but the first place of equal records are removed; with ``branching``, the first
    places of keys with several contents are to be opened."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, held = _gather(batches)
        yield batch(_PLACES, done)
        for rows in held.values():
            a, g, doc, at, n = _columns(rows)
            order, new, later, first = _first_of((a, g), doc, at)
            a, g, doc, at, n = (c[order] for c in (a, g, doc, at, n))
            out = _remove(later, first, doc, at, n, shards)
            if branching:
                a, g, doc, at, n = (c[new] for c in (a, g, doc, at, n))
                same = np.zeros(len(a), bool)
                equal = np.diff(a.view(np.int64)) == 0
                same[1:] |= equal
                same[:-1] |= equal
                out += _rows(OPEN, _shard(doc[same], shards), a[same], g[same], doc[same], at[same], n[same])
            yield batch(_PLACES, out)

    return run


def _runs_of(table: pa.Table, *names: str) -> list[np.ndarray]:
    """Packed columns, by default id, place and number of windows, ordered by the first two."""
    names = names or ("doc", "at", "n")
    rows = list(zip(*[table.column(c).to_pylist() for c in names]))
    columns = [np.concatenate([unplanes(r[i]) for r in rows]) if rows else np.zeros(0, np.int64) for i in range(len(names))]
    order = np.lexsort((columns[1], columns[0]))
    # A digest is four longs, on the record's row.
    return [(c.reshape(-1, 4) if name == "digest" else c)[order] for name, c in zip(names, columns)]


def _of_text(doc: np.ndarray, at: np.ndarray, id_: int, tie: int) -> slice:
    """The records of one text."""
    low, high = np.searchsorted(doc, id_), np.searchsorted(doc, id_, "right")
    a = low + np.searchsorted(at[low:high], tie << _START_BITS)
    b = low + np.searchsorted(at[low:high], (tie + 1) << _START_BITS)
    return slice(a, b)


def _texts_with(texts: pa.Table, doc: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int, slice, Words]]:
    """id, tie, records and words of each text that has records; of equal ids and ties one text."""
    seen = set()
    for id_, tie, text in zip(*[texts.column(c).to_pylist() for c in ("id", "tie", "text")]) if len(doc) else ():
        mine = _of_text(doc, at, id_, tie)
        if mine.stop > mine.start and (id_, tie) not in seen:
            seen.add((id_, tie))
            yield id_, tie, mine, Words([text.encode()])


def _starts(begin: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Where the windows of some runs start."""
    return np.unique(np.repeat(begin - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(many.sum()))


def _digests(words: Words, begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """SHA-256 of some runs of words, as four longs each."""
    bounds = zip(words.start[begin].tolist(), words.end[begin + n - 1].tolist())
    raw = b"".join(hashlib.sha256(words.data[low:high]).digest() for low, high in bounds)
    return np.frombuffer(raw, np.int64).reshape(-1, 4)


def _open(k: int, buckets: int, shards: int):
    """Texts and the runs of windows to open, to records of single windows."""
    def run(texts: pa.Table, wanted: pa.Table) -> pa.Table:
        doc, at, n = _runs_of(wanted)
        parts = []
        for id_, tie, mine, words in _texts_with(texts, doc, at):
            start = _starts(at[mine] - (tie << _START_BITS), n[mine])
            parts.append((words.run(start, start + k), words.run(start, start + k, seed=1),
                          np.full(len(start), id_), start + (tie << _START_BITS), np.ones(len(start), np.int64)))
        if not parts:
            return pa.Table.from_batches([batch(_PLACES, [])])
        a, g, doc, at, n = (np.concatenate(c) for c in zip(*parts))
        order, new, later, first = _first_of((a, g), doc, at)
        a, g, doc, at, n = (c[order] for c in (a, g, doc, at, n))
        rows = _remove(later, first, doc, at, n, shards)
        rows += _rows(SEEK, bucket_of(a[new], buckets), a[new], g[new], doc[new], at[new], n[new])
        return pa.Table.from_batches([batch(_PLACES, rows)])

    return run


def _spans(begin: np.ndarray, end: np.ndarray, src: np.ndarray, src_at: np.ndarray):
    """Runs of words on one diagonal, of one source, that touch become one: start, length, source, its place."""
    order = np.lexsort((begin, begin - src_at, src))
    begin, end, src, src_at = (c[order] for c in (begin, end, src, src_at))
    line = np.concatenate(([0], np.cumsum((np.diff(begin - src_at) != 0) | (np.diff(src) != 0)))) << (_START_BITS + 1)
    reach = np.maximum.accumulate(line + end)
    first = np.flatnonzero(np.concatenate(([True], (line + begin)[1:] > reach[:-1])))
    last = np.concatenate((first[1:], [len(begin)])) - 1
    return begin[first], reach[last] - line[last] - begin[first], src[first], src_at[first]


def _claims(k: int, shards: int):
    """Texts and their runs to remove, to spans with the digest of their words, for their sources' groups."""
    def run(texts: pa.Table, removed: pa.Table) -> pa.Table:
        doc, at, n, src, src_at = _runs_of(removed, "doc", "at", "n", "a", "g")
        parts = []
        for id_, tie, mine, words in _texts_with(texts, doc, at):
            own = at[mine] - (tie << _START_BITS)
            begin, size, source, place = _spans(own, own + n[mine] + k - 1, src[mine], src_at[mine])
            parts.append((source, place, np.full(len(begin), id_), begin + (tie << _START_BITS), size,
                          _digests(words, begin, size)))
        if not parts:
            return pa.Table.from_batches([batch(_CLAIMS, [])])
        columns = [np.concatenate(c) for c in zip(*parts)]
        rows = [(b, *map(planes, c)) for b, c in by_bucket(_shard(columns[0], shards), *columns)]
        return pa.Table.from_batches([batch(_CLAIMS, rows)])

    return run


def _verify(k: int, shards: int):
    """Texts and the spans that name them as their source, to runs to remove and runs that differ."""
    def run(texts: pa.Table, claims: pa.Table) -> pa.Table:
        src, src_at, doc, at, n, digest = _runs_of(claims, "src", "src_at", "doc", "at", "n", "digest")
        same = np.zeros(len(src), bool)
        for _, tie, mine, words in _texts_with(texts, src, src_at):
            begin, size = src_at[mine] - (tie << _START_BITS), n[mine]
            whole_span = np.flatnonzero(begin + size <= len(words))
            found = _digests(words, begin[whole_span], size[whole_span])
            same[mine.start + whole_span] = (found == digest[mine][whole_span]).all(axis=1)
        rows = []
        for kind, some in ((REMOVE, same), (DIFFERENT, ~same)):
            for b, parts in by_bucket(_shard(doc[some], shards), doc[some], at[some], n[some] - k + 1):
                rows.append((kind, b, b"", b"", *map(planes, parts)))
        return pa.Table.from_batches([batch(_PLACES, rows)])

    return run


def _windows(k: int):
    """All windows of the texts: hash, id, place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = byte_lists(b.column("text"))
            ids, ties = (b.column(c).to_numpy(zero_copy_only=False) for c in ("id", "tie"))
            for low, high in slices(texts):
                words = Words(texts[low:high])
                value, start = words.runs(k)
                text = words.text_of(start)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(value.view(np.int64)), pa.array(ids[low + text]),
                     pa.array((ties[low + text] << _START_BITS) + start - words.first[text])], ["h", "doc", "at"])

    return run


def _hashes(k: int):
    def run(texts: pa.Table, runs: pa.Table) -> pa.Table:
        doc, at, n = _runs_of(runs)
        parts = [np.zeros(0, np.int64)]
        for _, tie, mine, words in _texts_with(texts, doc, at):
            start = _starts(at[mine] - (tie << _START_BITS), n[mine])
            parts.append(words.run(start, start + k).view(np.int64))
        return pa.table({"h": np.unique(np.concatenate(parts))})

    return run


def _digest_windows(k: int):
    def run(texts: pa.Table, places: pa.Table) -> pa.Table:
        doc, at = (places.column(c).to_numpy() for c in ("doc", "at"))
        order = np.lexsort((at, doc))
        doc, at = doc[order], at[order]
        parts = []
        for _, tie, mine, words in _texts_with(texts, doc, at):
            start = at[mine] - (tie << _START_BITS)
            parts.append((_digests(words, start, np.full(len(start), k)), doc[mine], at[mine]))
        digest, doc, at = (np.concatenate(c) for c in zip(*parts)) if parts else (np.zeros((0, 4), np.int64), doc[:0], at[:0])
        return pa.table({"digest": pa.array([d.tobytes() for d in digest], pa.binary()), "doc": doc, "at": at})

    return run


def _one_window_runs(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc, at = (b.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "at"))
            yield batch(_PLACES, list(_rows(REMOVE, _shard(doc, shards), doc, at, doc, at, np.ones(len(doc), np.int64))))

    return run


def _decided_by_words(rows: DataFrame, meet, runs: DataFrame, k: int, shards: int) -> DataFrame:
    """Records to remove among all windows that share a hash with a window of ``runs``, by their words."""
    hashes = meet(runs, _hashes(k), "h bigint").distinct()
    places = rows.select("id", "tie", "text").mapInArrow(_windows(k), "h bigint, doc bigint, at bigint")
    places = places.join(hashes, "h", "left_semi").select(
        "doc", "at", F.pmod(F.xxhash64("doc"), F.lit(shards)).cast("bigint").alias("bucket"))
    words = meet(places, _digest_windows(k), "digest binary, doc bigint, at bigint")
    first = words.groupBy("digest").agg(F.min(F.struct("doc", "at")).alias("first"))
    later = words.join(first, "digest").filter(F.struct("doc", "at") != F.col("first")).select("doc", "at")
    return later.mapInArrow(_one_window_runs(shards), _PLACES_SQL)


def _cut(k: int, with_text: bool):
    """Texts and their removed windows, to what is left."""
    def run(texts: pa.Table, removed: pa.Table) -> pa.Table:
        doc, at, n = _runs_of(removed)
        out = []
        null, id_, ties, bodies = (texts.column(c).to_pylist() for c in ("no_id", "id", "tie", "text"))
        for i, text in enumerate(bodies):
            words = text.encode().split()
            mine = _of_text(doc, at, id_[i], ties[i])
            total = len(words)
            spans = []
            if mine.stop > mine.start:
                begin = at[mine] - (ties[i] << _START_BITS)
                edge = np.zeros(total + 1, np.int32)
                np.add.at(edge, begin, 1)
                np.add.at(edge, begin + n[mine] + k - 1, -1)
                gone = np.cumsum(edge)[:total] > 0
                change = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
                spans = [{"start": int(a), "end": int(b)} for a, b in zip(change[::2], change[1::2])]
                words = [w for w, g in zip(words, gone) if not g]
            kept = b" ".join(words)
            out.append((None if null[i] else id_[i], total, total - len(words), hashlib.sha256(kept).hexdigest(), spans)
                       + ((kept.decode(),) if with_text else ()))
        return pa.Table.from_batches([batch(_result(with_text), out)])

    return run


def _result(with_text: bool) -> list[tuple[str, pa.DataType]]:
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()),
            ("spans", span)] + ([("kept", pa.string())] if with_text else [])


def remove_repeats(
    docs: DataFrame, k: int = 20, id_column: str = "doc_id", text_column: str = "text",
    buckets: int | None = None, with_text: bool = True,
) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, the removed ``spans`` (word numbers, end
    exclusive) and, unless switched off, the ``kept`` text, for each row.

    A word is removed if it lies in a window of ``k`` words that also start earlier: in a
    text with a smaller id, or further up in the same text. Null texts have no words; a null
    id comes before all others. Texts that share an id follow the order of their checksums;
    repeated rows, of one id and one text, count as one document, and so do texts of one id and
    one checksum. Ids that are no numbers raise. Empty tables give no rows; other columns are not read.
    """
    if k < 1:
        raise ValueError("a window has at least one word")
    rows = docs.select(
        F.col(id_column).isNull().alias("no_id"), F.coalesce(F.col(id_column).cast("bigint"), F.lit(NO_ID)).alias("id"),
        whole(text_column).alias("text"))
    shared = not rows.groupBy("id").count().filter("count > 1").isEmpty()
    rows = rows.withColumn("tie", F.crc32("text").bitwiseAND(0x7FFFFFFF) if shared else F.lit(0).cast("bigint"))
    deal = partitions(docs)
    buckets, shards = buckets or deal, 4 * deal

    found = rows.select("id", "tie", "text").mapInArrow(_find(k, buckets, shards), _PLACES_SQL)
    settled = found.repartition(deal, "bucket").mapInArrow(_settle(shards, True), _PLACES_SQL)
    settled, path = store(settled, "segments")

    texts = rows.withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("bigint")).select(
        "bucket", "no_id", "id", "tie", "text").repartition(deal, "bucket")
    meet = lambda some, run, schema: texts.groupBy("bucket").cogroup(some.groupBy("bucket")).applyInArrow(run, schema)
    edges = meet(settled.filter(F.col("kind") == OPEN), _open(k, buckets, shards), _PLACES_SQL)
    edges = edges.repartition(deal, "bucket").mapInArrow(_settle(shards, False), _PLACES_SQL)
    removed = settled.filter(F.col("kind") == REMOVE).unionByName(edges)
    claims = meet(removed, _claims(k, shards), _CLAIMS_SQL)
    verified, _ = store(meet(claims, _verify(k, shards), _PLACES_SQL), "verified")
    discard(docs.sparkSession, path)
    removed, different = (verified.filter(F.col("kind") == kind) for kind in (REMOVE, DIFFERENT))
    if not different.isEmpty():
        removed = removed.unionByName(_decided_by_words(rows, meet, different, k, shards))
    schema = ("doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, "
              "spans array<struct<start:bigint,end:bigint>>" + (", kept string" if with_text else ""))
    return meet(removed, _cut(k, with_text), schema).withColumnRenamed("doc_id", id_column)
