"""Alignment of two tokenizers' ids over a corpus, with a fast path for ids of the same bytes.

Both tokenizers cut the bytes of ``space + text``; where a token of each ends, a group ends. The last
tokens of a group end together: they are its link. How often each pair of ids is linked
is counted over the corpus, and each document is told how good its links are.

*Identity map*: an array gives for each A id the B id of the same bytes. Links of such pairs, most of
them, are counted in one vector of A's vocabulary for each task. Only other pairs are shuffled, and of
those one row for each distinct pair of a *shard*, a run of texts of about ``shard_bytes``.

1. One pass encodes the texts. Documents keep their links as packed arrays, shards their distinct pairs.
2. Pair counts are summed; what comes to the driver has the size of a vocabulary: the vector of
   identity links and the best count of each B id.
3. The counts go back to the shards that asked for them, and meet the shard's documents there.

So a pair that is in every document is one row for each shard, and texts are read once.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from wordloom.llm.common import byte_lists, partitions, planes, slices, unplanes, whole
from wordloom.session import materialize


@dataclass(frozen=True)
class Codec:
    """``encode`` gives the ids of texts, each of which it puts a space before; ``table`` the bytes of each id."""

    table: list[bytes]
    encode: Callable[[Sequence[str]], list[Sequence[int]]]


def rank_codec(ranks: str) -> Codec:
    """Byte-level BPE from a file of ranks; special tokens' strings are ordinary text."""
    import public_tokenizers
    import tiktoken

    with open(ranks, "rb") as lines:
        found = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    made = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=found, special_tokens={})
    table = [b""] * (max(found.values()) + 1)
    for piece, rank in found.items():
        table[rank] = piece
    return Codec(table, lambda texts: [made.encode_ordinary(" " + t) for t in texts])


_STEP = 400  # characters; the model's time per character grows with the length


def _parts(text: str) -> list[str]:
    """A text in parts of some ``_STEP`` characters, cut at single spaces between words, which go.

    The model puts the space back before each part, and no piece of it crosses from a word into
    a following space (as :func:`piece_codec` makes sure), so the ids are those of the whole.
    """
    out, low, at = [], 0, text.find(" ", _STEP)
    while at >= 0 and at + 1 < len(text):
        if text[at - 1] != " " and text[at + 1] != " ":
            out.append(text[low:at])
            low = at + 1
            at = text.find(" ", low + _STEP)
        else:
            at = text.find(" ", at + 1)
    return [*out, text[low:]]


def piece_codec(model: str) -> Codec:
    """A sentencepiece model that puts a space before texts; ``<0xHH>`` are bytes."""
    import sentencepiece

    made = sentencepiece.SentencePieceProcessor(model_file=model)
    pieces = [made.id_to_piece(i) for i in range(made.get_piece_size())]
    table = [bytes([int(p[3:5], 16)]) if made.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
    whole_texts = any("▁" in p.lstrip("▁") for p in pieces)

    def encode(texts: Sequence[str]) -> list[Sequence[int]]:
        if whole_texts:
            return made.encode(list(texts), num_threads=1)
        parts = [_parts(t) for t in texts]
        ids = iter(made.encode(list(chain.from_iterable(parts)), num_threads=1))
        return [list(chain.from_iterable(next(ids) for _ in p)) for p in parts]

    return Codec(table, encode)


class Pair:
    """Both codecs with what is derived from their vocabularies."""

    def __init__(self, a: Codec, b: Codec):
        self.codecs = a, b
        self.sizes = [np.array([len(x) for x in c.table], np.int64) for c in self.codecs]
        if any((s == 0).any() for s in self.sizes):
            raise ValueError("a token without bytes can't be aligned")
        of_bytes = {piece: i for i, piece in reversed(list(enumerate(b.table)))}
        for i, piece in enumerate(b.table):  # a piece of several bytes or a letter goes before a byte piece
            if len(piece) == 1 and i > of_bytes[piece]:
                of_bytes[piece] = i
        self.same = np.array([of_bytes.get(piece, -1) for piece in a.table], np.int64)
        #: Each id as written in groups, by what follows it: a token of the group, or its end.
        self.written = [b"%d%c" % (i, end) for c, ends in zip(self.codecs, (b",|", b",;")) for end in ends for i in range(len(c.table))]

    def tokens(self, texts: Sequence[bytes]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """Which texts have tokens; for each codec the ids of those, in a row, and how many each has."""
        ok = np.array([len(t) > 0 for t in texts], bool)
        lists = [codec.encode([t.decode() for t, k in zip(texts, ok) if k]) for codec in self.codecs]
        places = np.flatnonzero(ok)
        whole_texts = [b" " + texts[i] for i in places]
        good = np.ones(len(places), bool)
        for codec, found in zip(self.codecs, lists):
            for i, ids in enumerate(found):
                good[i] &= b"".join(map(codec.table.__getitem__, ids)) == whole_texts[i]
        ok[places[~good]] = False
        lists = [[ids for ids, k in zip(found, good) if k] for found in lists]
        counts = [np.array([len(x) for x in found], np.int64) for found in lists]
        return ok, [np.fromiter(chain.from_iterable(found), np.int64, int(n.sum())) for found, n in zip(lists, counts)], counts

    def groups(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The last A and the last B token of each group, as positions."""
        ends_a, ends_b = np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b])
        marks = np.zeros(int(ends_a[-1]) + 1 if len(a) else 1, np.uint8)
        marks[ends_a] = 1
        marks[ends_b] |= 2
        return np.flatnonzero(marks[ends_a] == 3), np.flatnonzero(marks[ends_b] == 3)

    def spelled(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> np.ndarray:
        """Entries of ``written`` for all groups in order: A tokens, then B tokens."""
        na, nb = len(self.codecs[0].table), len(self.codecs[1].table)
        ends_a, ends_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        ends_a[last_a] = ends_b[last_b] = 1
        of_a, of_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b  # the group of each token
        before_b = np.concatenate(([0], last_b + 1))
        out = np.empty(len(a) + len(b), np.int64)
        out[np.arange(len(a)) + before_b[of_a]] = a + na * ends_a
        out[np.arange(len(b)) + (last_a + 1)[of_b]] = 2 * na + b + nb * ends_b
        return out

    def digest(self, entries: np.ndarray) -> str:
        """Of ``a1,a2|b1;a3|b2,b3``; piece by piece, as it may be long."""
        made = hashlib.sha256()
        for low in range(0, len(entries), 1 << 18):
            part = b"".join(map(self.written.__getitem__, entries[low:low + (1 << 18)].tolist()))
            made.update(part if low + (1 << 18) < len(entries) else part[:-1])
        return made.hexdigest()


_pairs: dict[tuple[str, str], Pair] = {}


def _pair(a: str, b: str) -> Pair:
    if (a, b) not in _pairs:
        _pairs[a, b] = Pair(rank_codec(a), piece_codec(b))
    return _pairs[a, b]


DOC, ASKED, VECTOR = 0, 1, 2
_STAGED = [("kind", pa.int32(), "int"), ("shard", pa.int64(), "bigint"), ("n_a", pa.int64(), "bigint"), ("n_b", pa.int64(), "bigint"),
           ("n_groups", pa.int64(), "bigint"), ("groups_sha256", pa.string(), "string"), ("same", pa.binary(), "binary"),
           ("other", pa.binary(), "binary"), ("keys", pa.list_(pa.int64()), "array<bigint>"), ("counts", pa.list_(pa.int64()), "array<bigint>")]
_CHUNK = 1 << 15
_TURN = 7_919  # a prime: a task's shards go to partitions far apart


def _rows(rows: list[tuple], ids: pa.Array) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(_STAGED)
    return pa.RecordBatch.from_arrays([ids, *[pa.array(c, t) for c, (_, t, _) in zip(columns, _STAGED)]], ["id", *[n for n, *_ in _STAGED]])


def _counted(kind: int, shard: int, keys: np.ndarray, counts: np.ndarray, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    for low in range(0, len(keys), _CHUNK):
        row = (kind, shard, None, None, None, None, None, None, keys[low:low + _CHUNK], counts[low:low + _CHUNK])
        yield _rows([row], pa.nulls(1, id_type))


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys with the sums of their counts."""
    keys, counts = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 2
    keys, place = np.unique(keys, return_inverse=True)
    return keys, np.bincount(place, counts, len(keys)).astype(np.int64)


def _stage(a: str, b: str, shard_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, part = _pair(a, b), TaskContext.get().partitionId()
        vector = np.zeros(len(pair.same), np.int64)
        shard, size, asked, id_type = part << 32, 0, [], None
        for batch in batches:
            texts, id_type = byte_lists(batch.column("text")), batch.column("id").type
            for low, high in slices(texts):
                ok, (ia, ib), (na, nb) = pair.tokens(texts[low:high])
                last_a, last_b = pair.groups(ia, ib)
                entries = pair.spelled(ia, ib, last_a, last_b)
                link_a, link_b = ia[last_a], ib[last_b]
                same = pair.same[link_a] == link_b
                vector += np.bincount(link_a[same], minlength=len(vector))
                keys = link_a << 32 | link_b
                found, n = np.unique(keys[~same], return_counts=True)
                asked.append((found, n.astype(np.int64)))
                # borders between the texts: in tokens, and in groups
                to_a, to_b = np.concatenate(([0], np.cumsum(na))), np.concatenate(([0], np.cumsum(nb)))
                to_g = np.searchsorted(last_a, to_a)
                rows, k = [], 0
                for good in ok:
                    if good:
                        g = slice(to_g[k], to_g[k + 1])
                        mine, s = keys[g], same[g]
                        rows.append((DOC, shard, na[k], nb[k], g.stop - g.start, pair.digest(entries[to_a[k] + to_b[k]:to_a[k + 1] + to_b[k + 1]]),
                                     link_a[g][s].astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), planes(mine[~s]), None, None))
                        k += 1
                    else:
                        rows.append((DOC, shard, 0, 0, 0, "", b"", b"", None, None))
                yield _rows(rows, batch.column("id").slice(low, high - low))
                size += sum(map(len, texts[low:high]))
                if size >= shard_bytes or len(asked) >= 64:
                    asked = [_summed(asked)]
                if size >= shard_bytes:
                    yield from _counted(ASKED, shard, *asked[0], id_type)
                    shard, size, asked = shard + 1, 0, []
        if asked:
            yield from _counted(ASKED, shard, *_summed(asked), id_type)
        seen = np.flatnonzero(vector)
        if id_type is not None:
            yield from _counted(VECTOR, part, seen, vector[seen], id_type)

    return run


def _told(vector: np.ndarray, best: np.ndarray, same: np.ndarray):
    """Documents with the sums over their links; a shard's counts come before its documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, parts, known = None, [], None
        top = np.zeros(len(vector), bool)
        top[same >= 0] = vector[same >= 0] == best[same[same >= 0]]
        for batch in batches:
            column = {n: batch.column(n) for n in batch.schema.names}
            kinds, shards = (column[n].to_numpy(zero_copy_only=False) for n in ("kind", "shard"))
            sums, bests = np.zeros(len(kinds), np.int64), np.zeros(len(kinds), np.int64)
            for i, (kind, s) in enumerate(zip(kinds, shards)):
                if s != shard:
                    shard, parts, known = s, [], None
                if kind == ASKED:
                    parts.append([column[n][i].values.to_numpy(zero_copy_only=False) for n in ("keys", "counts")])
                    continue
                if known is None:
                    keys, counts = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 2
                    order = np.argsort(keys)
                    known, parts = (keys[order], counts[order]), []
                equal = np.ascontiguousarray(np.frombuffer(column["same"][i].as_py(), np.uint8).reshape(4, -1).T).view("<u4").ravel()
                other = unplanes(column["other"][i].as_py())
                n = known[1][np.searchsorted(known[0], other)]
                sums[i] = vector[equal].sum() + n.sum()
                bests[i] = np.count_nonzero(top[equal]) + np.count_nonzero(n == best[other & 0xFFFFFFFF])
            docs = pa.array(kinds == DOC)
            out = pa.RecordBatch.from_arrays(
                [*[column[n] for n in ("id", "n_a", "n_b", "n_groups")], column["n_groups"], pa.array(bests), pa.array(sums), column["groups_sha256"]],
                ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])
            yield out.filter(docs)

    return run


def align(
    docs: DataFrame, ranks: str, model: str, shard_bytes: int = 8 << 20, id_column: str = "doc_id", text_column: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """Documents with what their tokens and links come to, and the corpus's pairs ``a_id, b_id, n``.

    Documents have the id, ``n_a`` and ``n_b`` tokens, ``n_groups``, ``n_links``, ``n_best`` (links whose pair
    is linked most often of all pairs with its B id, ties included), ``count_sum`` (of the counts of the links' pairs) and
    the digest of the groups.

    A null or empty text, and one whose tokens don't spell ``space + text`` in both tokenizers, has no tokens: zeros and
    an empty digest. Each row counts for itself, also rows that repeat or have no id; an empty table gives no rows and no
    pairs; other columns are not read. A text is in one worker as a whole, with some 100 bytes for each of its bytes.
    """
    pair = _pair(ranks, model)
    rows = docs.select(F.col(id_column).alias("id"), whole(text_column).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    staged = materialize(rows.mapInArrow(_stage(ranks, model, shard_bytes), f"id {kind}, " + ", ".join(f"{n} {t}" for n, _, t in _STAGED)), "aligned")

    each = lambda k: staged.filter(F.col("kind") == k).select("shard", F.explode(F.arrays_zip("keys", "counts")).alias("x")).select(
        "shard", F.col("x.keys").alias("key"), F.col("x.counts").alias("n"))
    # No more rows than A's vocabulary has ids.
    vector = np.zeros(len(pair.same), np.int64)
    for r in each(VECTOR).groupBy("key").agg(F.sum("n").alias("n")).collect():
        vector[r.key] = r.n
    asked = each(ASKED)
    totals = materialize(asked.groupBy("key").agg(F.sum("n").alias("n")), "pairs")
    best = np.zeros(len(pair.sizes[1]), np.int64)
    np.maximum.at(best, pair.same[pair.same >= 0], vector[pair.same >= 0])
    b_id = F.col("key").bitwiseAND(F.lit(0xFFFFFFFF))
    # No more rows than B's vocabulary has ids.
    for r in totals.groupBy(b_id.alias("b")).agg(F.max("n").alias("n")).collect():
        best[r.b] = max(best[r.b], r.n)

    answers = (asked.select("shard", "key").join(totals, "key").groupBy("shard", F.pmod(F.xxhash64("key"), F.lit(16)).alias("part"))
               .agg(F.collect_list(F.struct("key", "n")).alias("found"))
               .select(F.lit(None).cast(kind).alias("id"), F.lit(ASKED).alias("kind"), "shard",
                       F.col("found.key").alias("keys"), F.col("found.n").alias("counts")))
    told = ["id", "kind", "shard", "n_a", "n_b", "n_groups", "groups_sha256", "same", "other", "keys", "counts"]
    met = staged.filter(F.col("kind") == DOC).select(told).unionByName(answers, allowMissingColumns=True)
    # Shards are dealt out in turn: numbered by task and in it, so a hash would only make them uneven.
    turn = F.pmod(F.shiftright("shard", 32) + F.lit(_TURN) * F.col("shard").bitwiseAND(F.lit(0xFFFFFFFF)), F.lit(partitions(docs)))
    met = met.repartitionById(partitions(docs), turn.cast("int")).sortWithinPartitions("shard", F.desc("kind"))
    out = met.mapInArrow(_told(vector, best, pair.same),
                         f"id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string")
    spark = docs.sparkSession
    equal = spark.createDataFrame([(int(a), int(pair.same[a]), int(vector[a])) for a in np.flatnonzero(vector)], "a_id bigint, b_id bigint, n bigint")
    pairs = equal.unionByName(totals.select(F.shiftright("key", 32).alias("a_id"), b_id.alias("b_id"), "n"))
    return out.withColumnRenamed("id", id_column), pairs
