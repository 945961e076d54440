"""Helpers shared by the operators: null-safe texts, word runs hashed in numpy."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Characters between words; a word is a run of anything else.
SPACE = r"\x20\x09-\x0D"

_U = np.uint64
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


def whole(name: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` doesn't have, whatever extra columns it carries."""
    taken = {c.lower() for c in df.columns}
    name = f"_{stem}"
    while name.lower() in taken:
        name = "_" + name
    return name


def partitions(df: DataFrame) -> int:
    """How many ways to deal out by key: the session's shuffle setting."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values: equal in, equal out; every output bit depends on all input bits."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x = x * _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def byte_lists(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as UTF-8; null counts as empty."""
    return [x or b"" for x in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()]


def slices(texts: Sequence[bytes], most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of texts of about ``most`` bytes; a longer text is alone in its range."""
    low = size = 0
    for i, t in enumerate(texts):
        if i > low and size + len(t) > most:
            yield low, i
            low, size = i, 0
        size += len(t)
    if low < len(texts):
        yield low, len(texts)


_powers: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}


def _tables(seed: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A value for each byte, powers of the multiplier and of its inverse."""
    have = _powers.get(seed)
    if have is None or len(have[1]) < n:
        n = max(n, 1 << 20)
        p = _MULTIPLIERS[seed]
        values = mix(np.arange(1, 257, dtype=_U) * _U(_MULTIPLIERS[1 - seed]))
        up, down = (np.cumprod(np.concatenate((np.ones(1, _U), np.full(n, q, _U))), dtype=_U)
                    for q in (p, pow(p, -1, 1 << 64)))
        have = _powers[seed] = values, up, down
    return have


class Words:
    """The words of several texts in one buffer, single spaces between them.

    ``first[i]`` is the number of words before text i; ``run`` hashes any run of words
    by its exact bytes, from prefix sums, in constant time for each run.
    """

    def __init__(self, texts: Sequence[bytes]):
        parts = [b" ".join(t.split()) for t in texts]
        counts = np.array([p.count(b" ") + 1 if p else 0 for p in parts], np.int64)
        self.counts, self.first = counts, np.concatenate(([0], np.cumsum(counts)))
        self.data = np.frombuffer(b" ".join(p for p in parts if p), np.uint8)
        gaps = np.flatnonzero(self.data == 32)
        n = int(self.first[-1])
        self.start = np.concatenate(([0], gaps + 1))[:n]
        self.end = np.concatenate((gaps, [len(self.data)]))[:n]
        self._sums: dict[int, np.ndarray] = {}

    def __len__(self) -> int:
        return int(self.first[-1])

    def run(self, low: np.ndarray, high: np.ndarray, seed: int = 0) -> np.ndarray:
        """Hashes of the words low .. high-1."""
        values, up, down = _tables(seed, len(self.data) + 1)
        if seed not in self._sums:
            sums = np.zeros(len(self.data) + 1, _U)
            np.cumsum(values[self.data] * up[: len(self.data)], out=sums[1:])
            self._sums[seed] = sums
        s, a, b = self._sums[seed], self.start[low], self.end[high - 1]
        return mix((s[b] - s[a]) * down[a])

    def runs(self, n: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``n`` words inside one text, and where each starts."""
        if len(self) < n:
            return np.zeros(0, _U), np.zeros(0, np.int64)
        low = np.arange(len(self) - n + 1)
        text = self.text_of(low)
        low = low[low + n <= self.first[text + 1]]
        return self.run(low, low + n, seed), low

    def text_of(self, word: np.ndarray) -> np.ndarray:
        """Which text a word belongs to."""
        return np.repeat(np.arange(len(self.counts)), self.counts)[word]


# --- arrays as rows ------------------------------------------------------------------
# Millions of small records travel as a few binary columns: one row holds the records of one
# task for one bucket, byte plane by byte plane, so that equal high bytes compress.

def planes(x: np.ndarray) -> bytes:
    """64-bit values as bytes, all first bytes first."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8).T.tobytes()


def unplanes(data: bytes, dtype=np.int64) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(dtype).ravel()


def bucket_of(key: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket by the high half of a well-spread key."""
    return ((key >> _U(32)) * _U(buckets) >> _U(32)).astype(np.int64)


def by_bucket(bucket: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The columns' parts for each bucket that occurs."""
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    for part in np.split(order, cuts):
        yield int(bucket[part[0]]), [c[part] for c in columns]


def batch(schema: Sequence[tuple[str, pa.DataType]], rows: Sequence[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, schema)], [n for n, _ in schema])


def xxhash_long(x: np.ndarray, seed: int = 42) -> np.ndarray:
    """What ``xxhash64`` gives in SQL for one bigint."""
    p1, p2, p3, p4, p5 = (_U(v) for v in (
        0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    turn = lambda v, n: (v << _U(n)) | (v >> _U(64 - n))
    with np.errstate(over="ignore"):
        h = (_U(seed) + p5 + _U(8)) ^ (turn(x.view(_U) * p2, 31) * p1)
        h = turn(h, 27) * p1 + p4
        h = (h ^ (h >> _U(33))) * p2
        h = (h ^ (h >> _U(29))) * p3
    return (h ^ (h >> _U(32))).view(np.int64)
