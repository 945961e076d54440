"""Exact top-k inner products by distributed histogram selection.

Candidates are packed into blocks once and stay where they are. The queries go to them, a bounded
chunk at a time: at most about ``_CHUNK`` components are broadcast at once, so one pass over the candidates
scores a whole chunk, a pair of blocks at a time, in numpy. The k-th score of each query is
located first: a histogram over all candidates finds the bin that holds it, a finer one that bin,
until a bin is one score wide. A block of candidates only reports the bins from its own k-th score
up, as nothing lower can count. Then the scores above the k-th value, and of those equal to it the
smallest ids of each block, go on to be ranked. Nothing but these and the histograms is shuffled,
whatever the number of candidates or queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from wordloom.session import discard, new_path, spread, store

_BINS = 256
#: Components in a block of queries or candidates, and in the queries that are broadcast at once (16 MB as longs).
_CELLS, _CHUNK = 1 << 18, 1 << 21
_BLOCK = "dim int, ids binary, low binary, need binary, body binary"


def quantise(vector: Column, scale: float = 64.0) -> Column:
    """floor(scale * x) of each component; null for a vector that is null or holds null,
    NaN or an infinity."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    fine = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.when(vector.isNotNull() & fine, F.transform(wide, lambda x: F.floor(x * scale).cast("bigint")))


def _pack(block_rows: int, kind: str):
    """Rows to blocks of one dimension, at most ``block_rows`` rows and, beyond one row, ``_CELLS`` components."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def block(dim: int, rows: list) -> pa.RecordBatch:
            ids, low, need, vectors = zip(*rows)
            raw = [np.array(c, np.int64).tobytes() for c in (ids, low, need)] + [np.array(vectors, kind).tobytes()]
            return pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32())] + [pa.array([r], pa.binary()) for r in raw],
                ["dim", "ids", "low", "need", "body"])

        for batch in batches:
            for i, low, need, v in zip(*[batch.column(c).to_pylist() for c in ("id", "low", "need", "v")]):
                rows = held.setdefault(len(v), [])
                rows.append((i, low, need, v))
                if len(rows) >= block_rows or (len(rows) + 1) * len(v) > _CELLS:
                    yield block(len(v), held.pop(len(v)))
        for dim, rows in held.items():
            yield block(dim, rows)

    return run


def _scores(row: dict, kind: str, wide: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query ids, candidate ids and scores; a query's own row gets the lowest number."""
    dim = row["dim"]
    q, c = (np.frombuffer(row[k], np.int64) for k in ("q_ids", "ids"))
    a, b = (np.frombuffer(row[k], kind).reshape(len(ids), dim) for k, ids in (("q_body", q), ("body", c)))
    if wide:
        s = a.astype(np.int64) @ b.astype(np.int64).T
    else:  # exact: the sums of products stay below 2 ** 53
        s = (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    s[q[:, None] == c[None, :]] = np.iinfo(np.int64).min
    return q, c, s


def _floor(s: np.ndarray, k: int) -> np.ndarray:
    """The k-th highest score of each query in this block."""
    if s.shape[1] <= k:
        return np.full(len(s), np.iinfo(np.int64).min + 1)
    return np.maximum(np.partition(s, -k, axis=1)[:, -k], np.iinfo(np.int64).min + 1)


def _histogram(k: int, width: int, span: int, kind: str, wide: bool):
    """query, bin, count over [low, low + span) of each query, in bins of ``width``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q, _, s = _scores(row, kind, wide)
                low = np.frombuffer(row["q_low"], np.int64)
                least = np.maximum(_floor(s, k), low)
                least = low + (least - low) // width * width  # whole bins only
                at, col = np.nonzero((s >= least[:, None]) & (s < (low + span)[:, None]))
                cell = (s[at, col] - low[at]) // width
                keys, n = np.unique(at * _BINS + cell, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q[keys // _BINS]), pa.array(keys % _BINS), pa.array(n.astype(np.int64))],
                    ["query_id", "bin", "n"])

    return run


def _select(k: int, kind: str, wide: bool):
    """Rows above the k-th score, and the smallest ids of those equal to it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q, c, s = _scores(row, kind, wide)
                order = np.argsort(c, kind="stable")
                c, s = c[order], s[:, order]
                low, need = (np.frombuffer(row[x], np.int64) for x in ("q_low", "q_need"))
                own = s == np.iinfo(np.int64).min
                above = (s > low[:, None]) & ~own
                tie = (s == low[:, None]) & ~own
                at, col = np.nonzero(tie)  # by query, then by id
                starts = np.searchsorted(at, np.arange(len(q)))
                fine = np.arange(len(at)) - starts[at] < need[at]
                a2, c2 = np.nonzero(above)
                at, col = np.concatenate((at[fine], a2)), np.concatenate((col[fine], c2))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q[at]), pa.array(c[col]), pa.array(s[at, col])], ["query_id", "vec_id", "score"])

    return run


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 20, id_column: str = "vec_id",
    vector_column: str = "embedding", scale: float = 64.0, block_rows: int = 1024, chunk: int = _CHUNK,
) -> DataFrame:
    """query_id, rank, vec_id, score: for each query row its ``k`` highest inner products of
    quantised vectors, ties to the smaller id, over all rows with another id.

    Rows whose vector or id is null, or whose vector holds null, NaN or an infinity, take no
    part; vectors of another length are no candidates for a query. Repeated rows are separate
    candidates; of query rows with one id the smallest vector asks. Empty vectors score 0; an
    empty table, or one without queries, gives no rows; other columns are not read. Vectors so long
    that a score could leave the range of a long raise an ``OverflowError``. ``chunk`` is the
    number of components of the queries that are broadcast at once.
    """
    spark = vectors.sparkSession
    zero = F.lit(0).cast("bigint")
    rows = vectors.select(
        F.col(id_column).cast("bigint").alias("id"), quantise(F.col(vector_column), scale).alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("asks")).filter("id is not null and v is not null")
    asked, asked_path = store(rows.filter("asks").groupBy("id").agg(F.min("v").alias("v")), "asked")
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    longest = rows.agg(F.max(length)).first()[0] or 0.0
    most, cells, queries = asked.agg(F.max(length), F.sum(F.size("v") + F.lit(1)), F.count(F.lit(1))).first()
    bound = int(longest * (most or 0.0) * (1 + 1e-9)) + 1  # Cauchy and Schwarz
    if bound >= 1 << 62:
        raise OverflowError("the vectors are so long that a score could leave the range of a long")
    wide = bound >= 1 << 52
    kind = "i4" if longest < 1 << 31 else "i8"

    plain = rows.select("id", zero.alias("low"), zero.alias("need"), "v")
    candidates, candidates_path = store(spread(plain).mapInArrow(_pack(4 * block_rows, kind), _BLOCK), "blocks")
    candidates = candidates.drop("low", "need")
    chunks = max(1, -(-(cells or 0) // chunk))
    parts = max(1, -(-queries // (chunks * block_rows)))
    found = new_path(spark, "best")

    for number in range(chunks):
        mine = asked.filter(F.pmod(F.xxhash64("id"), F.lit(chunks)) == number)

        def paired(state: DataFrame, mine: DataFrame = mine) -> DataFrame:
            """The chunk's blocks of queries, which carry their state, with every block of candidates."""
            q = mine.join(state, mine.id == state.query_id).select("id", "low", "need", "v").repartition(parts, "id")
            q = q.mapInArrow(_pack(block_rows, kind), _BLOCK).select(
                "dim", *[F.col(c).alias(f"q_{c}") for c in ("ids", "low", "need", "body")])
            return candidates.join(F.broadcast(q), "dim")  # bounded by ``chunk``

        state, state_path = mine.select(F.col("id").alias("query_id"), F.lit(-bound).cast("bigint").alias("low"),
                                        F.lit(k).cast("bigint").alias("need")), None
        span = 2 * bound + 1
        while span > 1:
            width = -(-span // _BINS)
            bins = paired(state).mapInArrow(_histogram(k, width, span, kind, wide), "query_id bigint, bin bigint, n bigint")
            bins = bins.groupBy("query_id", "bin").agg(F.sum("n").alias("n"))
            down = Window.partitionBy("query_id").orderBy(F.desc("bin"))
            reached = (bins.withColumn("upto", F.sum("n").over(down)).join(state, "query_id")
                       .filter((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("n") < F.col("need"))))
            hit = reached.select("query_id", (F.col("low") + F.col("bin") * width).alias("low_"),
                                 (F.col("need") - F.col("upto") + F.col("n")).alias("need_"))
            # A query with fewer candidates than k keeps its lowest bin: all of them are in.
            replaced = state_path
            state, state_path = store(state.join(hit, "query_id", "left").select(
                "query_id", F.coalesce("low_", "low").alias("low"), F.coalesce("need_", "need").alias("need")), "state")
            if replaced:
                discard(spark, replaced)
            span = width
        best = paired(state).mapInArrow(_select(k, kind, wide), "query_id bigint, vec_id bigint, score bigint")
        best.write.mode("append").parquet(found)
        discard(spark, state_path)
    discard(spark, asked_path)
    discard(spark, candidates_path)

    best = spark.read.schema("query_id bigint, vec_id bigint, score bigint").parquet(found)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
