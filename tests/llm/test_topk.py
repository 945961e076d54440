import math
import random

import pytest
from pyspark.sql import functions as F

from wordloom.llm import topk


def brute(rows, k, every):
    ok = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    asked = {}
    for i, v in ok:
        if i % every == 0:
            asked[i] = min(v, asked.get(i, v))
    for q, a in asked.items():
        scored = sorted(((-sum(x * y for x, y in zip(a, v)), i) for i, v in ok if i != q and len(v) == len(a)))
        out |= {(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)}
    return out


@pytest.mark.parametrize("case", ["plain", "ties", "few", "wide", "odd"])
def test_against_brute_force(spark, case):
    rng = random.Random(case)
    n, scale = {"few": 5}.get(case, 300), {"wide": 2e6}.get(case, 1.0)
    rows = [(i, [rng.uniform(-1, 1) * scale for _ in range(8)]) for i in range(n)]
    if case == "ties":
        rows = [(i, [rng.choice([0.0, 0.5]) for _ in range(3)] if i % 3 else [0.5, 0.5, 0.5]) for i in range(n)]
    if case == "odd":
        rows += [(None, [1.0] * 8), (n, None), (n + 1, [None] + [1.0] * 7), (n + 2, [float("nan")] * 8),
                 (n + 3, [float("inf")] * 8), (n + 4, []), (n + 6, []), (n + 10, [1.0]), (n + 12, [0.5])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id bigint, embedding array<double>, score int")
    got = topk.top_k(df, F.col("vec_id") % 10 == 0, 7, block_rows=16, chunk=100).collect()
    assert {tuple(r) for r in got} == brute(rows, 7, 10)
    assert len(got) == len(set(got))


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert topk.top_k(df, F.col("vec_id") % 10 == 0).collect() == []


def test_repeated_queries_ask_once(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.5, 0.0]), (2, [0.5, 0.0])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), F.col("vec_id") == 0, 10).collect()
    assert [(r.rank, r.vec_id, r.score) for r in sorted(got)] == [(1, 1, 4096), (2, 2, 2048), (3, 2, 2048)]


def test_chunks_do_not_change_the_result(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice([0.0, 0.25, 0.5]) for _ in range(rng.choice([2, 5]))]) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    asks = F.col("vec_id") % 4 == 0
    one, many = ({tuple(r) for r in topk.top_k(df, asks, 5, **more).collect()} for more in ({}, {"chunk": 20, "block_rows": 3}))
    assert one == many == brute(rows, 5, 4)


@pytest.mark.parametrize("size", [1e9, 1e16, 1e300])
def test_scores_beyond_a_long_raise(spark, size):
    df = spark.createDataFrame([(0, [size, size]), (1, [size, -size])], "vec_id bigint, embedding array<double>")
    with pytest.raises(OverflowError):
        topk.top_k(df, F.col("vec_id") == 0)


def test_no_queries(spark):
    df = spark.createDataFrame([(1, [1.0])], "vec_id bigint, embedding array<double>")
    assert topk.top_k(df, F.col("vec_id") == 0).collect() == []
