"""Prefix, split and sample operators over an explicit order column.

A DataFrame has no row order, so each operator takes a unique integer ``pos``.
The place where a prefix ends is found by narrowing: one histogram of the
position range, then one of the bin that holds the end, until a single position
is left. Rows are never sorted or moved and each step returns at most ``_BINS``
rows, however the positions are spread; the result is a plain filter on ``pos``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

_BINS = 4096


def prefix_end(
    df: DataFrame, pos: str, weight: Column, target: float | Callable[[int], float]
) -> int | None:
    """Smallest position whose running weight reaches a positive ``target``, or None.

    ``target`` may be a function of the total weight.
    """
    slim = df.select(F.col(pos).cast("bigint").alias("p"), weight.alias("w"))
    slim = slim.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        low, high, total = slim.agg(F.min("p"), F.max("p"), F.sum("w")).first()
        if callable(target):
            target = target(total or 0)
        if low is None or target <= 0 or (total or 0) < target:
            return None
        done = 0
        while True:
            width = -(-(high - low + 1) // _BINS)
            cell = F.expr(f"(p - {low}) div {width}")
            bins = (
                slim.filter(F.col("p").between(low, high))
                .groupBy(cell.alias("cell"))
                .agg(F.sum("w").alias("w"), F.min("p").alias("a"), F.max("p").alias("b"))
                .orderBy("cell")
                .collect()
            )
            for row in bins:
                if done + (row.w or 0) >= target:
                    low, high = row.a, row.b
                    break
                done += row.w or 0
            else:
                return None
            if low == high:
                return low
    finally:
        slim.unpersist()


def _up_to(pos: str, end: int | None) -> Column:
    return F.lit(True) if end is None else F.col(pos) <= end


def first_n(df: DataFrame, pos: str, n: int | None) -> DataFrame:
    """The first ``n`` rows by position; 0 or None keeps all."""
    if not n:
        return df
    return df.filter(_up_to(pos, prefix_end(df, pos, F.lit(1), n)))


def budget_prefix(df: DataFrame, pos: str, weight: Column, budget: int) -> DataFrame:
    """Rows from the start while the total before them is below ``budget``; the row
    that crosses it is kept."""
    if budget <= 0:
        return df.filter(F.lit(False))
    return df.filter(_up_to(pos, prefix_end(df, pos, weight, budget)))


def split_train_test(
    df: DataFrame, pos: str, fraction: float = 0.8, flag: str = "is_train"
) -> DataFrame:
    """Mark the first ``int(fraction * n)`` rows by position as the training part."""
    end = prefix_end(df, pos, F.lit(1), lambda n: int(fraction * n))
    # The part never exceeds the whole, so no end means an empty training part.
    return df.withColumn(flag, F.lit(False) if end is None else F.col(pos) <= end)


def sample_n(df: DataFrame, pos: str, n: int, seed: int = 0) -> DataFrame:
    """``n`` rows without replacement, the same ones for the same seed.

    Top-n by a hash of the position: every task keeps n rows, no full sort.
    """
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.col(pos).cast("string")))
    return df.orderBy(key, F.col(pos)).limit(n)


def pair_by_position(left: DataFrame, right: DataFrame, pos: str = "pos") -> DataFrame:
    """Row i with row i; positions missing on one side have no partner."""
    return left.join(right, pos)


def first_seen(df: DataFrame, key: str, *order: str) -> DataFrame:
    """Distinct ``key`` with the smallest ``order`` tuple at which it occurs."""
    return df.groupBy(key).agg(F.min(F.struct(*order)).alias("_first")).select(key, "_first.*")
