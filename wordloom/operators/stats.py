"""Corpus and token statistics: totals, distributions, histograms, summaries.

Everything is reduced to a small distribution table first (a length, a number of
tokens per word), and medians and histograms are read off that table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wordloom.functions import text as tx
from wordloom.session import materialize


def ratio(a: Column, b: Column, default: float = 0.0) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(default))


def distribution(df: DataFrame, value: Column, by: Sequence[str] = (), weight: Column | None = None) -> DataFrame:
    """How often each value occurs, per group."""
    count = F.count("*") if weight is None else F.sum(weight)
    return df.groupBy(*by, value.alias("value")).agg(count.cast("bigint").alias("cnt"))


def mean_and_median(dist: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Exact mean and median of a distribution table; 0 for no rows."""
    v, n = F.col("value"), F.col("cnt")
    return dist.groupBy(*by).agg(
        F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("n"),
        ratio(F.sum(v * n), F.sum(n)).alias("mean"),
        F.coalesce(F.percentile(v, 0.5, n), F.lit(0.0)).alias("median"),
    )


def histogram(dist: DataFrame, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins between the extremes; the maximum falls in the last bin."""
    # The distribution is small; stored, it is not counted again to find its limits.
    dist = materialize(dist, "distribution")
    limits = dist.groupBy(*by).agg(
        F.min("value").cast("double").alias("lo"), F.max("value").cast("double").alias("hi")
    )
    if by:
        joined = dist.join(limits, list(by))
    else:
        joined = dist.withColumns({c: limits.select(c).scalar() for c in ("lo", "hi")})
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    cell = F.floor(F.try_divide(F.col("value") - F.col("lo"), width)).cast("bigint") + 1
    return (
        joined.withColumn("bin", F.least(F.coalesce(cell, F.lit(1)), F.lit(bins)).cast("bigint"))
        .withColumn("bin_start", F.col("lo") + (F.col("bin") - 1) * width)
        .groupBy(*by, "bin", "bin_start").agg(F.sum("cnt").cast("bigint").alias("cnt"))
    )


def corpus_summary(df: DataFrame, text: Column, tokens: Column, by: Sequence[str] = ()) -> DataFrame:
    """Documents, words and tokens; tokens per word."""
    return df.groupBy(*by).agg(
        F.count("*").alias("documents"),
        F.coalesce(F.sum(tx.word_count(text)), F.lit(0)).cast("bigint").alias("total_words"),
        F.coalesce(F.sum(F.size(tokens)), F.lit(0)).cast("bigint").alias("total_tokens"),
    ).withColumn("tokens_per_word", ratio(F.col("total_tokens"), F.col("total_words")))


def unk_ratio(tokens: DataFrame, by: Sequence[str] = (), unk: Sequence[str] = ("[UNK]", "[unk]")) -> DataFrame:
    """Share (a fraction) of unknown tokens in a ``(token, cnt)`` table."""
    unknown = F.sum(F.when(F.col("token").isin(list(unk)), F.col("cnt")).otherwise(F.lit(0)))
    return tokens.groupBy(*by).agg(
        F.coalesce(F.sum("cnt"), F.lit(0)).cast("bigint").alias("total_tokens"),
        F.coalesce(unknown, F.lit(0)).cast("bigint").alias("unk_count"),
        ratio(unknown, F.sum("cnt")).alias("oov_ratio"),
    )
