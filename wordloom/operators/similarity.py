"""Similarity between an original and its processed counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from wordloom.functions import text as tx
from wordloom.operators.ordering import sample_n


def _dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two dense vectors; 0 when either is the zero vector."""
    norm = F.sqrt(_dot(a, a) * _dot(b, b))
    return F.coalesce(F.try_divide(_dot(a, b), F.nullif(norm, F.lit(0.0))), F.lit(0.0))


def paired_cosine(left: DataFrame, right: DataFrame, key: str, vector: str) -> DataFrame:
    """Cosine of the vectors that share a key: the diagonal, never all pairs."""
    joined = left.select(key, F.col(vector).alias("_a")).join(
        right.select(key, F.col(vector).alias("_b")), key
    )
    return joined.select(key, cosine(F.col("_a"), F.col("_b")).alias("cosine"))


def bag_cosines(df: DataFrame, key: str, original: Column, processed_tokens: Column) -> DataFrame:
    """(key, cosine): term-count cosine of a text's lowercased words and its processed tokens.

    Texts are dealt out by key, which is all that is shuffled; their terms are counted and multiplied where they then are, no
    array goes to Python. Rows of one key are one document; a null or empty side scores 0.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sides = df.repartition(parts, key).select(key, F.explode(F.array(
        F.struct(F.lit(True).alias("own"), tx.words(F.lower(original)).alias("terms")),
        F.struct(F.lit(False).alias("own"), processed_tokens.alias("terms")))).alias("s"))
    # The outer form keeps documents without terms.
    terms = sides.select(key, "s.own", F.explode_outer("s.terms").alias("term"))
    one = lambda own: F.count_if((F.col("own") == own) & F.col("term").isNotNull()).cast("double")
    counts = terms.groupBy(key, "term").agg(one(True).alias("a"), one(False).alias("b"))
    product = lambda x, y: F.sum(F.col(x) * F.col(y))
    return counts.groupBy(key).agg(
        F.coalesce(F.try_divide(product("a", "b"), F.sqrt(product("a", "a") * product("b", "b"))), F.lit(0.0)).alias("cosine"))


def mean_similarity(
    df: DataFrame,
    pos: str,
    original: Column,
    processed_tokens: Column,
    sample_size: int | None = None,
    seed: int = 0,
    embed: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Mean over a seeded sample of rows, or over all rows; 0 for none.

    ``embed`` turns a text column into dense vectors (an Arrow-batched ``pandas_udf`` around a model); the text and
    its tokens joined by spaces are then compared by their vectors.
    """
    rows = sample_n(df, pos, sample_size, seed) if sample_size else df
    if embed:
        scores = rows.select(cosine(embed(original), embed(F.array_join(processed_tokens, " "))).alias("cosine"))
    else:
        scores = bag_cosines(rows, pos, original, processed_tokens)
    return scores.agg(F.coalesce(F.avg("cosine"), F.lit(0.0)).alias("semantic_similarity"))
