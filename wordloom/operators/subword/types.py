"""The word-type table: distinct pre-tokens of a corpus with their counts.

Trainers and statistics work on it instead of on the running text; it is the one
pass over the corpus, combined on the map side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wordloom.functions import text as tx, tokenizers as tk


def word_types(df: DataFrame, text: str = "text") -> DataFrame:
    tokens = tk.subword_pretokens(tx.flatten_newlines(F.col(text)))
    return df.select(F.explode(tokens).alias("word")).groupBy("word").agg(
        F.count("*").alias("cnt")
    )


def space_word_types(df: DataFrame, text: str = "text") -> DataFrame:
    """Distinct white-space words with their counts."""
    return df.select(F.explode(tx.words(F.col(text))).alias("word")).groupBy("word").agg(
        F.count("*").alias("cnt")
    )


def alphabet(types: DataFrame) -> list[str]:
    """Distinct characters by code point: at most the size of Unicode."""
    chars = types.select(F.explode(F.split("word", "")).alias("c")).filter(F.col("c") != "")
    return sorted(r.c for r in chars.distinct().collect())
