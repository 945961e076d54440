"""Token tables, vocabularies and out-of-vocabulary measures.

Tokens are counted right after they are exploded: the map side combines them, so
what is shuffled is one row per distinct token and task, and a very frequent
token costs no more than a rare one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def token_rows(df: DataFrame, tokens: Column, *keep: str) -> DataFrame:
    """One row per token occurrence."""
    return df.select(*keep, F.explode(tokens).alias("token"))


def token_counts(df: DataFrame, tokens: Column, by: Sequence[str] = ()) -> DataFrame:
    return token_rows(df, tokens, *by).groupBy(*by, "token").agg(F.count("*").alias("cnt"))


def top_tokens(counts: DataFrame, n: int) -> DataFrame:
    """Most frequent tokens; ties by token."""
    return counts.orderBy(F.desc("cnt"), F.asc("token")).limit(n)


def top_tokens_by(counts: DataFrame, by: Sequence[str], n: int) -> DataFrame:
    """Most frequent tokens of every group; each task keeps n rows per group before
    the shuffle (window group limit)."""
    from pyspark.sql import Window

    w = Window.partitionBy(*by).orderBy(F.desc("cnt"), F.asc("token"))
    return counts.withColumn("rank", F.row_number().over(w).cast("bigint")).filter(
        F.col("rank") <= n
    )


def vocabulary(df: DataFrame, tokens: Column) -> DataFrame:
    """Distinct lowercased tokens."""
    return df.select(F.explode(tokens).alias("t")).select(F.lower("t").alias("token")).filter(
        F.col("token") != ""
    ).distinct()


def vocabulary_size(df: DataFrame, tokens: Column, approximate: bool = False) -> DataFrame:
    if approximate:
        # One sketch per task instead of a shuffle of the vocabulary.
        return token_rows(df, tokens).agg(F.approx_count_distinct(F.lower("token"), 0.01).alias("vocab_size"))
    return vocabulary(df, tokens).agg(F.count("*").alias("vocab_size"))


#: log2 of the registers of a sketch: a standard error of 0.8 %, 16 kB.
SKETCH_BITS = 14


def vocabulary_sketches(df: DataFrame, tokens: Column, by: Sequence[str] = ()) -> DataFrame:
    """(by, sketch): a HyperLogLog sketch of each group's lowercased tokens, to be stored and united later."""
    rows = token_rows(df, tokens, *by).filter(F.col("token") != "")
    return rows.groupBy(*by).agg(F.hll_sketch_agg(F.lower("token"), F.lit(SKETCH_BITS)).alias("sketch"))


def united_vocabulary_size(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, vocab_size): about how many distinct tokens there are in all sketches of a group together."""
    union = F.hll_sketch_estimate(F.hll_union_agg("sketch"))
    return sketches.groupBy(*by).agg(F.coalesce(union, F.lit(0)).alias("vocab_size"))


def unseen_tokens(test: DataFrame, train: DataFrame) -> DataFrame:
    """Vocabulary of ``test`` that ``train`` lacks; both are ``(token)`` tables."""
    return test.join(train, "token", "left_anti")


def seen_tokens(test: DataFrame, train: DataFrame) -> DataFrame:
    return test.join(train, "token", "left_semi")


def oov_between(test: DataFrame, test_tokens: Column, train: DataFrame, train_tokens: Column) -> DataFrame:
    """Share of the test side's token occurrences not in the training vocabulary.

    The two sides meet as counts per distinct token in one grouping, so neither a
    broadcast nor a join of occurrences is needed.
    """
    sides = (
        token_rows(test, test_tokens).select(
            F.lower("token").alias("token"), F.lit(1).alias("test"), F.lit(0).alias("train"))
        .unionByName(token_rows(train, train_tokens).select(
            F.lower("token").alias("token"), F.lit(0).alias("test"), F.lit(1).alias("train")))
    )
    per_token = sides.groupBy("token").agg(F.sum("test").alias("test"), F.max("train").alias("train"))
    return per_token.agg(*oov_columns(F.col("train"), F.col("test"), with_size=False))


def oov_columns(train: Column, test: Column, with_size: bool = True) -> list[Column]:
    """Aggregates over one row per token with its training and test counts."""
    missing = F.sum(F.when(train == 0, test).otherwise(F.lit(0)))
    out = [
        F.coalesce(F.sum(test), F.lit(0)).cast("bigint").alias("test_tokens"),
        F.coalesce(missing, F.lit(0)).cast("bigint").alias("oov_tokens"),
        F.coalesce(100.0 * F.try_divide(missing.cast("double"), F.sum(test).cast("double")),
                   F.lit(0.0)).alias("oov_pct"),
    ]
    if with_size:
        out.insert(0, F.count_if(train > 0).alias("vocab_size"))
    return out


# A lookup table of up to this many short rows (some tens of megabytes) is broadcast.
BROADCAST_ROWS = 500_000
_SALTS = 32


def without_listed(rows: DataFrame, listed: DataFrame, key: str, spread: str) -> DataFrame:
    """Rows whose ``key`` is not in the one-column table ``listed``.

    The table's size is counted first. A small one is broadcast. A large one is joined
    by shuffle with every entry in ``_SALTS`` copies, and the rows of one key are dealt
    to the copies by a hash of ``spread``: a key that holds a third of all rows then
    meets its entry in many tasks.
    """
    listed = listed.select(key).distinct()
    if listed.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(listed), key, "left_anti")
    copies = listed.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(_SALTS)).cast("int"))
    return salted.join(copies, [key, "_salt"], "left_anti").drop("_salt")


def remove_stop_words(df: DataFrame, pos: str, tokens: Column, stop_words: DataFrame) -> DataFrame:
    """Anti join against a stop-word table ``(token)``, for lists too large for an
    expression; returns ``(pos, idx, token)``."""
    rows = df.select(pos, F.posexplode(tokens).alias("idx", "token"))
    return without_listed(rows, stop_words, "token", pos).select(pos, "idx", "token")


def lemmatize(counts: DataFrame, lemmas: DataFrame) -> DataFrame:
    """Look up every distinct token in a ``(token, lemma)`` table; a token without an
    entry is its own lemma."""
    return counts.join(lemmas, "token", "left").withColumn(
        "lemma", F.coalesce(F.col("lemma"), F.col("token"))
    )
