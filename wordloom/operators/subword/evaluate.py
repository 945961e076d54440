"""Model evaluation and token statistics, for several models in one pass.

Word-level numbers come from the distinct white-space words, weighted by their
counts; line-level numbers (reconstruction) from one map-only pass over the lines.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from wordloom import rules
from wordloom.functions import tokenizers as tk
from wordloom.operators import stats
from wordloom.operators.subword.encode import Shared
from wordloom.operators.subword.model import SubwordModel
from wordloom.operators.subword.types import space_word_types, word_types
from wordloom.session import materialize, spread


def word_counts(df: DataFrame, models: Mapping[str, SubwordModel], text: str = "text", shared: Shared | None = None) -> DataFrame:
    """(model, n_tokens, cnt): white-space words by the number of their subwords."""
    shared = shared or Shared(df.sparkSession, models)
    counted = space_word_types(df, text).select("cnt", shared.counted(tk.subword_pretokens(F.col("word"))).alias("x"))
    return counted.groupBy("x.model", "x.n_tokens").agg(F.sum("cnt").cast("bigint").alias("cnt"))


def word_metrics(counts: DataFrame) -> DataFrame:
    n, cnt = F.col("n_tokens"), F.col("cnt")
    tokens = F.sum(F.greatest(n, F.lit(1)) * cnt)
    split = F.sum(F.when(n > 1, cnt).otherwise(F.lit(0)))
    return counts.groupBy("model").agg(
        F.sum(cnt).cast("bigint").alias("total_words"),
        tokens.cast("bigint").alias("total_tokens"),
        split.cast("bigint").alias("fragmented_words"),
        (100.0 * stats.ratio(split, F.sum(cnt))).alias("frag_percent"),
        stats.ratio(F.sum(cnt), tokens).alias("compression_ratio"),
    )


def reconstruction(
    df: DataFrame, models: Mapping[str, SubwordModel], text: str = "text", lossless: bool = False, shared: Shared | None = None,
) -> DataFrame:
    """(model, total_lines, exact fraction, mean normalized edit distance).

    The plain form joins tokens by spaces and leaves the unknown token out; ``lossless`` joins them without
    spaces or prefixes and compares with the pre-tokens joined the same way. A null text counts as empty.
    """
    shared = shared or Shared(df.sparkSession, models)
    pretokens = tk.subword_pretokens(F.col(text))
    line = F.array_join(pretokens, "") if lossless else F.col(text)
    lines = spread(df.select(text)).select(shared.restored(pretokens, F.coalesce(line, F.lit("")), lossless).alias("x"))
    return lines.groupBy("x.model").agg(
        F.count("*").alias("total_lines"),
        stats.ratio(F.count_if("x.back.same"), F.count("*")).alias("reconstruction_exact_frac"),
        F.coalesce(F.avg("x.back.distance"), F.lit(1.0)).alias("avg_normalized_edit_distance"),
    )


def evaluate(df: DataFrame, models: Mapping[str, SubwordModel], text: str = "text") -> DataFrame:
    """Eight metrics per model, as a stored table; the models are released."""
    with Shared(df.sparkSession, models) as shared:
        return materialize(reconstruction(df, models, text, shared=shared).join(
            word_metrics(word_counts(df, models, text, shared=shared)), "model"
        ).select(
            "model", "total_lines", "total_words", "total_tokens", "fragmented_words",
            "frag_percent", "compression_ratio", "reconstruction_exact_frac",
            "avg_normalized_edit_distance",
        ), "metrics")


def token_counts(df: DataFrame, models: Mapping[str, SubwordModel], text: str = "text") -> DataFrame:
    """(model, token, id, cnt) over the whole corpus, from the distinct pre-tokens."""
    shared = Shared(df.sparkSession, models)
    encoded = word_types(df, text).select("cnt", shared.encoded(F.array("word"), remember=0).alias("x")).select("x.model", "cnt", "x.enc")
    pairs = F.explode(F.arrays_zip(F.col("enc.tokens").alias("token"), F.col("enc.ids").alias("id")))
    return encoded.select("model", "cnt", pairs.alias("p")).groupBy("model", "p.token", "p.id").agg(
        F.sum("cnt").cast("bigint").alias("cnt")
    )


def token_statistics(counts: DataFrame, words: DataFrame) -> DataFrame:
    """One row per model from :func:`token_counts` and :func:`word_counts`.

    ``unk_count`` counts by id; ``unk_by_string`` by the token's spelling, which
    misses the unknowns of a unigram model.
    """
    cnt = F.col("cnt")
    totals = counts.groupBy("model").agg(
        F.sum(cnt).cast("bigint").alias("total_tokens"),
        F.sum(F.when(F.col("id") == 0, cnt).otherwise(0)).cast("bigint").alias("unk_count"),
        F.sum(F.when(F.col("token").isin(rules.UNK, rules.UNK.lower()), cnt).otherwise(0))
        .cast("bigint").alias("unk_by_string"),
        F.count("*").alias("distinct_tokens"),
    ).withColumn("oov_ratio", stats.ratio(F.col("unk_by_string"), F.col("total_tokens")))
    per_word = stats.mean_and_median(words.withColumnRenamed("n_tokens", "value"), ["model"])
    return totals.join(per_word.select(
        "model", F.col("mean").alias("tokens_per_word_mean"),
        F.col("median").alias("tokens_per_word_median"),
    ), "model")


def token_length_distribution(counts: DataFrame) -> DataFrame:
    return stats.distribution(counts, F.length("token"), ["model"], F.col("cnt"))
