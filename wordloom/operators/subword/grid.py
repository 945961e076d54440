"""Model x vocabulary-size grid: trained on one type table, evaluated in one pass."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, functions as F

from wordloom import rules
from wordloom.operators.subword import merging, registry
from wordloom.operators.subword.evaluate import evaluate
from wordloom.operators.subword.model import KINDS, SubwordModel
from wordloom.operators.subword.types import word_types
from wordloom.operators.subword.unigram import train_unigram_sizes
from wordloom.session import discard, new_path, store


def train_all(
    types: DataFrame, sizes: Sequence[int], min_frequency: int, kinds: Sequence[str] = KINDS
) -> dict[str, SubwordModel]:
    """Models by name ``kind_vSIZE``. A merge-based model is trained once, for the largest size, and cut
    for the others; unigram models share their rounds. The kinds are trained side by side: their
    rounds are small jobs that leave cores free."""
    def train(kind: str) -> dict[int, SubwordModel]:
        if kind == "unigram":
            return train_unigram_sizes(types, sizes)
        largest = merging.train(types, max(sizes), min_frequency, kind)
        return {s: largest.truncated(s) for s in sizes}

    with ThreadPoolExecutor(len(kinds)) as pool:
        trained = list(pool.map(inheritable_thread_target(types.sparkSession)(train), kinds))
    return {f"{kind}_v{size}": model for kind, models in zip(kinds, trained) for size, model in models.items()}


def trained_grid(
    df: DataFrame, sizes: Sequence[int], min_frequency: int, text: str, kinds: Sequence[str], root: str,
) -> dict[str, SubwordModel]:
    """The grid's models, trained and saved under ``root`` or read from there if it holds them."""
    def train() -> dict[str, SubwordModel]:
        types, path = store(word_types(df, text), "types")
        models = train_all(types, sizes, min_frequency, kinds)
        discard(df.sparkSession, path)
        return models

    return registry.trained(df.sparkSession, root, train)


def training_grid(
    df: DataFrame,
    sizes: Sequence[int] = tuple(rules.VOCAB_SIZES),
    min_frequency: int = rules.MIN_FREQUENCY,
    text: str = "text",
    kinds: Sequence[str] = KINDS,
    root: str | None = None,
) -> DataFrame:
    """One row of settings and metrics per model; ``min_frequency`` is null for unigram models, which do
    not use it. The models are saved under ``root`` (a new folder if none is given), or read from
    there if it holds them; ``model_file`` says where each one is."""
    spark = df.sparkSession

    root = root or new_path(spark, "models")
    models = trained_grid(df, sizes, min_frequency, text, kinds, root)
    metrics = evaluate(df, models, text)
    settings = spark.createDataFrame(
        [(f"{kind}_v{size}", kind, size, None if kind == "unigram" else min_frequency, registry.model_folder(root, f"{kind}_v{size}"))
         for kind in kinds for size in sizes],
        "key string, kind string, vocab_size int, min_frequency int, model_file string",
    )
    return metrics.join(F.broadcast(settings), F.col("model") == F.col("key")).select(
        F.col("kind").alias("model"), "vocab_size", "min_frequency", "model_file", *metrics.columns[1:],
    )
