"""From raw documents to packed sequences: five stages, each written as Parquet and read again.

Toxic documents go, one of each group of equal texts stays, then one of each class of near copies,
then a sample whose tokens meet the target shares, and that is packed. All stages but the last
return the columns of ``documents``, whatever extra columns those have; each handles null texts and ids,
repeated rows and empty tables as its operator states.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from wordloom.llm import exact_dedup, mixing, near_dedup, packing, toxicity
from wordloom.llm.queries_corpus import CAPACITY, MIX, TOXIC_FROM, held_out
from wordloom.session import store
from wordloom.sources.tables import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose score stays below the threshold; the lexicon comes from the labels."""
    lexicon = toxicity.learn(docs, table(spark, folder, "labels"), ~held_out(4))
    scored, score, _ = toxicity.with_scores(docs, lexicon)
    return scored.filter(F.col(score) < TOXIC_FROM).select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return exact_dedup.drop_copies(docs, keep="max")


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return near_dedup.drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    sampled, names = mixing.sample_to_targets(docs, **MIX)
    return sampled.filter(F.col(names["kept"])).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"),
                        public_tokenizers.path("byte_bpe_50k.tiktoken"), CAPACITY)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix),
    ("packing", pack),
]

#: SQL has neither the learned lexicon nor the samples of the near copies nor the tokenizer.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    for name, stage in STAGES:
        docs, _ = store(stage(spark, docs, folder), f"stage-{name}")
    return docs
