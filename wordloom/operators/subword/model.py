"""A trained subword model and its tables.

The model is the vocabulary and, for BPE, the merge list: both are bounded by the
vocabulary size the user asks for, so they may live on the driver and be broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from wordloom import rules

KINDS = ("bpe", "wordpiece", "unigram")
# A model is broadcast to every executor; refuse one that is not of model size.
MAX_BROADCAST_ENTRIES = 2_000_000


@dataclass(frozen=True)
class SubwordModel:
    kind: str
    vocab: list[str]                       # index = id, 0 = unknown
    merges: list[tuple[int, int]] = field(default_factory=list)
    merge_ids: list[int] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    # Entries before this id are not made by merging (unknown token and alphabet).
    base_size: int = 1

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"unknown model kind {self.kind!r}")
        if len(self.vocab) + len(self.merges) > MAX_BROADCAST_ENTRIES:
            raise ValueError("model too large to broadcast")

    def truncated(self, vocab_size: int) -> "SubwordModel":
        """The model that training with a smaller vocabulary size gives.

        Merge-based training is a prefix process: the size only says when to stop.
        """
        if self.kind == "unigram":
            raise ValueError("a unigram model is not a prefix of a larger one")
        size, keep = self.base_size, 0
        for new in self.merge_ids:
            if size >= vocab_size:
                break
            size = max(size, new + 1)
            keep += 1
        return SubwordModel(
            self.kind, self.vocab[:size], self.merges[:keep], self.merge_ids[:keep], [],
            self.base_size,
        )


def save(spark: SparkSession, model: SubwordModel, path: str) -> None:
    """Write the ``vocab``, ``merges`` and ``meta`` tables."""
    scores = model.scores or [0.0] * len(model.vocab)
    vocab_table(spark, model).write.mode("overwrite").parquet(f"{path}/vocab")
    merges = [
        (i, l, r, n) for i, ((l, r), n) in enumerate(zip(model.merges, model.merge_ids))
    ]
    spark.createDataFrame(
        merges, "rank bigint, left_id int, right_id int, new_id int"
    ).write.mode("overwrite").parquet(f"{path}/merges")
    spark.createDataFrame(
        [(model.kind, model.base_size, bool(model.scores))],
        "kind string, base_size int, scored boolean",
    ).write.mode("overwrite").parquet(f"{path}/meta")
    assert len(scores) == len(model.vocab)


def load(spark: SparkSession, path: str) -> SubwordModel:
    meta = spark.read.parquet(f"{path}/meta").first()
    vocab = spark.read.parquet(f"{path}/vocab").orderBy("id").collect()
    merges = spark.read.parquet(f"{path}/merges").orderBy("rank").collect()
    return SubwordModel(
        meta.kind,
        [r.token for r in vocab],
        [(r.left_id, r.right_id) for r in merges],
        [r.new_id for r in merges],
        [r.score for r in vocab] if meta.scored else [],
        meta.base_size,
    )


def vocab_table(spark: SparkSession, model: SubwordModel) -> DataFrame:
    scores = model.scores or [0.0] * len(model.vocab)
    return spark.createDataFrame(
        [(t, i, float(s)) for i, (t, s) in enumerate(zip(model.vocab, scores))],
        "token string, id int, score double",
    )


def merges_table(spark: SparkSession, model: SubwordModel) -> DataFrame:
    return spark.createDataFrame(
        [
            (i, model.vocab[l], model.vocab[r], model.vocab[n])
            for i, ((l, r), n) in enumerate(zip(model.merges, model.merge_ids))
        ],
        "rank bigint, left string, right string, merged string",
    )


def decode(tokens, skip: str | None = rules.UNK):
    """Tokens joined by one space, the special unknown token left out."""
    kept = F.filter(tokens, lambda t: t != skip) if skip else tokens
    return F.array_join(kept, " ")
