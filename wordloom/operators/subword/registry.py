"""Trained models as tables, kept by what they were trained on.

One registry is three tables partitioned by model, so nine models are three writes, and loading one
reads its partitions only. A model belongs to the state of its input: a key of the input's files and of
the settings names the folder, so changed data mean another folder.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from wordloom.operators.subword.model import SubwordModel
from wordloom.session import discard, exists, work_root

_META = "model string, kind string, base_size int, learned_size int"


def model_folder(root: str, name: str) -> str:
    """Where the vocabulary of a model is; merges lie beside it."""
    return f"{root}/vocab/model={name}"


def save_all(spark: SparkSession, models: Mapping[str, SubwordModel], root: str) -> None:
    """Write all models; ``meta`` comes last and tells that the others are whole."""
    vocab = [(name, i, t, float(m.scores[i]) if m.scores else None) for name, m in models.items() for i, t in enumerate(m.vocab)]
    merges = [(name, rank, l, r, new) for name, m in models.items() for rank, ((l, r), new) in enumerate(zip(m.merges, m.merge_ids))]
    meta = [(name, m.kind, m.base_size, len(m.vocab)) for name, m in models.items()]
    for table, rows, schema in (
        ("vocab", vocab, "model string, id int, token string, score double"),
        ("merges", merges, "model string, rank bigint, left_id int, right_id int, new_id int"),
    ):
        spark.createDataFrame(rows, schema).repartition("model").write.partitionBy("model").mode("overwrite").parquet(f"{root}/{table}")
    spark.createDataFrame(meta, _META).coalesce(1).write.mode("overwrite").parquet(f"{root}/meta")


def listed(spark: SparkSession, root: str) -> DataFrame:
    """The models of a registry: name, kind, sizes."""
    return spark.read.schema(_META).parquet(f"{root}/meta")


def load_all(spark: SparkSession, root: str, names: list[str] | None = None) -> dict[str, SubwordModel]:
    """The named models, or all. Models are of a vocabulary's size and meant for the driver."""
    wanted = {r.model: r for r in listed(spark, root).collect() if names is None or r.model in names}
    if missing := set(names or ()) - set(wanted):
        raise KeyError(f"no model {sorted(missing)} in {root}")
    vocab: dict[str, list] = {name: [] for name in wanted}
    merges: dict[str, list] = {name: [] for name in wanted}
    rows = lambda table: spark.read.parquet(f"{root}/{table}").filter(F.col("model").isin(list(wanted)))
    for r in rows("vocab").orderBy("model", "id").toLocalIterator():
        vocab[r.model].append((r.token, r.score))
    if any(r.kind != "unigram" for r in wanted.values()):
        for r in rows("merges").orderBy("model", "rank").toLocalIterator():
            merges[r.model].append((r.left_id, r.right_id, r.new_id))
    return {
        name: SubwordModel(
            r.kind, [t for t, _ in vocab[name]], [(a, b) for a, b, _ in merges[name]], [n for *_, n in merges[name]],
            [s for _, s in vocab[name]] if r.kind == "unigram" else [], r.base_size)
        for name, r in wanted.items()
    }


#: To be raised when training gives other models from the same data.
TRAINING = 2


def root_for(spark: SparkSession, *key) -> str:
    digest = hashlib.sha256(repr((TRAINING, *key)).encode()).hexdigest()[:24]
    return f"{work_root(spark)}/wordloom/models-{digest}"


def trained(spark: SparkSession, root: str, train: Callable[[], Mapping[str, SubwordModel]]) -> dict[str, SubwordModel]:
    """The models in a registry, trained and saved where it doesn't exist yet."""
    if not exists(spark, f"{root}/meta/_SUCCESS"):
        save_all(spark, train(), root)
    return load_all(spark, root)


def forget(spark: SparkSession, root: str) -> None:
    discard(spark, root)
