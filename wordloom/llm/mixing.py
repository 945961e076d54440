"""Mixing sources to target weights by iterative proportional fitting.

Tokens are counted in cells of (source, language, topic); that is the only pass over the texts.
The cells' weights are then raked: scaled so that each dimension in turn meets its target shares,
for a number of sweeps. The ratio of raked to counted tokens, over the largest ratio, is the
probability with which a cell's documents are kept, so the expected mixture has the raked shares
and no document is repeated. A document is kept by a hash of its id, alike on every run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wordloom.llm.common import SPACE, free_name, whole
from wordloom.session import materialize

DIMENSIONS = ("source", "lang", "topic")
NONE = "(none)"


def token_count(text: Column) -> Column:
    trimmed = F.regexp_replace(text, f"^[{SPACE}]++", "")
    return F.when(trimmed == "", F.lit(0)).otherwise(
        F.size(F.split(F.regexp_replace(trimmed, f"(?<![{SPACE}])[{SPACE}]++$", ""), f"[{SPACE}]+"))).cast("bigint")


def length_class(n_tokens: Column) -> Column:
    """A stand-in for a topic where the table has none: how long the document is."""
    return F.when(n_tokens < 200, "short").when(n_tokens < 2000, "medium").otherwise("long")


def count_cells(labelled: DataFrame, dimensions: Sequence[str] = DIMENSIONS) -> DataFrame:
    return labelled.groupBy(*dimensions).agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("documents"))


def tempered(cells: DataFrame, dimension: str, power: float) -> DataFrame:
    """Target shares: the counted ones raised to ``power`` and normalised."""
    share = cells.groupBy(dimension).agg(F.pow(F.sum("tokens").cast("double"), F.lit(power)).alias("part"))
    return share.join(F.broadcast(share.agg(F.sum("part").alias("all")))).select(
        dimension, F.coalesce(F.col("part") / F.nullif("all", F.lit(0.0)), F.lit(0.0)).alias("target"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], sweeps: int = 6) -> DataFrame:
    """cells with ``weight``: token weights whose shares meet the targets (dimension, target).

    A value without a target gets weight 0, as does a cell without tokens. Each step is
    stored, so the plans stay short; sums are combined in the map tasks and joined by value.
    """
    cells = materialize(cells.withColumn("weight", F.col("tokens").cast("double")), "cells")
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    fixed = {d: materialize(t, "targets") for d, t in targets.items()}
    for _ in range(sweeps):
        for d, target in fixed.items():
            sums = cells.groupBy(d).agg(F.sum("weight").alias("_sum"))
            factor = sums.join(target, d).select(d, F.coalesce(
                F.col("target") * total / F.nullif("_sum", F.lit(0.0)), F.lit(0.0)).alias("_f"))
            cells = materialize(cells.join(factor, d, "left").withColumn(
                "weight", F.col("weight") * F.coalesce("_f", F.lit(0.0))).drop("_f"), "cells")
    return cells


def probabilities(raked: DataFrame) -> DataFrame:
    """cells with ``ratio`` (raked over counted tokens) and ``probability``, six decimals. A cell
    without tokens costs nothing: its documents stay."""
    ratio = F.col("weight") / F.nullif(F.col("tokens").cast("double"), F.lit(0.0))
    rows = raked.withColumn("ratio", ratio)
    most = rows.agg(F.max("ratio").alias("_most"))
    return rows.join(F.broadcast(most)).select(
        *raked.columns, F.round("ratio", 6).alias("ratio"),
        F.coalesce(F.round(F.col("ratio") / F.nullif("_most", F.lit(0.0)), 6), F.lit(1.0)).alias("probability"))


def draw(id_column: Column, seed: str) -> Column:
    """A number in [0, 1) from a hash of the id."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(id_column.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / float(1 << 32)


def label(docs: DataFrame, text_column: str, topic: Column | None) -> tuple[DataFrame, dict[str, str]]:
    """docs with their token count and cell in columns of free names; null values are ``(none)``."""
    n = free_name(docs, "n_tokens")
    names = {d: free_name(docs, f"cell_{d}") for d in DIMENSIONS}
    out = docs.withColumn(n, token_count(whole(text_column)))
    for d in ("source", "lang"):
        out = out.withColumn(names[d], F.coalesce(F.col(d).cast("string"), F.lit(NONE)))
    out = out.withColumn(names["topic"], F.coalesce(
        topic if topic is not None else length_class(F.col(n)), F.lit(NONE)))
    return out, names | {"n_tokens": n}


def sample_to_targets(
    docs: DataFrame, targets: dict[str, DataFrame] | None = None, power: float = 0.7, sweeps: int = 6,
    seed: str = "mix", id_column: str = "doc_id", text_column: str = "text", topic: Column | None = None,
) -> tuple[DataFrame, dict[str, str]]:
    """docs with cell, token count, ratio, probability and kept, in columns of free names, and
    those names. ``targets`` has (dimension, target) shares; those not given are tempered.

    Null texts have no tokens; repeated rows share their fate; an empty table gives no rows.
    The cells are joined by value; where a source is hot, adaptive execution splits it.
    """
    labelled, names = label(docs, text_column, topic)
    plain = labelled.select(F.col(names["n_tokens"]).alias("n_tokens"), *[F.col(names[d]).alias(d) for d in DIMENSIONS])
    cells = materialize(count_cells(plain), "cells")
    goal = {d: (targets or {}).get(d) for d in DIMENSIONS}
    goal = {d: t if t is not None else tempered(cells, d, power) for d, t in goal.items()}
    chances = materialize(probabilities(rake(cells, goal, sweeps)), "chances")
    names |= {x: free_name(labelled, x) for x in ("ratio", "probability", "kept")}
    chances = chances.select(*[F.col(d).alias(names[d]) for d in DIMENSIONS],
                             *[F.col(x).alias(names[x]) for x in ("ratio", "probability")])
    out = labelled.join(chances, [names[d] for d in DIMENSIONS])
    return out.withColumn(names["kept"], draw(F.col(id_column), seed) < F.col(names["probability"])), names
