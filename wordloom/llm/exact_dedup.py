"""Exact de-duplication by content hash, built-in functions only.

Documents are grouped by a 128-bit hash *and* the text itself: the hash deals rows out,
the bytes decide, so a collision only makes two groups of one hash. Copies inside a task
are combined before the shuffle, so a text that makes up a third of the input is one
row for each task. Documents find their group by two digests; where two different texts
share both digests (forced in the tests), those rows, and only they, meet by the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from wordloom.llm.common import free_name, whole
from wordloom.session import store

Digest = Callable[[Column], Column]


def _sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _first_id(column: str, keep: str) -> Column:
    if keep not in ("min", "max"):
        raise ValueError(f"keep is 'min' or 'max', not {keep!r}")
    return (F.min if keep == "min" else F.max)(column)


def exact_groups(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: str = "min",
    digest: Digest = F.md5, check: Digest = _sha256,
) -> DataFrame:
    """One row for each document: its id, keep_id, group_size, kept, text_sha256.

    ``keep`` says whether the smallest or the largest id of equal texts stays. Null texts
    count as empty. Null ids stay only in a group that has no other id. Of repeated rows
    with one id and text exactly one is kept. An empty table gives no rows; other columns
    are not read.
    """
    rows = docs.select(F.col(id_column).alias("id"), whole(text_column).alias("text"))
    rows = rows.select("id", "text", digest(F.col("text")).alias("h"), check(F.col("text")).alias("s"))
    by_text = rows.groupBy("h", "s", "text").agg(
        _first_id("id", keep).alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups, _ = store(by_text.drop("text"), "groups")

    members = rows.select("id", "h", "s", F.sha2("text", 256).alias("text_sha256"))
    once = Window.partitionBy("h", "s", "text_sha256", "id").orderBy("id")
    members = members.withColumn("copy", F.row_number().over(once))
    clashes = groups.groupBy("h", "s").count().filter("count > 1").select("h", "s")
    if clashes.isEmpty():
        found = members.join(groups, ["h", "s"])
    else:
        apart = members.join(clashes, ["h", "s"], "left_anti").join(groups, ["h", "s"])
        shared = rows.join(clashes, ["h", "s"], "left_semi")
        texts = by_text.join(clashes, ["h", "s"], "left_semi")
        once = Window.partitionBy("text", "id").orderBy("id")
        shared = shared.select(
            "h", "s", "id", F.sha2("text", 256).alias("text_sha256"), "text",
            F.row_number().over(once).alias("copy"))
        found = apart.unionByName(shared.join(texts, ["h", "s", "text"]).drop("text"))
    return found.select(
        F.col("id").alias(id_column), "keep_id", "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), "text_sha256")


def drop_copies(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: str = "min",
    digest: Digest = F.md5,
) -> DataFrame:
    """The document that stays of each group of equal texts, with all its columns.

    One shuffle: rows with one hash and one text are combined in the map tasks already.
    Between rows with the same id the JSON form of the other columns decides.
    """
    if keep not in ("min", "max"):
        raise ValueError(f"keep is 'min' or 'max', not {keep!r}")
    others = [c for c in docs.columns if c != text_column]
    h, text, row, null = (free_name(docs, x) for x in ("h", "text", "row", "null"))
    packed = docs.select(
        digest(whole(text_column)).alias(h), whole(text_column).alias(text),
        F.struct(F.col(text_column).isNull().alias(null), *others).alias(row),
        F.struct(
            (F.col(id_column).isNull() if keep == "min" else F.col(id_column).isNotNull()).alias("a"),
            F.col(id_column).alias("b"), F.to_json(F.struct(*others)).alias("c"),
            (~F.col(text_column).isNull() if keep == "max" else F.col(text_column).isNull()).alias("d"),
        ).alias("order"))
    pick = F.min_by if keep == "min" else F.max_by
    best = packed.groupBy(h, text).agg(pick(row, "order").alias(row))
    return best.select(*[
        F.when(~F.col(f"{row}.{null}"), F.col(text)).alias(c) if c == text_column
        else F.col(row)[c].alias(c) for c in docs.columns])
