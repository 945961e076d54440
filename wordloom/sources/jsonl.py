"""JSON Lines sources.

One reader with three text policies (``lenient``, ``strict``, ``coerce``), a
record reader that keeps every field, and an accepted/rejected split. Lines are
parsed as VARIANT, so no schema is declared and unknown fields survive.

Numbers such as ``NaN`` that are not JSON make the line malformed.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from wordloom.functions import text as tx
from wordloom.functions.text import bind
from wordloom.operators.ordering import prefix_end
from wordloom.session import materialize

# fixed values: further line breaks of Python's str.splitlines
_OTHER_BREAKS = "[\\x0b\\x0c\\x1c-\\x1e\\x85\\u2028\\u2029]"


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(line, file, split, seq)`` in which ``(file, split, seq)`` is the physical order.

    A file split is read in sequence by one task, so the task-local running id is
    ordered inside it, whatever the order in which Spark packs splits into tasks.
    """
    return spark.read.text(path).select(
        F.make_valid_utf8("value").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("seq"),
    )


def prefix_files(spark: SparkSession, path: str, n: int) -> list[str]:
    """The first files, by name, that hold ``n`` lines together; all of them if there are fewer lines.

    Files are counted one after the other, then twice as many at a time, until the lines are found, so
    the others are listed but not opened.
    """
    files = [unquote(f) for f in sorted(spark.read.text(path).inputFiles())]
    taken, found, step = 0, 0, 1
    while taken < len(files) and found < n:
        found += spark.read.text(files[taken:taken + step]).count()
        taken += step
        step *= 2
    return files[:taken]


def number_lines(lines: DataFrame) -> DataFrame:
    """Add ``pos``, the dense 0-based line number over all files.

    The lines are read once and stored with their running ids: where a file is cut depends on
    the settings at the time of a scan, so two scans need not agree. Then two phases:
    lines per split (one small row per file split), and each line's offset inside its
    split. No sort of the lines, no single-task window over them or over the files.
    """
    lines = materialize(lines, "lines")
    splits = lines.groupBy("file", "split").agg(
        F.count("*").alias("n"), F.min("seq").alias("first_seq")
    )
    # Files, then splits inside a file: neither window sees a row per line.
    files = splits.groupBy("file").agg(F.sum("n").alias("file_n"))
    before_split = Window.partitionBy("file").orderBy("split").rowsBetween(
        Window.unboundedPreceding, -1
    )
    zero = F.lit(0).cast("bigint")
    files = _sums_before(files)
    starts = (
        splits.join(files, "file")
        .select(
            "file", "split", "first_seq",
            (F.col("f0") + F.coalesce(F.sum("n").over(before_split), zero)).alias("start"),
        )
    )
    # One row per file split, stored, so the optimizer knows its size and broadcasts it
    # where it is small; then the lines themselves never move.
    starts = materialize(starts, "line-starts")
    start = F.coalesce("start", F.raise_error(F.lit("a line of an unknown split")).cast("bigint"))
    return lines.join(starts, ["file", "split"], "left").select(
        (start + F.col("seq") - F.col("first_seq")).alias("pos"), "line"
    )


def _sums_before(files: DataFrame) -> DataFrame:
    """``(file, f0)``: the lines of all files before each one, in the order of their names.

    Files are dealt out by ranges of names; only one row per range meets in one task.
    """
    ranged = files.repartitionByRange("file").withColumn("part", F.spark_partition_id())
    ranged = materialize(ranged, "files")
    before = lambda w: F.coalesce(
        F.sum("file_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("bigint"))
    parts = ranged.groupBy("part").agg(F.sum("file_n").alias("file_n"))
    parts = parts.select("part", before(Window.orderBy("part")).alias("p0"))
    inside = ranged.withColumn("i0", before(Window.partitionBy("part").orderBy("file")))
    return inside.join(parts, "part").select("file", (F.col("p0") + F.col("i0")).alias("f0"))


def parse(lines: DataFrame, line: str = "line") -> DataFrame:
    """Add ``record`` (VARIANT object) and ``problem`` (null when the line is a record).

    The line is parsed inside brackets, which makes text after the object an error.
    """
    boxed = F.try_parse_json(F.concat(F.lit("["), F.col(line), F.lit("]")))
    only = F.when(
        F.expr("try_variant_get(_boxed, '$[1]', 'variant') is null"),
        F.expr("try_variant_get(_boxed, '$[0]', 'variant')"),
    )
    # Bound, so that a line is parsed once however many fields are read from it.
    out = bind(bind(lines, "_boxed", boxed), "record", only)
    is_object = F.rlike(F.col(line), F.lit(f"^[{tx.WS}]*\\{{"))
    problem = (
        F.when(tx.is_blank(F.col(line)), F.lit("blank line"))
        .when(F.col("record").isNull(), F.lit("malformed json"))
        .when(~is_object, F.lit("not an object"))
    )
    return out.withColumn("problem", problem).drop("_boxed")


def _path(field: str) -> str:
    return "$['" + field.replace("\\", "\\\\").replace("'", "\\'") + "']"


def _get(field: str, kind: str) -> Column:
    return F.try_variant_get(F.col("record"), _path(field), kind)


def _text_kind(field: str) -> Column:
    """Type name of the field's value: STRING, BIGINT, VOID, ... or null if absent."""
    return F.schema_of_variant(_get(field, "variant"))


def read_texts(
    spark: SparkSession,
    path: str,
    mode: str = "lenient",
    text_field: str = "text",
    max_records: int | None = None,
) -> DataFrame:
    """``(pos, text)`` of the usable lines, ``pos`` being the physical line number.

    lenient: string texts as they are, empty ones dropped; ``max_records`` counts
    physical lines. strict: trimmed, blank dropped, other types dropped. coerce:
    other types become text; also breaks lines at the rarer Unicode line ends;
    ``max_records`` counts accepted texts. 0 or None means no limit.
    """
    if mode not in ("lenient", "strict", "coerce"):
        raise ValueError(f"unknown mode {mode!r}")
    prefix = mode == "lenient" and max_records
    lines = number_lines(read_lines(spark, prefix_files(spark, path, max_records) if prefix else path))
    if prefix:
        lines = lines.filter(F.col("pos") < max_records)
    if mode == "coerce":
        # A line cut by a rare break stays one position; pieces keep their order there.
        lines = lines.select(
            "pos", F.posexplode(F.split("line", _OTHER_BREAKS)).alias("part", "line")
        )
    good = parse(lines).filter(F.col("problem").isNull())
    kind, value = _text_kind(text_field), _get(text_field, "string")
    if mode == "lenient":
        out = good.filter((kind == "STRING") & (value != "")).select("pos", value.alias("text"))
    elif mode == "strict":
        out = good.filter(kind == "STRING").select("pos", tx.trim_ws(value).alias("text"))
        out = out.filter(F.col("text") != "")
    else:
        as_text = F.when(kind == "BOOLEAN", F.initcap(value)).otherwise(value)
        out = good.select("pos", "part", tx.trim_ws(as_text).alias("text")).filter(F.col("text") != "")
        if max_records:
            out = _first_parts(out, max_records)
        out = out.drop("part")
    return out


def _first_parts(texts: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows by (pos, part); only the line in which the limit falls is ranked."""
    end = prefix_end(texts, "pos", F.lit(1), n)
    if end is None:
        return texts
    left = n - texts.filter(F.col("pos") < end).count()
    last = texts.filter(F.col("pos") == end)
    rank = F.row_number().over(Window.partitionBy("pos").orderBy("part"))
    last = last.withColumn("_rank", rank).filter(F.col("_rank") <= left).drop("_rank")
    return texts.filter(F.col("pos") < end).unionByName(last)


def transform_records(
    lines: DataFrame, change: callable, text_field: str = "text", line: str = "line"
) -> DataFrame:
    """Rewrite one text field and keep the rest of each record.

    Adds ``record_json`` (the record to write, null when dropped) and ``reason``
    (why a line was dropped). A record without text passes through unchanged; a
    truthy text that is not a string cannot be processed and is dropped.
    """
    parsed = parse(lines, line)
    kind, value = _text_kind(text_field), _get(text_field, "string")
    is_text = (kind == "STRING") & (value != "")
    falsy = kind.isNull() | kind.isin("VOID") | (value == "") | (
        F.rlike(kind, F.lit("^(BIGINT|FLOAT|DOUBLE|DECIMAL)")) & (value.try_cast("double") == 0)
    ) | ((kind == "BOOLEAN") & (value == "false")
    ) | (F.rlike(kind, F.lit("^(ARRAY|OBJECT)")) & value.isin("[]", "{}"))
    reason = F.coalesce(
        F.col("problem"),
        F.when(~F.coalesce(is_text, F.lit(False)) & ~F.coalesce(falsy, F.lit(True)),
               F.concat(F.lit("text is "), kind)),
    )
    out = parsed.withColumn("_kind", kind).withColumn("reason", reason)
    out = out.withColumn("_new", F.when(F.coalesce(is_text, F.lit(False)), change(value)))
    name = text_field.replace("'", "\\'")
    rewritten = F.expr(
        f"to_json(transform_values(cast(record as map<string,variant>), (k, v) -> "
        f"case when k = '{name}' and _new is not null then cast(_new as variant) else v end))"
    )
    return out.withColumn("record_json", F.when(F.col("reason").isNull(), rewritten)).drop(
        "record", "problem", "_kind", "_new"
    )


def quarantine(transformed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split the output of :func:`transform_records` into accepted and rejected rows."""
    accepted = transformed.filter(F.col("reason").isNull()).drop("reason")
    rejected = transformed.filter(F.col("reason").isNotNull()).drop("record_json")
    return accepted, rejected
