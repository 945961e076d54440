"""Chat formatting from event logs.

A log holds, for each conversation, events in sequence: streamed deltas, edits and
regenerations of messages. It is dealt out by conversation, sorted by sequence inside the
partitions and folded as it streams by, so a task holds one conversation at a time, and of that
only its final messages. Each message is rendered with a template; every control string inside
a text or role is escaped in a way that can be undone.

Events: ``conv_id, seq, kind, message, role, text``; kinds:

* ``delta`` appends the text to its message, which it starts if need be;
* ``edit`` replaces the text of its message (starts it if need be);
* ``regenerate`` empties its message and takes back those that began after it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from wordloom.llm.common import partitions, whole

START, END = "<|im_start|>", "<|im_end|>"
KINDS = ("delta", "edit", "regenerate")
MESSAGES = "conv_id {id}, turn int, role string, formatted string, loss_start int, loss_end int"
_BATCH_CHARS = 1 << 22


def escape(text: str) -> str:
    """No ``<|`` is left: a backslash more stands between the two characters."""
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def render(role: str, text: str) -> str:
    return f"{START}{escape_role(role)}\n{escape(text)}{END}\n"


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(START, at):
            raise ValueError(f"no turn starts at {at}")
        line = formatted.index("\n", at)
        end = formatted.index(END + "\n", line)
        turns.append((unescape_role(formatted[at + len(START):line]), unescape(formatted[line + 1:end])))
        at = end + len(END) + 1
    return turns


def _messages(trained: frozenset[str], ids: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: object = run  # no conversation yet
        state: dict = {}
        out: list[tuple] = []
        size = 0

        def close() -> None:
            nonlocal size
            for turn, (role, parts) in enumerate(state.values()):
                piece = render(role, "".join(parts))
                low = len(piece) - len(END) - 1
                low = (piece.index("\n") + 1, low) if role in trained else (0, 0)
                out.append((now, turn, role, piece, *low))
                size += len(piece)

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*rows)) if rows else [[]] * 6
            kinds = (ids, pa.int32(), pa.string(), pa.string(), pa.int32(), pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds)],
                ["conv_id", "turn", "role", "formatted", "loss_start", "loss_end"])

        for batch in batches:
            for conv, kind, message, role, text in zip(
                    *[batch.column(c).to_pylist() for c in ("conv_id", "kind", "message", "role", "text")]):
                if conv != now:
                    if now is not run:
                        close()
                    now, state = conv, {}
                    if size > _BATCH_CHARS:
                        yield batch_of(out)
                        out, size = [], 0
                if kind == "regenerate":
                    if message in state:
                        names = list(state)
                        for later in names[names.index(message) + 1:]:
                            del state[later]
                        state[message] = (state[message][0], [])
                    continue
                held = state.setdefault(message, (role or "", []))
                if kind == "edit":
                    held[1].clear()
                held[1].append(text or "")
        if now is not run:
            close()
        yield batch_of(out)

    return run


def format_events(events: DataFrame, trained_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row for each final message, in the order of conversation and turn: conv_id, turn
    (from 0), role, ``formatted`` and the code points of it under the loss mask.

    Null roles and texts count as empty; rows of null conv_id are one conversation; null
    sequence numbers come first; ties follow kind, message, role and text. Other kinds of events fail.
    Extra columns are not read.
    """
    kinds = [F.col(c) for c in ("conv_id", "seq", "kind", "message", "role", "text")]
    known = F.when(F.col("kind").isin(*KINDS), F.col("kind")).otherwise(
        F.raise_error(F.concat(F.lit("unknown kind of event: "), F.coalesce("kind", F.lit("null")))))
    rows = events.select(*kinds).withColumn("kind", known)
    rows = rows.repartition(partitions(rows), "conv_id").sortWithinPartitions(
        "conv_id", "seq", "kind", "message", "role", "text")
    kind = rows.schema["conv_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    return rows.mapInArrow(_messages(frozenset(trained_roles), to_arrow_type(kind)),
                           MESSAGES.format(id=kind.simpleString()))


def conversations(messages: DataFrame) -> DataFrame:
    """conv_id, ``formatted`` and the ``loss`` spans in it, one row for each conversation."""
    whole_row = messages.groupBy("conv_id").agg(F.array_sort(F.collect_list(
        F.struct("turn", "formatted", "loss_start", "loss_end"))).alias("m"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))
    spans = F.aggregate("m", zero, lambda acc, m: F.struct(
        (acc["at"] + F.length(m["formatted"])).alias("at"),
        F.when(m["loss_end"] > m["loss_start"], F.concat(acc["out"], F.array(F.struct(
            (acc["at"] + m["loss_start"]).alias("start"), (acc["at"] + m["loss_end"]).alias("end")))))
        .otherwise(acc["out"]).alias("out")), lambda acc: acc["out"])
    return whole_row.select("conv_id", F.array_join("m.formatted", "").alias("formatted"), spans.alias("loss"))


def log_of_turns(turns: DataFrame) -> DataFrame:
    """The event log that could have led to a table of turns (conv_id, turn, role, text): each text
    comes in two deltas; an assistant's turn begins with a draft that is then regenerated, any
    other turn with a draft that is edited. Rows of one turn are told apart by role and text."""
    number = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    rows = turns.select("conv_id", "turn", "role", whole("text").alias("text")).withColumn("message", number)
    half = F.floor(F.length("text") / 2).cast("int")
    draft, first, second = F.reverse("text"), F.substr("text", F.lit(1), half), F.substr("text", half + 1, F.length("text"))
    assistant = F.coalesce(F.col("role") == "assistant", F.lit(False))
    steps = F.array(
        F.struct(F.lit("delta").alias("kind"), draft.alias("text")),
        F.struct(F.when(assistant, "regenerate").otherwise("edit").alias("kind"),
                 F.when(assistant, F.lit(None)).otherwise(first).alias("text")),
        F.struct(F.lit("delta").alias("kind"), F.when(assistant, first).otherwise(second).alias("text")),
        F.struct(F.lit("delta").alias("kind"), F.when(assistant, second).otherwise("").alias("text")))
    return rows.select("conv_id", "message", "role", F.posexplode(steps).alias("step", "event")).select(
        "conv_id", (F.col("message").cast("bigint") * 4 + F.col("step")).alias("seq"),
        "event.kind", "message", "role", "event.text")


def _digests(ids: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: object = run
        turns = loss = chars = n = 0
        said = trained = None
        out: list[tuple] = []
        for batch in batches:
            for conv, piece, low, high in zip(*[batch.column(c).to_pylist() for c in (
                    "conv_id", "formatted", "loss_start", "loss_end")]):
                if conv != now or now is run:
                    if now is not run:
                        out.append((now, n, said.hexdigest(), loss, trained.hexdigest(), chars))
                    now, n, loss, chars, said, trained = conv, 0, 0, 0, hashlib.sha256(), hashlib.sha256()
                for role, text in read_back(piece):
                    said.update(f"{role}\n{text}\n".encode())
                    n += 1
                masked = unescape(piece[low:high])
                trained.update(masked.encode())
                loss, chars = loss + len(masked), chars + len(piece)
            if len(out) > 10_000:
                yield _digest_batch(out, ids)
                out = []
        if now is not run:
            out.append((now, n, said.hexdigest(), loss, trained.hexdigest(), chars))
        yield _digest_batch(out, ids)

    return run


def _digest_batch(rows: list[tuple], ids: pa.DataType) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * 6
    kinds = (ids, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], [
        "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def digests(messages: DataFrame) -> DataFrame:
    """What can be read back from :func:`format_events`: one row for each conversation.

    The rows are taken in the order in which that function gives them, so ``messages`` must be
    its result itself: nothing is shuffled again and no conversation is held as a whole.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kind = messages.schema["conv_id"].dataType
    return messages.mapInArrow(_digests(to_arrow_type(kind)), (
        f"conv_id {kind.simpleString()}, n_turns bigint, turns_sha256 string, "
        "loss_chars bigint, loss_sha256 string, formatted_chars bigint"))
