"""Chat formatting from an event log.

A log has one row per event: ``conv_id``, ``message`` (its order is that of the messages), ``seq`` (the order of
the events of a message), ``kind``, ``role`` and ``text``.  Kinds:

* ``open`` starts a message and names its role,
* ``delta`` appends streamed text,
* ``edit`` replaces the whole text,
* ``regenerate`` drops the text written so far; the deltas of the new answer follow.

An event of any other kind, or without one, changes nothing.  A message without ``open`` has an empty role.

The log is dealt out by conversation *and* message, so a conversation with a third of all events is folded by many
tasks; a fold keeps one message in memory.  Messages are then written in a template whose control strings cannot
occur inside a role or a text.  Only digests of a conversation need its messages in one place, and they stream.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The control strings of the template.
TURN_START = "<|im_start|>"
TURN_END = "<|im_end|>"

PIECE_CHARS = 256  # of a streamed delta in the derived log


def escape(text: Column) -> Column:
    r"""Text without ``<|``: a backslash becomes two, ``<|`` becomes ``<\|``."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def escape_role(role: Column) -> Column:
    r"""As :func:`escape`, and a line feed becomes ``\n``, so that a role ends at the first line feed."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape(text: str) -> str:
    """The text that :func:`escape` or :func:`escape_role` was given."""
    if "\\" not in text:
        return text
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.DOTALL)


def log_of(turns: DataFrame) -> DataFrame:
    """A log that leads to the given final turns (``conv_id, turn, role, text``).

    Assistant turns are streamed: a first draft (half of the text), a regeneration, then pieces of ``PIECE_CHARS``.
    Other turns are opened and then edited.  NULL roles and texts count as empty.  Turns with equal numbers are ordered by
    a digest of role and text; each of several equal rows is a message of its own.
    """
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    rows = (
        turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
        .groupBy("conv_id", "turn", "role", "text")
        .agg(F.count("*").alias("copies"))
    )

    def event(kind: str, text: Column | None = None) -> Column:
        return F.struct(F.lit(kind).alias("kind"), (F.lit("") if text is None else text).alias("text"))

    length = F.length("text")
    pieces = F.transform(
        F.sequence(F.lit(0), F.ceil(length / PIECE_CHARS).cast("int")),
        lambda i: event("delta", F.substring(F.col("text"), i * PIECE_CHARS + 1, F.lit(PIECE_CHARS))),
    )
    draft = event("delta", F.substring(F.col("text"), F.lit(1), (length / 2).cast("int")))
    streamed = F.concat(F.array(event("open"), draft, event("regenerate")), pieces)
    edited = F.array(event("open"), event("edit", F.col("text")))
    message = F.struct("turn", F.sha2(F.concat_ws("\n", "role", "text"), 256).alias("tie"), F.col("copy"))
    return (
        rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select(
            "conv_id",
            message.alias("message"),
            "role",
            F.posexplode(F.when(F.col("role") == "assistant", streamed).otherwise(edited)).alias("seq", "event"),
        )
        .select("conv_id", "message", "seq", "event.kind", "role", "event.text")
    )


def fold(log: DataFrame) -> DataFrame:
    """Final messages (``conv_id, message, role, text``) of an event log.

    NULL text appends nothing (``delta``) or empties the message (``edit``); events with equal ``seq`` are taken in the
    order of kind, then text.  An empty log gives no rows.
    """
    columns = ["conv_id", "message", "seq", "kind", "role", "text"]
    ordered = (
        log.select(*columns)
        .repartition("conv_id", "message")
        .sortWithinPartitions("conv_id", "message", "seq", "kind", "text")
    )
    types = dict(zip(ordered.columns, [f.dataType.simpleString() for f in ordered.schema.fields], strict=True))
    schema = f"conv_id {types['conv_id']}, message {types['message']}, role string, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, kind_of = None, None
        role, parts = "", []
        for batch in batches:
            done = []
            names = batch.schema.names
            kind_of = kind_of or pa.schema(
                [
                    ("conv_id", batch.schema.field(names.index("conv_id")).type),
                    ("message", batch.schema.field(names.index("message")).type),
                    ("role", pa.string()),
                    ("text", pa.string()),
                ]
            )
            rows = zip(*(batch.column(names.index(c)).to_pylist() for c in columns), strict=True)
            for conv, message, _, kind, who, text in rows:
                if (conv, message) != key:
                    if key is not None:
                        done.append((*key, role, "".join(parts)))
                    key, role, parts = (conv, message), "", []
                if kind == "open":
                    role = who or ""
                elif kind == "delta":
                    parts.append(text or "")
                elif kind == "edit":
                    parts = [text or ""]
                elif kind == "regenerate":
                    parts = []
            if done:
                yield _batch(done, kind_of)
        if key is not None:
            yield _batch([(*key, role, "".join(parts))], kind_of)

    return ordered.mapInArrow(run, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(values, kind) for values, kind in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema
    )


def render(messages: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """Each message in the template, with its span under the loss mask.

    ``formatted`` is the message's part of its conversation's text; ``loss_start`` and ``loss_end`` (code points within
    ``formatted``, end exclusive) cover the text of messages of ``trained_role`` and are NULL for all others.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(TURN_START), escape_role(role), F.lit("\n"))
    body = escape(text)
    trained = role == trained_role
    return messages.select(
        "conv_id",
        "message",
        F.concat(head, body, F.lit(TURN_END + "\n")).alias("formatted"),
        F.when(trained, F.length(head)).alias("loss_start"),
        F.when(trained, F.length(head) + F.length(body)).alias("loss_end"),
    )


class Reader:
    """Finds the turns of a conversation in its formatted text, which it is fed in pieces cut anywhere.

    It knows the template's control strings alone, so a text in which one stands unescaped is read as more turns.  Only what
    is not yet a whole turn is kept.
    """

    def __init__(self) -> None:
        self.rest = ""

    def feed(self, piece: str) -> Iterator[tuple[str, str]]:
        """Role and text of every turn that the piece completes."""
        self.rest += piece
        while True:
            start = self.rest.find(TURN_START)
            end = self.rest.find(TURN_END, start + len(TURN_START)) if start >= 0 else -1
            if end < 0:
                return
            role, _, text = self.rest[start + len(TURN_START) : end].partition("\n")
            yield unescape(role), unescape(text)
            self.rest = self.rest[end + len(TURN_END) :]


def placed(rendered: DataFrame) -> DataFrame:
    """Rendered messages with ``at``, where each begins in its conversation's text, and the mask in that text's code points.

    The messages' parts, put together in order, are the conversation's text; it is never one value.
    """
    before = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.sum(F.length("formatted")).over(before), F.lit(0)).cast("long")
    rows = rendered.withColumn("at", at)
    return rows.withColumns({c: (F.col(c) + F.col("at")).cast("long") for c in ("loss_start", "loss_end")})


def digests(rendered: DataFrame) -> DataFrame:
    """Per conversation, what can be read back from its formatted text and the mask over it.

    The text is read as it runs on, so the parts of one conversation stream through one task, which keeps two digests, a few
    counts and the turn being read.  Turns, roles and texts are found by :class:`Reader`; the mask's spans are cut from the
    running text by their places in it.  A NULL ``conv_id`` is a conversation of its own.
    """
    kind = rendered.schema["conv_id"].dataType.simpleString()
    ordered = placed(rendered.repartition("conv_id")).sortWithinPartitions("conv_id", "at", "message")
    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, reader, out = None, None, None, None

        def row():
            turns, n, loss, chars, size = state
            return (key, n, turns.hexdigest(), chars, loss.hexdigest(), size)

        for batch in batches:
            done = []
            names = batch.schema.names
            out = out or pa.schema(
                [
                    ("conv_id", batch.schema.field(names.index("conv_id")).type),
                    ("n_turns", pa.int64()),
                    ("turns_sha256", pa.string()),
                    ("loss_chars", pa.int64()),
                    ("loss_sha256", pa.string()),
                    ("formatted_chars", pa.int64()),
                ]
            )
            columns = (batch.column(names.index(c)).to_pylist() for c in ("conv_id", "formatted", "loss_start", "loss_end"))
            for conv, formatted, start, end in zip(*columns, strict=True):
                if state is None or conv != key:
                    if state is not None:
                        done.append(row())
                    key, state, reader = conv, [hashlib.sha256(), 0, hashlib.sha256(), 0, 0], Reader()
                for role, text in reader.feed(formatted):
                    state[0].update(f"{role}\n{text}\n".encode())
                    state[1] += 1
                if start is not None:
                    learned = unescape(formatted[start - state[4] : end - state[4]])
                    state[2].update(learned.encode())
                    state[3] += len(learned)
                state[4] += len(formatted)
            if done:
                yield _batch(done, out)
        if state is not None:
            yield _batch([row()], out)

    return ordered.mapInArrow(run, schema)
