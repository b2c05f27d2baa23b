"""Chat formatting: conversations rebuilt from event logs, rendered with a template and a loss mask.

A log row is an event of one message: ``message`` (its whole text), ``delta`` (more text), ``edit`` (a new whole
text) or ``regenerate`` (start over; deltas follow). Events are dealt by conversation and message, so that a hot
conversation is folded by many tasks, sorted by sequence number and folded one after the other.

Rendered, a turn is ``<s>role[INST] text [/INST]</s>`` and a line feed. The template's control strings inside a role or a
text are escaped by one backslash after their first character, one more for each already there, which a reader takes out again.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]")
_REST = "|".join(re.escape(c[1:]) for c in CONTROLS if c[0] == "<"), "|".join(re.escape(c[1:]) for c in CONTROLS if c[0] == "[")
# A control string with any number of backslashes after its first character.
GUARDED = rf"(?:<(?=\\*(?:{_REST[0]}))|\[(?=\\*(?:{_REST[1]})))"
_ESCAPED = rf"(?:<\\(?=\\*(?:{_REST[0]}))|\[\\(?=\\*(?:{_REST[1]})))"
OPEN, BODY, CLOSE = "<s>", "[INST] ", " [/INST]</s>\n"
_TURN = re.compile(r"<s>(.*?)\[INST\] (.*?) \[/INST\]</s>\n", re.DOTALL)
_UNESCAPE = re.compile(_ESCAPED)
KINDS = ("message", "delta", "edit", "regenerate")


def escape(text: Column) -> Column:
    """``text`` with its control strings broken by a backslash; reversible for every text."""
    return F.regexp_replace(text, f"({GUARDED})", r"$1\\")


def unescape(text: str) -> str:
    """The text that :func:`escape` was given."""
    return _UNESCAPE.sub(lambda m: m[0][0], text)


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages of an event log: ``conv_id``, ``position``, ``message_id``, ``role``, ``text``.

    ``events``: ``conv_id``, ``message_id``, ``seq``, ``kind``, ``role``, ``text``. A message's position is the smallest
    sequence number of its events, its role the first that is not null (else empty). Null texts are empty,
    unknown kinds count as ``delta``; events with equal sequence numbers follow by kind, then text. A message whose
    last event is ``regenerate`` is empty. Null conversation or message ids are ids like others. Other columns are
    not read. A task streams over its sorted events and holds one message.
    """
    out = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("message_id", pa.string()), ("role", pa.string()), ("text", pa.string())])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, position, role, parts = None, None, None, []
        done: list[tuple] = []

        def close() -> None:
            if key is not None:
                done.append((key[0], position, key[1], role or "", "".join(parts)))

        for batch in batches:
            for conv, message, seq, kind, who, text in zip(*(c.to_pylist() for c in batch.columns)):
                if key != (conv, message):
                    close()
                    key, position, role, parts = (conv, message), seq, None, []
                role = who if role is None else role
                if kind in ("message", "edit", "regenerate"):
                    parts = []
                if kind != "regenerate" and text:
                    parts.append(text)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), out)], schema=out)
                done = []
        close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), out)], schema=out)

    keyed = events.select(
        F.col("conv_id").cast("bigint"), F.col("message_id").cast("string"), F.col("seq").cast("bigint"), "kind", "role", "text"
    )
    keys = ["conv_id", "message_id"]
    together = keyed.repartition(*keys).sortWithinPartitions(*keys, "seq", "kind", "text")
    return together.mapInArrow(fold, "conv_id bigint, position bigint, message_id string, role string, text string")


def render(messages: DataFrame, learn_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """A segment for each message, whose order within a conversation is (``position``, ``role``, ``text``).

    ``segment`` is its part of the formatted conversation, which is nothing but its segments in order; ``loss_start``
    and ``loss_end`` are the span (code points of the segment) that training learns from, empty for other roles.
    """
    role, text = escape(F.coalesce("role", F.lit(""))), escape(F.coalesce("text", F.lit("")))
    start = F.length(F.concat(F.lit(OPEN), role, F.lit(BODY)))
    learned = F.coalesce(F.col("role").isin(*learn_roles), F.lit(False))
    return messages.select(
        "conv_id",
        "position",
        F.concat(F.lit(OPEN), role, F.lit(BODY), text, F.lit(CLOSE)).alias("segment"),
        start.alias("loss_start"),
        F.when(learned, start + F.length(text)).otherwise(start).alias("loss_end"),
        F.coalesce("role", F.lit("")).alias("_role"),
        F.coalesce("text", F.lit("")).alias("_text"),
    ).select("conv_id", "position", "segment", "loss_start", "loss_end", F.xxhash64("_role", "_text").alias("tie"), F.struct("_role", "_text").alias("turn"))


def read_back(segments: DataFrame) -> DataFrame:
    """What a reader finds in formatted conversations, from ``segment`` and the loss span alone.

    One row a conversation: ``n_turns``, ``turns_sha256`` (role, line feed, text, line feed of each turn), ``loss_chars`` and
    ``loss_sha256`` (unescaped text under the loss mask), ``formatted_chars``. Conversations are dealt by id and
    sorted by position; a digest is sequential, so one task streams over a conversation, and holds a batch of it.
    """
    out = pa.schema([
        ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
    ])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        done: list[tuple] = []

        def close() -> None:
            if state:
                n, turns, chars, loss, formatted = state
                done.append((key, n, turns.hexdigest(), chars, loss.hexdigest(), formatted))

        for batch in batches:
            for conv, segment, start, end in zip(*(c.to_pylist() for c in batch.columns)):
                if state is None or key != conv:
                    close()
                    key, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in _TURN.findall(segment):
                    state[0] += 1
                    state[1].update(f"{unescape(role)}\n{unescape(text)}\n".encode())
                learned = unescape(segment[start:end])
                state[2] += len(learned)
                state[3].update(learned.encode())
                state[4] += len(segment)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), out)], schema=out)
                done = []
        close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), out)], schema=out)

    ordered = segments.repartition("conv_id").sortWithinPartitions("conv_id", "position", "turn")
    kept = ordered.select("conv_id", "segment", "loss_start", "loss_end")
    return kept.mapInArrow(read, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


def events_of(turns: DataFrame) -> DataFrame:
    """The log of finished turns (``conv_id``, ``turn``, ``role``, ``text``): assistant turns stream as two deltas after a
    regeneration of their first half, the others are whole messages. Every row is a message of its own."""
    rows = turns.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"), "role", F.coalesce("text", F.lit("")).alias("text"),
        F.monotonically_increasing_id().cast("string").alias("message_id"),
    )
    half = F.floor(F.length("text") / 2).cast("int")
    first, second = F.expr("left(text, cast(length(text) / 2 as int))"), F.col("text").substr(half + 1, F.length("text"))

    def event(step: int, kind: str, text: Column) -> Column:
        # Four events fit a turn; a null turn comes first.
        seq = F.coalesce(F.col("turn"), F.lit(-1)) * 4 + step
        return F.struct(seq.alias("seq"), F.lit(kind).alias("kind"), text.alias("text"))

    streamed = F.array(event(0, "delta", first), event(1, "regenerate", F.lit(None).cast("string")), event(2, "delta", first), event(3, "delta", second))
    whole = F.array(event(0, "message", F.col("text")))
    log = F.when(F.col("role") == "assistant", streamed).otherwise(whole)
    return rows.select("conv_id", "message_id", "role", F.explode(log).alias("e")).select("conv_id", "message_id", "role", "e.seq", "e.kind", "e.text")


def format_conversations(events: DataFrame, learn_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Segments of all conversations of an event log; see :func:`fold_events` and :func:`render`."""
    return render(fold_events(events), learn_roles)
