"""Training text of conversations, rebuilt from a log of events."""
from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows and characters of an output batch.
_BATCH_ROWS, _BATCH_CHARS = 4096, 8 << 20


@dataclass(frozen=True)
class Template:
    """``begin role middle text end`` for each turn; the texts of the roles in ``learn`` are under the loss mask.

    Control strings inside a text or role are written as a backslash and their number in braces, a backslash as two of
    them; so no control string of the output stems from a text, and reading gives back the same texts.
    """

    begin: str = "<|turn|>"
    middle: str = "<|says|>"
    end: str = "<|end|>\n"
    learn: tuple[str, ...] = ("assistant",)
    #: Further strings that tokenizers read as control tokens.
    control: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
    _all: tuple[str, ...] = field(init=False, repr=False)

    def __post_init__(self) -> None:
        marks = (self.begin, self.middle, self.end.rstrip())
        if not all(marks) or any("\\" in m or "{" in m for m in (*marks, *self.control)):
            raise ValueError("control strings are not empty and have no backslash or brace")
        object.__setattr__(self, "_all", tuple(dict.fromkeys((*marks, *self.control))))

    def escape(self, text: str) -> str:
        numbers = {c: f"\\{{{k}}}" for k, c in enumerate(self._all)} | {"\\": "\\\\"}
        longest = sorted(numbers, key=len, reverse=True)
        return re.sub("|".join(map(re.escape, longest)), lambda m: numbers[m.group()], text)

    def unescape(self, text: str) -> str:
        return re.sub(r"\\(?:\\|\{(\d+)\})", lambda m: "\\" if m.group(1) is None else self._all[int(m.group(1))], text)

    def render(self, role: str, text: str) -> tuple[str, int, int]:
        """The turn, and where its text under the loss mask begins and ends (code points; equal if there is none)."""
        head, body = self.begin + self.escape(role) + self.middle, self.escape(text)
        return head + body + self.end, len(head), len(head) + len(body) if role in self.learn else len(head)

    def read(self, formatted: str) -> list[tuple[str, str]]:
        """(role, text) of each turn of an output."""
        turns = re.findall(f"{re.escape(self.begin)}(.*?){re.escape(self.middle)}(.*?){re.escape(self.end)}", formatted, flags=re.S)
        return [(self.unescape(r), self.unescape(t)) for r, t in turns]


def _place(values: Sequence[Any]) -> tuple:
    """A key that orders as Spark does, nulls first."""
    return tuple((v is not None, 0 if v is None else v) for v in values)


def _fold(template: Template, n_message: int, n_sequence: int):
    """Events sorted by (conversation, message, sequence) to one row per message that stays."""
    message = [f"m{i}" for i in range(n_message)]
    sequence = [f"s{i}" for i in range(n_sequence)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        out: list[tuple] = []
        size = 0
        now: Any = None  # (conversation, message) being folded
        opened, role, parts, reset, seen = False, "", [], None, None
        latest: tuple | None = None  # the last edit or regeneration of this conversation's earlier messages

        def close() -> int:
            nonlocal latest
            added = 0
            if now is not None and opened and (latest is None or latest < _place(now[1])):
                text = "".join(parts)
                formatted, a, b = template.render(role, text)
                out.append((now[0], *now[1], role, text, formatted, a, b))
                added = len(formatted)
            if reset is not None and (latest is None or reset > latest):
                latest = reset
            return added

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out)) if out else [()] * len(schema)
            made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
            out.clear()
            return made

        for batch in batches:
            if schema is None:
                kept = [batch.schema.field(c) for c in ("conversation", *message)]
                schema = pa.schema([*kept, pa.field("role", pa.string()), pa.field("text", pa.string()), pa.field("formatted", pa.string()), pa.field("loss_start", pa.int64()), pa.field("loss_end", pa.int64())])
            columns = {c: batch.column(c).to_pylist() for c in batch.schema.names}
            keys = zip(columns["conversation"], zip(*(columns[c] for c in message)))
            for key, turn, kind, who, text in zip(keys, zip(*(columns[c] for c in sequence)), columns["kind"], columns["role"], columns["text"]):
                if now is None or key != now:
                    size += close()
                    if now is None or key[0] != now[0]:
                        latest = None
                    now, opened, role, parts, reset, seen = key, False, "", [], None, None
                    if len(out) >= _BATCH_ROWS or size > _BATCH_CHARS:
                        yield flush()
                        size = 0
                if turn == seen:
                    continue  # the same event once more
                seen = turn
                if kind == "message" and not opened:
                    opened, role, parts = True, who or "", [text or ""]
                elif opened and kind == "delta":
                    parts.append(text or "")
                elif opened and kind in ("edit", "regenerate"):
                    parts, reset = [text or ""], _place(turn)
        if schema is not None:
            close()
            yield flush()

    return run


def rebuild_and_render(log: DataFrame, conversation: str, message: Sequence[str], sequence: Sequence[str], template: Template = Template()) -> DataFrame:
    """One row per message that is left: ``conversation``, the columns of ``message``, role, text, formatted, loss_start, loss_end.

    ``log`` has one event per row: its place (the columns ``sequence``), the place of the event that opened its message
    (the columns ``message``, in the same order and types), ``kind``, ``role`` and ``text``. Kinds: ``message`` opens one
    with its role and first text, ``delta`` adds text, ``edit`` and ``regenerate`` put their text (none: empty) in place
    of all before. These two also drop every message opened between theirs and themselves, even if theirs is dropped.
    Null texts and roles are empty; events of other or null kinds, of messages never opened, openings of what is open,
    and events that repeat a place of the same message count for nothing (of different events at one place the least
    kind, role and text counts). Null conversations are one; null places come first. An empty log gives no rows.

    The log is partitioned by conversation and sorted by message and sequence; a task folds it as a stream and holds one
    message. Rows of a conversation are consecutive and in order, so its formatted text is theirs one after the other;
    ``loss_start`` and ``loss_end`` count code points of the row's ``formatted``. A long conversation is never gathered.
    """
    if len(message) != len(sequence):
        raise ValueError("message names the sequence of an opening event")
    places = [F.col(c).alias(f"m{i}") for i, c in enumerate(message)] + [F.col(c).alias(f"s{i}") for i, c in enumerate(sequence)]
    events = log.select(F.col(conversation).alias("conversation"), *places, *[F.col(c).cast("string").alias(c) for c in ("kind", "role", "text")])
    order = ["conversation", *[f"m{i}" for i in range(len(message))], *[f"s{i}" for i in range(len(sequence))], "kind", "role", "text"]
    ready = events.repartition("conversation").sortWithinPartitions(*order)
    kinds = ", ".join(f"{c} {events.schema[c].dataType.simpleString()}" for c in order[: 1 + len(message)])
    found = ready.mapInArrow(_fold(template, len(message), len(sequence)), f"{kinds}, role string, text string, formatted string, loss_start long, loss_end long")
    names = [F.col("conversation").alias(conversation), *[F.col(f"m{i}").alias(c) for i, c in enumerate(message)]]
    return found.select(*names, "role", "text", "formatted", "loss_start", "loss_end")


def as_log(table: DataFrame, conversation: str, turn: str, delta_chars: int = 512) -> DataFrame:
    """The log of a table of finished turns (``role``, ``text``): assistants stream theirs in deltas, others send whole messages.

    Places are (``turn``, tie, row, step), and (of_turn, of_tie, of_row, of_step) for the opening event: turns of one
    number are ordered by a hash of role and text, and repeated rows are messages of their own.
    """
    body = F.coalesce(F.col("text").cast("string"), F.lit(""))
    deltas = F.regexp_extract_all(body, F.lit(f"(?s).{{1,{delta_chars}}}"), F.lit(0))
    opening = F.struct(F.lit("message").alias("kind"), F.when(F.col("streams"), "").otherwise(body).alias("text"))
    rest = F.transform(deltas, lambda t: F.struct(F.lit("delta").alias("kind"), t.alias("text")))
    events = F.when(F.col("streams"), F.concat(F.array(opening), rest)).otherwise(F.array(opening))
    rows = table.select(
        F.col(conversation).alias("conversation"), F.col(turn).cast("long").alias("turn"), F.xxhash64("role", body).alias("tie"),
        F.monotonically_increasing_id().alias("row"), F.col("role").cast("string").alias("role"), F.col("text"),
    ).withColumn("streams", F.coalesce(F.col("role") == "assistant", F.lit(False)))
    log = rows.select("conversation", "turn", "tie", "row", "role", F.posexplode(events).alias("step", "event"))
    opened = [F.col(c).alias(f"of_{c}") for c in ("turn", "tie", "row")]
    return log.select(F.col("conversation").alias(conversation), "turn", "tie", "row", F.col("step").cast("long").alias("step"), *opened, F.lit(0).cast("long").alias("of_step"), "event.kind", "role", "event.text")


def read_back(pieces: DataFrame, conversation: str, template: Template = Template()) -> DataFrame:
    """Per conversation: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, from the formatted texts alone.

    ``pieces`` is what ``rebuild_and_render`` returns, not stored or shuffled in between. Digests are fed row by row; a digest over
    one conversation is sequential by definition, so one task reads it, in bounded memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Any = ()
        turns = loss = None
        counts = [0, 0, 0]
        for batch in batches:
            out: list[tuple] = []
            for conv, formatted, a, b in zip(*(batch.column(c).to_pylist() for c in ("conversation", "formatted", "loss_start", "loss_end"))):
                if (conv,) != now:
                    if turns is not None:
                        out.append((*now, counts[0], turns.hexdigest(), counts[1], loss.hexdigest(), counts[2]))
                    now, turns, loss, counts = (conv,), hashlib.sha256(), hashlib.sha256(), [0, 0, 0]
                for role, text in template.read(formatted):
                    counts[0] += 1
                    turns.update(f"{role}\n{text}\n".encode())
                learnt = template.unescape(formatted[a:b])
                counts[1] += len(learnt)
                loss.update(learnt.encode())
                counts[2] += len(formatted)
            yield _digests(out, batch.schema.field("conversation").type)
            kind = batch.schema.field("conversation").type
        if turns is not None:
            yield _digests([(*now, counts[0], turns.hexdigest(), counts[1], loss.hexdigest(), counts[2])], kind)

    kind = pieces.schema[conversation].dataType.simpleString()
    rows = pieces.select(F.col(conversation).alias("conversation"), "formatted", "loss_start", "loss_end")
    found = rows.mapInArrow(run, f"conversation {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    return found.withColumnRenamed("conversation", conversation)


def _digests(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * 6
    types = (kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    names = ["conversation", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)
