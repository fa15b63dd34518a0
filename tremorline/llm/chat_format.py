"""Chat formatting: a declarative template, a finite-state machine over roles, loss flags per segment."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _dialogue() -> Mapping[str, Mapping[str, str]]:
    return {
        "start": {"system": "ready", "user": "asked"},
        "ready": {"user": "asked"},
        "asked": {"assistant": "answered"},
        "answered": {"user": "asked"},
    }


@dataclass(frozen=True)
class ChatTemplate:
    """How turns are written, in which order they may come, which are learned.

    A turn is before + role + between + text + after. between must be one
    character; before and after must start with `<|`, which escaped texts never
    hold. turns maps a state and a role to the next state; what it does not name
    is out of order. trained names the roles whose texts count in the loss.
    """

    before: str = "<|im_start|>"
    between: str = "\n"
    after: str = "<|im_end|>\n"
    start: str = "start"
    turns: Mapping[str, Mapping[str, str]] = field(default_factory=_dialogue)
    trained: tuple[str, ...] = ("assistant",)

    def __post_init__(self) -> None:
        if len(self.between) != 1 or not self.before.startswith("<|") or not self.after.startswith("<|"):
            raise ValueError("a template needs one character after the role and control strings that start with <|")

    def states(self) -> list[str]:
        named = [self.start, *self.turns, *(to for by_role in self.turns.values() for to in by_role.values())]
        return list(dict.fromkeys(named))


CHAT = ChatTemplate()


def escaped(text: Column) -> Column:
    """One more backslash in every `<` + backslashes + `|`: no `<|` is left, and
    taking one out of each gives the text again."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def _escaped_role(role: Column, between: str) -> Column:
    """escaped, with the character that ends a role spelt by its code point."""
    doubled = F.replace(role, F.lit("\\"), F.lit("\\\\"))
    return escaped(F.replace(doubled, F.lit(between), F.lit(f"\\{ord(between)};")))


def unescaped(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text) if "<\\" in text else text


def _unescaped_role(role: str) -> str:
    return re.sub(r"\\(\\|(\d+);)", lambda m: "\\" if m[2] is None else chr(int(m[2])), unescaped(role))


def chat_segments(
    conversations: DataFrame,
    template: ChatTemplate = CHAT,
    id_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
) -> DataFrame:
    """(conv_id, turn, role, segments) per row, segments of (text, loss).

    Each row is written by itself: no shuffle, nothing of a conversation is held
    together. A conversation's formatted text is that of its rows by turn (null
    first; rows of one turn by role, then text, both by bytes). Null role or
    text: empty. Extra columns are left out; an empty table gives no rows.
    """
    role = F.coalesce(F.col(role_column).cast("string"), F.lit(""))
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    header = F.concat(F.lit(template.before), _escaped_role(role, template.between), F.lit(template.between))
    segments = F.array(
        F.struct(header.alias("text"), F.lit(False).alias("loss")),
        F.struct(escaped(text).alias("text"), role.isin(*template.trained).alias("loss")),
        F.struct(F.lit(template.after).alias("text"), F.lit(False).alias("loss")),
    )
    return conversations.select(
        F.col(id_column).cast("bigint").alias("conv_id"),
        F.col(turn_column).cast("bigint").alias("turn"),
        role.alias("role"),
        segments.alias("segments"),
    )


def check_turns(
    conversations: DataFrame,
    template: ChatTemplate = CHAT,
    id_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
) -> DataFrame:
    """(conv_id, n_turns, valid, first_bad_turn, state) per conversation.

    The machine reads roles only, in ranges of (conv_id, turn, role), so that a
    conversation of any length is cut into pieces. What a piece does is a table:
    for each state it may be entered in, the state it is left in and the first
    turn out of order. Pieces are then applied one after the other, one row per
    piece. first_bad_turn counts from 1; valid means null there; state is the one
    after the last turn, or null. Null ids are one conversation; an empty table
    gives no rows.
    """
    states = template.states()
    number = {s: k for k, s in enumerate(states)}
    moves = [{role: number[to] for role, to in template.turns.get(s, {}).items()} for s in states]
    rows = conversations.select(
        F.col(id_column).cast("bigint").alias("conv_id"),
        F.col(turn_column).cast("bigint").alias("turn"),
        F.coalesce(F.col(role_column).cast("string"), F.lit("")).alias("role"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        current, n, at, bad, out = None, 0, [], [], []

        def piece() -> dict:
            return {"conv_id": current, "part": part, "n": n, "into": [-1 if b else s for s, b in zip(at, bad)], "bad": bad}

        for batch in batches:
            for conv, role in zip(batch.column("conv_id").to_pylist(), batch.column("role").to_pylist()):
                if not n or conv != current:
                    if n:
                        out.append(piece())
                    current, n, at, bad = conv, 0, list(range(len(moves))), [0] * len(moves)
                n += 1
                for s in range(len(moves)):
                    if not bad[s]:
                        to = moves[at[s]].get(role)
                        at[s], bad[s] = (at[s], n) if to is None else (to, 0)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=shape)
                out = []
        if n:
            yield pa.RecordBatch.from_pylist([piece()], schema=shape)

    many = pa.list_(pa.int64())
    shape = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("n", pa.int64()), ("into", many), ("bad", many)])
    pieces = (
        rows.repartitionByRange("conv_id", "turn", "role")
        .sortWithinPartitions("conv_id", "turn", "role")
        .mapInArrow(run, "conv_id BIGINT, part INT, n BIGINT, into ARRAY<BIGINT>, bad ARRAY<BIGINT>")
    )
    whole = pieces.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("part", "n", "into", "bad"))).alias("pieces"))
    applied = F.expr(
        f"""aggregate(pieces, named_struct('state', {number[template.start]}L, 'n', 0L, 'bad', 0L), (a, p) -> named_struct(
            'state', coalesce(get(p.into, int(a.state)), -1L), 'n', a.n + p.n,
            'bad', CASE WHEN a.bad > 0 THEN a.bad WHEN get(p.bad, int(a.state)) > 0 THEN a.n + get(p.bad, int(a.state)) ELSE 0L END))"""
    )
    names = F.array(*map(F.lit, states))
    return whole.select("conv_id", applied.alias("end")).select(
        "conv_id",
        F.col("end.n").alias("n_turns"),
        (F.col("end.bad") == 0).alias("valid"),
        F.when(F.col("end.bad") > 0, F.col("end.bad")).alias("first_bad_turn"),
        F.when(F.col("end.state") >= 0, F.get(names, F.col("end.state").cast("int"))).alias("state"),
    )


def read_chat(segments: DataFrame, template: ChatTemplate = CHAT) -> DataFrame:
    """Read formatted conversations back: turns, loss text and their digests.

    Turns are found by the control strings in the formatted text alone, the loss
    by the flags, both unescaped. Returns conv_id, n_turns, turns_sha256 (role,
    line feed, text, line feed per turn), loss_chars, loss_sha256 and
    formatted_chars per conversation.

    The text is shuffled once. A SHA-256 has to see its bytes in order, so one
    task streams a conversation's turns, sorted on disk where they are many; it
    holds one turn at a time. Raises ValueError where text is not as formatted.
    """
    turn = re.compile(
        f"{re.escape(template.before)}([^{re.escape(template.between)}]*){re.escape(template.between)}(.*?){re.escape(template.after)}",
        re.DOTALL,
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, open_, n, chars, loss_chars, out = None, False, 0, 0, 0, []
        turns, loss = hashlib.sha256(), hashlib.sha256()

        def row() -> tuple:
            return current, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars

        for batch in batches:
            for conv, pieces in zip(batch.column("conv_id").to_pylist(), batch.column("segments").to_pylist()):
                if not open_ or conv != current:
                    if open_:
                        out.append(row())
                    current, open_, n, chars, loss_chars = conv, True, 0, 0, 0
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                text, at = "".join(p["text"] for p in pieces), 0
                for found in turn.finditer(text):
                    if found.start() != at:
                        raise ValueError(f"text between the turns of conversation {conv}")
                    at, n = found.end(), n + 1
                    turns.update(f"{_unescaped_role(found[1])}\n{unescaped(found[2])}\n".encode())
                if at != len(text):
                    raise ValueError(f"text after the turns of conversation {conv}")
                chars += len(text)
                for p in pieces:
                    if p["loss"]:
                        learned = unescaped(p["text"])
                        loss_chars += len(learned)
                        loss.update(learned.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), shape.types)], schema=shape)
                out = []
        if open_:
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(row(), shape.types)], schema=shape)

    long, text = pa.int64(), pa.string()
    shape = pa.schema(
        [("conv_id", long), ("n_turns", long), ("turns_sha256", text), ("loss_chars", long), ("loss_sha256", text), ("formatted_chars", long)]
    )
    return (
        segments.repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", F.col("segments")[1]["text"])
        .select("conv_id", "segments")
        .mapInArrow(
            read,
            "conv_id BIGINT, n_turns BIGINT, turns_sha256 STRING, loss_chars BIGINT, loss_sha256 STRING, formatted_chars BIGINT",
        )
    )
