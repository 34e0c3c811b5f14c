"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are the context,
and only its text is trainable. Turns that follow the last reply form one more row
without a target, so that the output holds every turn.

Template: a turn is ``<turn ROLE>TEXT</turn>``. Within ROLE and TEXT every ``<``, ``>``, ``[``, ``]``
and backslash has a backslash before it, so no control string (``</s>``, ``[INST]``, the turn
marks) survives whole, and dropping those backslashes restores the text.

Turns are streamed in order, conversation by conversation; a task holds the text of one
example. The examples of a conversation of n turns have about n * n / 2 turns of context;
that is the method's output, not a copy made on the way.

Defined results: a null role or text counts as empty; turns of equal number go by role and
text; a repeated row is a turn of its own; null numbers come first and a null
conversation is a conversation. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

ASSISTANT = "assistant"
FLUSH_CHARS = 4 << 20
_SPECIAL = re.compile(r"[<>\[\]\\]")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_PLAIN = r"((?:[^<>\[\]\\]+|\\.)*)"
_TURN = re.compile(rf"<turn {_PLAIN}>{_PLAIN}</turn>", re.DOTALL)
EXAMPLES = "conv_id long, example long, n_turns long, text string, loss_start long, loss_end long"


def escape(text: str) -> str:
    return _SPECIAL.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turn(role: str, text: str) -> str:
    return f"<turn {escape(role)}>{escape(text)}</turn>"


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted text; fails on anything else."""
    turns, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError(f"no turn at {at}")
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError(f"no turn at {at}")
    return turns


def _null(x):
    return None if x is None or x is pd.NA or x != x else int(x)


def _expand(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [f.split()[0] for f in EXAMPLES.split(", ")]
    conv, context, turns, number, open_ = object(), "", 0, 0, False
    rows: list[tuple] = []
    held = 0
    for frame in frames:
        for own, role, text in zip(frame["conv_id"], frame["role"], frame["text"]):
            own = _null(own)
            if own != conv:
                if open_:
                    rows.append((conv, number, turns, context, None, None))
                conv, context, turns, number = own, "", 0, 0
            head = f"<turn {escape(role)}>"
            start = len(context) + len(head)
            context += format_turn(role, text)
            turns += 1
            open_ = role != ASSISTANT
            if not open_:
                rows.append((conv, number, turns, context, start, len(context) - len("</turn>")))
                number += 1
                held += len(context)
            if held >= FLUSH_CHARS:
                yield _frame(rows, names)
                rows, held = [], 0
    if open_:
        rows.append((conv, number, turns, context, None, None))
    if rows:
        yield _frame(rows, names)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=names)
    return frame.astype({c: "Int64" for c in names if c != "text"})


def expand(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Examples (conv_id, example, n_turns, text, loss_start, loss_end), in order within a conversation.

    The loss span is in code points, end exclusive, and null in the row without a target.
    """
    turns = conversations.select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInPandas(_expand, EXAMPLES)


def _digest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    conv, latest, loss, loss_chars, formatted = object(), None, None, 0, 0
    rows: list[tuple] = []

    def close():
        turns = read_turns(latest)
        whole = hashlib.sha256()
        for role, text in turns:
            whole.update(f"{role}\n{text}\n".encode())
        rows.append((conv, len(turns), whole.hexdigest(), loss_chars, loss.hexdigest(), formatted))

    names = [f.split()[0] for f in DIGESTS.split(", ")]
    for frame in frames:
        for own, text, start, end in zip(frame["conv_id"], frame["text"], frame["loss_start"], frame["loss_end"]):
            own = _null(own)
            if own != conv:
                if latest is not None:
                    close()
                conv, latest, loss, loss_chars, formatted = own, None, hashlib.sha256(), 0, 0
            latest = text
            formatted += len(text)
            if _null(start) is not None:
                reply = unescape(text[int(start) : int(end)])
                loss.update(reply.encode())
                loss_chars += len(reply)
        if rows:
            yield _typed(rows, names)
            rows.clear()
    if latest is not None:
        close()
        yield _typed(rows, names)


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _typed(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=names).astype(
        {"conv_id": "Int64", "n_turns": "int64", "loss_chars": "int64", "formatted_chars": "int64"}
    )


def digests(examples: DataFrame) -> DataFrame:
    """Per conversation what its examples hold, read back from their texts and loss spans.

    ``examples`` must come straight from ``expand`` or be sorted alike within partitions that hold
    whole conversations.
    """
    return examples.select("conv_id", "text", "loss_start", "loss_end").mapInPandas(_digest, DIGESTS)
