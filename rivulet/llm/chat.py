"""Chat formatting in budgeted windows.

A conversation longer than the token budget becomes several windows. Prefix sums of
the tokens of turns as they are written choose the turns of a window, whole turns always; each window begins with
the system turn, repeats the last turns of the window before as history within a
budget of its own, and masks what it repeats, so that every assistant text is a
training target once.

    ### user: text </turn>

Control signs inside roles and texts are escaped with a backslash and read back exactly.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import filled, mapped, slices
from rivulet.llm.subwords import subwords

BUDGET = 1024
HISTORY = 256
TARGET = "assistant"
SYSTEM = "system"
# Turns of one conversation that are held at a time.
HELD_TOKENS = 1 << 20

_SIGNS = re.compile(r"[\\#<]")
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"### ((?:[^\\#<:]++|\\.)*+): ((?:[^\\#<]++|\\.)*+)</turn>\n", re.S)


def escape(text: str) -> str:
    """No unescaped backslash, # or < is left."""
    return _SIGNS.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The turn as written, and the span of its escaped text."""
    head, body = f"### {escape(role).replace(':', chr(92) + ':')}: ", escape(text)
    return f"{head}{body} </turn>\n", len(head), len(head) + len(body)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a window, unescaped."""
    out, at = [], 0
    while at < len(formatted):
        turn = _TURN.match(formatted, at)
        if turn is None:
            raise ValueError(f"no turn at {at}")
        out.append((unescape(turn[1]), unescape(turn[2][:-1])))  # the blank before the end mark
        at = turn.end()
    return out


class _Windows:
    """Windows of one conversation, turn by turn; holds one window and its history."""

    def __init__(self, budget: int, history: int):
        self.budget, self.history = budget, history
        self.system = None
        self.first, self.turns, self.sums = 0, [], [0]
        self.repeated = 0

    def add(self, role: str, text: str, tokens: int) -> list:
        done = []
        turn = (role, text, tokens)
        fixed = self.system[2] if self.system else 0
        if len(self.turns) > self.repeated and fixed + self.sums[-1] + turn[2] > self.budget:
            done.append(self.close())
            self._carry(turn[2])
        self.turns.append(turn)
        self.sums.append(self.sums[-1] + turn[2])
        return done

    def _carry(self, coming: int) -> None:
        """Starts the next window: the latest turns that fit the history budget are repeated."""
        if self.first == 0 and self.turns[0][0] == SYSTEM:
            self.system = self.turns[0]
        self.first += len(self.turns) - self.repeated
        fixed = self.system[2] if self.system else 0
        room = min(self.history, self.budget - fixed - coming)
        sums = np.array(self.sums)
        start = int(np.searchsorted(sums, sums[-1] - room))  # first turn of the longest tail within the room
        start = max(start, 1 if self.system is not None and self.turns[0] is self.system else 0)
        self.turns = self.turns[start:]
        self.repeated = len(self.turns)
        self.sums = [0, *np.cumsum([t[2] for t in self.turns]).tolist()]

    def close(self) -> tuple:
        """(first new turn, repeated turns in front, text, loss spans)."""
        parts, spans, at = [], [], 0
        shown = [(t, i < self.repeated) for i, t in enumerate(self.turns)]
        if self.system is not None:
            shown.insert(0, (self.system, True))
        for (role, text, _), old in shown:
            written, start, end = format_turn(role, text)
            if role == TARGET and not old:
                spans.append((at + start, at + end))
            parts.append(written)
            at += len(written)
        return self.first, sum(old for _, old in shown), "".join(parts), spans


def format_conversations(
    conversations: DataFrame, tokenizer: str, budget: int = BUDGET, history: int = HISTORY
) -> DataFrame:
    """(conv_id, window, repeated, formatted, loss_starts, loss_ends): one row per window.

    Turns go by `turn` (NULL first), then role and text; NULL role or text is empty;
    rows without conv_id are one conversation. The first turn is kept in all windows if
    its role is system. A turn over the budget has a window of its own with the system
    turn. Loss spans are code points of `formatted`. A conversation is read in order by
    one task that holds one window at a time. An empty table gives an empty result.
    """
    rows = conversations.select("conv_id", "turn", filled("role").alias("role"), filled("text").alias("text"))
    names = ["conv_id", "window", "repeated", "formatted", "loss_starts", "loss_ends"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = subwords(tokenizer)
        state, conv, number, out, size = None, None, 0, [], 0

        def emit(window):
            nonlocal number, size
            _, repeated, text, spans = window
            out.append((conv, number, repeated, text, [s for s, _ in spans], [e for _, e in spans]))
            number, size = number + 1, size + len(text)

        def flush():
            nonlocal out, size
            columns = zip(*out) if out else [[]] * len(names)
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
            out, size = [], 0
            return batch

        for batch in slices(batches, "text"):
            ids, roles, texts = (batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))
            written = encoder.encode([format_turn(*turn)[0] for turn in zip(roles, texts)])
            for own, role, text, tokens in zip(ids, roles, texts, map(len, written)):
                if state is None or own != conv:
                    if state is not None:
                        emit(state.close())
                    state, conv, number = _Windows(budget, history), own, 0
                for window in state.add(role, text, tokens):
                    emit(window)
                if size > 4_000_000:
                    yield flush()
        if state is not None:
            emit(state.close())
        yield flush()

    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return mapped(
        ordered, run, "conv_id long, window int, repeated int, formatted string, loss_starts array<long>, loss_ends array<long>"
    )


def conversation_digests(windows: DataFrame) -> DataFrame:
    """What the windows say, read back: one row per conversation.

    conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_windows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, conv, out = None, None, []

        def emit():
            turns, loss, n_turns, loss_chars, chars, n_windows = held
            out.append((conv, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, n_windows))

        for batch in slices(batches, "formatted"):
            for row in batch.to_pylist():
                if held is None or row["conv_id"] != conv:
                    if held is not None:
                        emit()
                    held, conv = [hashlib.sha256(), hashlib.sha256(), 0, 0, 0, 0], row["conv_id"]
                text = row["formatted"]
                for role, said in read_turns(text)[row["repeated"] :]:
                    held[0].update(f"{role}\n{said}\n".encode())
                    held[2] += 1
                for start, end in zip(row["loss_starts"], row["loss_ends"]):
                    said = unescape(text[start:end])
                    held[1].update(said.encode())
                    held[3] += len(said)
                held[4] += len(text)
                held[5] += 1
        if held is not None:
            emit()
        columns = list(zip(*out)) if out else [[]] * 7
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_windows"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    ordered = windows.repartition("conv_id").sortWithinPartitions("conv_id", "window")
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_windows long"
    return mapped(ordered, run, schema)
