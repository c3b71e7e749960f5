r"""Chat formatting with a grammar round trip.

    conversation = turn*
    turn         = "[INST] " text " [/INST]"                    (user)
                 | "<s> " text " </s>"                          (assistant)
                 | "<<SYS:" role ">> " text " <</SYS>>"         (any other role; \ and > in its name carry a backslash)

A text is first rendered as it is and parsed again. Only if what comes back is not identical, control
strings in it (and those that backslashes precede) get one backslash more, which the parser takes off.
The parser is deterministic: the opening marker gives the role, and the first control string without a
backslash must be that role's closing marker. Conversations are read back from their whole formatted
text, without its turn borders, and every turn recovered is held against its source.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONTROL = r"\[/?INST\]|</?s>|<<SYS:|<</SYS>>"
_CONTROL = re.compile(CONTROL)
_ESCAPABLE = re.compile(rf"(\\*)({CONTROL})")
_ESCAPED = re.compile(rf"\\(\\*)({CONTROL})")
_SYSTEM = re.compile(r"<<SYS:((?:[^\\>]|\\[\\>])*)>> ", re.S)
OPEN, CLOSE = {"user": "[INST] ", "assistant": "<s> "}, {"user": " [/INST]", "assistant": " </s>"}


class GrammarError(ValueError):
    pass


class Unfinished(GrammarError):
    """More text could make a turn of it."""


def escape(text: str) -> str:
    return _ESCAPABLE.sub(r"\1\\\2", text)


def render(role: str, text: str) -> str:
    if role in OPEN:
        return OPEN[role] + text + CLOSE[role]
    name = re.sub(r"[\\>]", r"\\\g<0>", role)
    return f"<<SYS:{name}>> {text} <</SYS>>"


def parse_turn(text: str, at: int = 0) -> tuple[str, str, int]:
    """(role, text, end) of the turn that begins at ``at``."""
    for role, opening in OPEN.items():
        if text.startswith(opening, at):
            start = at + len(opening)
            break
    else:
        system = _SYSTEM.match(text, at)
        if not system:
            begun = text.startswith("<<SYS:", at) or any(o.startswith(text[at:at + len(o)]) for o in (*OPEN.values(), "<<SYS:"))
            raise (Unfinished if begun else GrammarError)(f"no turn at {at}")
        role, start = re.sub(r"\\(.)", r"\1", system[1], flags=re.S), system.end()
    closing = CLOSE.get(role, " <</SYS>>") if not text.startswith("<<SYS:", at) else " <</SYS>>"
    for control in _CONTROL.finditer(text, start):
        if text[control.start() - 1] == "\\":
            continue
        begin = control.start() - 1
        if begin < start or text[begin:control.end()] != closing:
            raise GrammarError(f"{control[0]} at {control.start()} does not close the turn at {at}")
        return role, _ESCAPED.sub(r"\1\2", text[start:begin]), control.end()
    raise Unfinished(f"the turn at {at} is not closed")


class Reader:
    """Recovers turns from a formatted text that comes in pieces of any size; holds what is not yet a turn.

    An unfinished turn is parsed anew only when the held text has doubled, so a long turn in many pieces
    costs no more than a few passes.
    """

    def __init__(self):
        self.held, self.wait = "", 0

    def feed(self, piece: str) -> list[tuple[str, str]]:
        self.held += piece
        return self._turns() if len(self.held) >= self.wait else []

    def close(self) -> list[tuple[str, str]]:
        turns = self._turns()
        if self.held:
            raise Unfinished(f"{len(self.held)} characters after the last turn")
        return turns

    def _turns(self) -> list[tuple[str, str]]:
        turns, at = [], 0
        while at < len(self.held):
            try:
                role, text, at = parse_turn(self.held, at)
            except Unfinished:
                break
            turns.append((role, text))
        self.held = self.held[at:]
        self.wait = 2 * len(self.held)
        return turns


def parse(text: str) -> list[tuple[str, str]]:
    turns, at = [], 0
    while at < len(text):
        role, content, at = parse_turn(text, at)
        turns.append((role, content))
    return turns


def round_trip(role: str, text: str) -> str:
    """The rendered turn that parses to exactly this role and text."""
    for candidate in (text, escape(text)):
        rendered = render(role, candidate)
        try:
            if parse(rendered) == [(role, text)]:
                return rendered
        except GrammarError:
            pass
    raise GrammarError(f"a {role} turn does not survive the round trip")


def source_digest(role: str, text: str) -> bytes:
    return hashlib.sha256(f"{len(role)}\n{role}{text}".encode()).digest()[:16]


def render_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, rendered, source), row by row; null roles and texts are empty, ``source`` is a digest of both."""
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def run(batches):
        for batch in batches:
            said = list(zip(batch.column("role").to_pylist(), batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([round_trip(r, t) for r, t in said], pa.string()), pa.array([source_digest(r, t) for r, t in said], pa.binary())],
                                             [*batch.schema.names, "rendered", "source"])

    return rows.mapInArrow(run, "conv_id long, turn long, role string, text string, rendered string, source binary")


class _Recovered:
    """One conversation on its way back: its digests, and the source turns still to be recovered."""

    def __init__(self, key, with_text: bool):
        self.key, self.reader, self.sources = key, Reader(), deque()
        self.turns, self.loss, self.n, self.loss_chars, self.chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
        self.parts = [] if with_text else None

    def add(self, rendered: str, source: bytes) -> None:
        self.sources.append(source)
        self.chars += len(rendered)
        if self.parts is not None:
            self.parts.append(rendered)
        self.take(self.reader.feed(rendered))

    def take(self, turns: list[tuple[str, str]]) -> None:
        for role, text in turns:
            if not self.sources or self.sources.popleft() != source_digest(role, text):
                raise GrammarError(f"turn {self.n} of conversation {self.key} came back otherwise")
            self.n += 1
            self.turns.update(f"{role}\n{text}\n".encode())
            if role == "assistant":
                self.loss_chars += len(text)
                self.loss.update(text.encode())

    def row(self) -> tuple:
        self.take(self.reader.close())
        if self.sources:
            raise GrammarError(f"{len(self.sources)} turns of conversation {self.key} did not come back")
        found = self.key, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars
        return found if self.parts is None else (*found, "".join(self.parts))


def conversations(turns: DataFrame, with_text: bool = True) -> DataFrame:
    """One row per conversation, read back from its formatted text: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars and, unless off, formatted.

    Turns come in order of turn, then role, then text (equal rows stay as often as they are; nulls
    first). A null conv_id is a conversation. The rendered turns of a conversation are one stream of
    characters to the reader, who knows no borders; each recovered turn must equal its source, in order,
    and nothing may be left, or the job fails. A conversation streams through one task in memory bounded
    by its longest turn; only ``formatted`` needs a conversation to fit a cell. The loss mask covers the
    assistant texts.
    """
    kinds = {"conv_id": pa.int64(), "n_turns": pa.int64(), "turns_sha256": pa.string(), "loss_chars": pa.int64(), "loss_sha256": pa.string(), "formatted_chars": pa.int64()}
    if with_text:
        kinds["formatted"] = pa.string()

    def run(batches):
        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds.values())], list(kinds))

        open_ = None
        for batch in batches:
            done = []
            for key, rendered, source in zip(batch.column("conv_id").to_pylist(), batch.column("rendered").to_pylist(), batch.column("source").to_pylist()):
                if open_ is None or open_.key != key:
                    if open_:
                        done.append(open_.row())
                    open_ = _Recovered(key, with_text)
                open_.add(rendered, source)
            yield out(done)
        if open_:
            yield out([open_.row()])

    ordered = render_turns(turns).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "rendered", "source")
    return ordered.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long" + ", formatted string" * with_text)
