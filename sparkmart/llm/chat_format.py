"""Chat formatting with a grammar round trip.

A turn is written as ``<|im_start|>`` role newline text ``<|im_end|>`` newline. Each
written turn is read again by the parser below, which takes no ``<|...|>`` but those of
the template; if it gives back another role or text, or none, the offending part is escaped
and the turn is written and read once more, until both are identical. Escaping puts one more
backslash into each ``<``, backslashes, ``|`` (so nothing that looks like a control string
is left, of this or another template), and writes a newline in a role as ``<|nl|>``;
reading takes one backslash away. Most texts need none and stay as they are.

A conversation's text is that of its turns in order. Turns are separate rows, so a
conversation of any length is written by many tasks.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

START, END, NEWLINE = "<|im_start|>", "<|im_end|>", "<|nl|>"
#: What looks like a control string, of this or another template.
_CONTROL = re.compile(r"<\|[^|]*\|>")
LOSS_ROLE = "assistant"
_PLAIN, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _PLAIN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def parse(written: str) -> list[tuple[str, int, int, str]] | None:
    """(role, where its text begins and ends, text) of each turn; None if ill-formed."""
    turns, at = [], 0
    while at < len(written):
        if not written.startswith(START, at):
            return None
        at += len(START)
        line, end = written.find("\n", at), written.find(END, at)
        if line < 0 or end < line:
            return None
        role = written[at:line].split(NEWLINE)
        text = written[line + 1 : end]
        if any(map(_CONTROL.search, (*role, text))):
            return None
        if not written.startswith(END + "\n", end):
            return None
        role = "\n".join(map(unescape, role))
        turns.append((role, line + 1, end, unescape(text)))
        at = end + len(END) + 1
    return turns


def write_turn(role: str, text: str) -> tuple[str, int, int]:
    """The written turn, and where its text begins and ends in it."""
    safe_role, safe_text = NEWLINE.join(map(escape, role.split("\n"))), escape(text)
    # The text alone first: a role hardly ever conflicts.
    for shown_role, shown_text in (
        (role, text),
        (role, safe_text),
        (safe_role, text),
        (safe_role, safe_text),
    ):
        written = f"{START}{shown_role}\n{shown_text}{END}\n"
        turns = parse(written)
        if turns and len(turns) == 1 and (turns[0][0], turns[0][3]) == (role, text):
            return written, turns[0][1], turns[0][2]
    raise AssertionError("an escaped turn must be read back")


_FORMATTED = (
    "conv_id {id}, turn {turn}, role string, formatted string, "
    "loss_start long, loss_end long"
)


def _writer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        roles = [x or "" for x in batch.column("role").to_pylist()]
        texts = [x or "" for x in batch.column("text").to_pylist()]
        written = [write_turn(r, t) for r, t in zip(roles, texts, strict=True)]
        loss = [r == LOSS_ROLE for r in roles]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("conv_id"),
                batch.column("turn"),
                pa.array(roles, pa.string()),
                pa.array([w for w, _, _ in written], pa.string()),
                *(
                    pa.array(
                        [w[k] if on else None for w, on in zip(written, loss, strict=True)],
                        pa.int64(),
                    )
                    for k in (1, 2)
                ),
            ],
            names=["conv_id", "turn", "role", "formatted", "loss_start", "loss_end"],
        )


def format_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, formatted, loss_start, loss_end), one row per turn.

    ``turns`` has conv_id, turn, role and text; other columns are not read. The loss
    mask of a turn is code points ``loss_start`` to ``loss_end`` of ``formatted``, and
    null unless the role is ``assistant``. A null role or text is written as empty. A
    repeated row is a turn of its own; an empty table gives an empty result.
    """
    kind = {f.name: f.dataType.simpleString() for f in turns.schema}
    return turns.select("conv_id", "turn", "role", "text").mapInArrow(
        _writer, _FORMATTED.format(id=kind["conv_id"], turn=kind["turn"])
    )


class _Digest:
    """What is read back of one conversation, turn by turn."""

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = 0

    def add(self, formatted: str, start: int | None, end: int | None) -> None:
        for role, _, _, text in parse(formatted):
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n_turns += 1
        if start is not None:
            learned = unescape(formatted[start:end])
            self.loss.update(learned.encode())
            self.loss_chars += len(learned)
        self.formatted_chars += len(formatted)

    def row(self) -> tuple:
        return (
            self.n_turns,
            self.turns.hexdigest(),
            self.loss_chars,
            self.loss.hexdigest(),
            self.formatted_chars,
        )


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(ids: list, done: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*done, strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, kind), *(pa.array(c) for c in columns)],
            names=[
                "conv_id",
                "n_turns",
                "turns_sha256",
                "loss_chars",
                "loss_sha256",
                "formatted_chars",
            ],
        )

    digest, own, kind = None, None, None
    for batch in batches:
        kind = batch.column("conv_id").type
        ids, done = [], []
        for conv, *turn in zip(
            *(
                batch.column(c).to_pylist()
                for c in ("conv_id", "formatted", "loss_start", "loss_end")
            ),
            strict=True,
        ):
            if digest is None or conv != own:
                if digest is not None:
                    ids.append(own)
                    done.append(digest.row())
                digest, own = _Digest(), conv
            digest.add(*turn)
        if done:
            yield rows(ids, done, kind)
    if digest is not None:
        yield rows([own], [digest.row()], kind)


def read_back(formatted: DataFrame) -> DataFrame:
    """Counts and digests of each conversation, parsed from its written turns.

    Turns go by ``turn``, equal ones by their text. A conversation's turns pass through
    one task in order, as its digest asks for, but are never held together. Turns with
    a null conv_id are one conversation.
    """
    kind = formatted.schema["conv_id"].dataType.simpleString()
    return (
        formatted.repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "formatted")
        .select("conv_id", "formatted", "loss_start", "loss_end")
        .mapInArrow(
            _reader,
            f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, "
            "loss_sha256 string, formatted_chars long",
        )
    )
