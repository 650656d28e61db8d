"""Chat formatting: a finite-state machine over roles and a declarative template.

Turns stream in order of conversation and turn through tasks that hold one turn and a few counters, so
memory does not depend on the length of a conversation; a conversation itself is read by one task
because its digest runs over all its turns. Shuffles and sorts are Spark's and spill.

Defined cases: NULL text and NULL role are empty; a NULL turn comes first, and rows of equal turn are
ordered by role and text; rows with a NULL conversation id form one conversation; roles the machine
does not know are formatted and make the order invalid; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, functions as F

START, END = "start", "end"


@dataclass(frozen=True)
class Template:
    """Marks of a chat format and the order of roles it allows.

    A turn is ``open``, the role, ``between``, the text, ``close``; each part is a segment and only the
    text of roles in ``learned`` carries loss. ``moves`` maps a state to the roles that may follow; the
    state after a turn is its role. A conversation may end after a role in ``finals``.
    """

    open: str = "<|im_start|>"
    between: str = "\n"
    close: str = "<|im_end|>\n"
    learned: tuple[str, ...] = ("assistant",)
    moves: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            START: ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )
    finals: tuple[str, ...] = ("assistant",)

    @property
    def guarded(self) -> list[str]:
        """The escape sign and the first sign of each mark, in order of first use.

        Escaping replaces them all, so that no mark can begin inside a text or a role.
        """
        return list(dict.fromkeys(["\\", self.open[0], self.between[0], self.close[0]]))

    def escape(self, text: str) -> str:
        return text.translate({ord(c): f"\\{i}" for i, c in enumerate(self.guarded)})

    def unescape(self, text: str) -> str:
        guarded = self.guarded
        return re.sub(r"\\(\d)", lambda m: guarded[int(m[1])], text) if "\\" in text else text

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """The parts of one turn, each with its loss flag."""
        return [
            (self.open, False),
            (self.escape(role), False),
            (self.between, False),
            (self.escape(text), role in self.learned),
            (self.close, False),
        ]

    def read(self, formatted: str) -> list[tuple[str, str]]:
        """Roles and texts of formatted turns."""
        turns, at = [], 0
        while at < len(formatted):
            if not formatted.startswith(self.open, at):
                raise ValueError(f"no turn begins at {at}")
            middle = formatted.index(self.between, at + len(self.open))
            stop = formatted.index(self.close, middle + len(self.between))
            role = formatted[at + len(self.open) : middle]
            turns.append((self.unescape(role), self.unescape(formatted[middle + len(self.between) : stop])))
            at = stop + len(self.close)
        return turns


CHAT = Template()

SEGMENT_SCHEMA = (
    "conv_id string, turn string, place long, state string, moved boolean, formatted string, "
    "segments array<struct<text: string, loss: boolean>>"
)
DIGEST_SCHEMA = (
    "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, valid boolean"
)
_NONE = object()


def _as(kind: str, df: DataFrame, *names: str) -> DataFrame:
    """Ids cross into Python as text, so that NULLs do not turn whole numbers into floats."""
    return df.withColumns({n: F.col(n).cast(kind) for n in names})


def formatted_turns(conversations: DataFrame, template: Template = CHAT) -> DataFrame:
    """One row per turn in conversation order: its formatted string, segments and machine state.

    ``place`` counts the turns of a conversation from 0, ``state`` is the machine's state after the
    turn and ``moved`` says whether the move was allowed. Rows of a conversation are adjacent and in
    order within one partition.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, state, place = _NONE, START, 0
        for batch in batches:
            out = []
            for conv_id, turn, role, text in zip(batch.conv_id, batch.turn, batch.role, batch.text):
                if conv is _NONE or conv_id != conv:
                    conv, state, place = conv_id, START, 0
                moved = role in template.moves.get(state, ())
                state = role
                parts = template.segments(role, text)
                out.append(
                    (
                        conv_id,
                        turn,
                        place,
                        state,
                        moved,
                        "".join(t for t, _ in parts),
                        [{"text": t, "loss": loss} for t, loss in parts],
                    )
                )
                place += 1
            names = ["conv_id", "turn", "place", "state", "moved", "formatted", "segments"]
            yield pd.DataFrame(out, columns=names)

    formatted = _as("string", ordered, "conv_id", "turn").mapInPandas(run, SEGMENT_SCHEMA)
    return _as("long", formatted, "conv_id", "turn")


def conversation_digests(turns: DataFrame, template: Template = CHAT) -> DataFrame:
    """Read formatted turns back: one row per conversation with counts and digests.

    Takes the rows of :func:`formatted_turns` as they come. Digests grow turn by turn; the texts under
    the loss mask are those of the segments that carry it, unescaped.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [part.split()[0] for part in DIGEST_SCHEMA.split(", ")]
        conv, held = _NONE, None

        def row():
            all_turns, lost = held["turns"].hexdigest(), held["loss"].hexdigest()
            valid = held["valid"] and held["state"] in template.finals
            return (conv, held["n"], all_turns, held["loss_chars"], lost, held["chars"], valid)

        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                if conv is _NONE or r.conv_id != conv:
                    if conv is not _NONE:
                        out.append(row())
                    conv = r.conv_id
                    held = {"n": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256()}
                    held |= {"loss_chars": 0, "chars": 0, "valid": True, "state": START}
                for role, text in template.read(r.formatted):
                    held["n"] += 1
                    held["turns"].update(f"{role}\n{text}\n".encode())
                for part in r.segments:
                    if part["loss"]:
                        text = template.unescape(part["text"])
                        held["loss"].update(text.encode())
                        held["loss_chars"] += len(text)
                held["chars"] += len(r.formatted)
                held["valid"] &= bool(r.moved)
                held["state"] = r.state
            yield pd.DataFrame(out, columns=columns)
        if conv is not _NONE:
            yield pd.DataFrame([row()], columns=columns)

    return _as("long", _as("string", turns, "conv_id").mapInPandas(run, DIGEST_SCHEMA), "conv_id")
