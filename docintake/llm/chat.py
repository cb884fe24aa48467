"""Chat formatting by a template and a finite-state machine over roles.

A conversation's rows, in the order of their turns, are validated by the machine of the
template, and every turn becomes three segments: an opening mark, the escaped text and a
closing mark. Text segments of the template's loss roles are under the loss. Only SQL
functions are used; a conversation is one row of the result, as it is one training example.

Control strings inside texts are escaped reversibly: a backslash is doubled, and one is put
behind the first character of each control string. A template whose marks could form a
control string together with a text's edge is refused.

Null texts and roles are empty; a role that the template does not know gets the general
marks, with the role inside, and ends the machine. Rows of the same turn are ordered by role,
then text; repeated rows are turns of their own. Rows without conv_id are one conversation.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docintake.functions.binding import bind


@dataclass(frozen=True)
class Turn:
    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Marks of each role, and which role may follow in which state of the machine."""

    start: str = "<s>"
    roles: dict[str, Turn] = field(
        default_factory=lambda: {
            "system": Turn("[SYS] ", " [/SYS]"),
            "user": Turn("[INST] ", " [/INST]"),
            "assistant": Turn("[OUT] ", "</s>", loss=True),
        }
    )
    # a role the template does not know: open, role, says, text, close
    other: tuple[str, str, str] = ("[TURN] ", " [SAYS] ", " [/TURN]")
    initial: str = "start"
    moves: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "told",
            ("start", "user"): "asked",
            ("told", "user"): "asked",
            ("asked", "assistant"): "answered",
            ("answered", "user"): "asked",
        }
    )
    accepting: tuple[str, ...] = ("answered",)

    def __post_init__(self):
        marks = [self.start, *self.other]
        marks += [m for t in self.roles.values() for m in (t.open, t.close)]
        if not all(t.close.strip() for t in self.roles.values()) or "\\" in "".join(marks):
            raise ValueError("each role needs a closing mark, and marks have no backslash")
        for control in self.controls:
            for k in range(1, len(control)):
                head, tail = control[:k], control[k:]
                for mark in marks:
                    if mark and (tail.startswith(mark) or mark.startswith(tail) or mark.endswith(head)):
                        raise ValueError(f"{mark!r} beside a text may form {control!r}")

    @property
    def controls(self) -> list[str]:
        marks = [self.start, *self.other]
        marks += [m for t in self.roles.values() for m in (t.open, t.close)]
        return sorted({m.strip() for m in marks if m.strip()})

    @property
    def states(self) -> list[str]:
        found = {self.initial, *self.accepting, *self.moves.values(), *(s for s, _ in self.moves)}
        return sorted(found)


def _quoted(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9])", r"\\\1", text)


def escape(text: Column, template: Template) -> Column:
    found = "|".join(f"{_quoted(c[0])}(?={_quoted(c[1:])})" for c in template.controls)
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), found, r"$0\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _segments(turn: Column, template: Template) -> Column:
    def segment(text: Column | str, loss: bool) -> Column:
        return F.struct(
            (F.lit(text) if isinstance(text, str) else text).alias("text"),
            F.lit(loss).alias("loss"),
        )

    text = escape(turn["text"], template)
    begin, says, end = template.other
    role = F.concat(F.lit(begin), escape(turn["role"], template), F.lit(says))
    general = F.array(segment(role, False), segment(text, False), segment(end, False))
    known = F
    for name, t in template.roles.items():
        three = F.array(segment(t.open, False), segment(text, t.loss), segment(t.close, False))
        known = known.when(turn["role"] == name, three)
    return known.otherwise(general)


def _machine(turns: Column, template: Template) -> Column:
    """Last state, and the position (from 0) of the first turn that had no move, or -1."""
    number = {s: i for i, s in enumerate(template.states)}
    stuck = -1

    def step(at: Column, turn: Column) -> Column:
        move = F
        for (state, role), to in template.moves.items():
            here = (at["state"] == number[state]) & (turn["role"] == role)
            move = move.when(here, F.lit(number[to]))
        to = move.otherwise(F.lit(stuck))
        return bind(
            lambda v: F.struct(
                v["to"].alias("state"),
                F.when((at["wrong"] < 0) & (v["to"] == stuck), at["n"])
                .otherwise(at["wrong"])
                .alias("wrong"),
                (at["n"] + 1).alias("n"),
            ),
            to=to,
        )

    begin = F.struct(
        F.lit(number[template.initial]).alias("state"), F.lit(-1).alias("wrong"), F.lit(0).alias("n")
    )
    accepting = [number[s] for s in template.accepting]
    return F.aggregate(
        turns, begin, step,
        lambda at: F.struct(at["state"].isin(accepting).alias("valid"), at["wrong"].alias("wrong")),
    )


def format_chats(messages: DataFrame, template: Template = Template()) -> DataFrame:
    """Rows ``conv_id, turn, role, text`` as one row per conversation.

    ``formatted`` is the whole text and ``segments`` its parts (text, loss), in order.
    ``valid`` says whether the turns are in order and complete; ``wrong_turn`` is the
    position of the first turn that may not stand where it does, or -1.
    """
    turn = F.struct(
        F.col("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    grouped = messages.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    start = F.array(F.struct(F.lit(template.start).alias("text"), F.lit(False).alias("loss")))
    marked = grouped.select(
        "conv_id",
        _machine(F.col("turns"), template).alias("machine"),
        F.concat(
            start, F.flatten(F.transform("turns", lambda t: _segments(t, template)))
        ).alias("segments"),
    )
    return marked.select(
        "conv_id",
        F.col("machine.valid").alias("valid"),
        F.col("machine.wrong").alias("wrong_turn"),
        "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
    )


def read_turns(formatted: Column, template: Template = Template()) -> Column:
    """Turns (role, text) of a formatted conversation."""
    closes = [t.close for t in template.roles.values()] + [template.other[2]]
    body = F.substring(formatted, len(template.start) + 1, 2**31 - 1)
    parts = F.split(body, "|".join(_quoted(c) for c in closes))
    parts = F.slice(parts, F.lit(1), F.size(parts) - 1)  # nothing stands behind the last close
    begin, says, _ = template.other

    def turn(part: Column) -> Column:
        def made(role: Column, text: Column) -> Column:
            return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

        def after(mark: str) -> Column:
            return F.substring(part, len(mark) + 1, 2**31 - 1)

        rest = after(begin)
        at = F.instr(rest, F.lit(says))
        found = F.when(
            part.startswith(begin),
            made(F.substr(rest, F.lit(1), at - 1), F.substr(rest, at + len(says))),
        )
        for name, t in template.roles.items():
            found = found.when(part.startswith(t.open), made(F.lit(name), after(t.open)))
        return found

    return F.transform(parts, turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss, unescaped."""
    kept = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(kept, lambda s: unescape(s["text"])), "")
