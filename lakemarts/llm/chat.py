"""Operator 7, chat formatting, with DataFrame functions only.

A conversation's turns are written by a declarative ``Template``: control
strings around role and text, the roles whose text carries loss, and the
transitions of a finite-state machine over roles.  ``segments`` gives one row
per turn with its text segments and their loss flags and whether the machine
allows the turn; ``formatted`` gives one row per conversation;
``read_back`` turns formatted text into roles and texts again.

Control strings inside roles and texts are escaped: the escape character
becomes escape + "0", the i-th control string escape + i.  After that no
control string can occur outside the template's own places, and undoing the
replacements in reverse order gives the text back.

Inputs: null texts and null roles count as empty; an empty or unknown role
is formatted like any other and fails the machine.  Very long texts are kept
whole, as one value of their conversation.  Turns are ordered by
turn, then role, then text (nulls first), so ties and repeated rows have one
order and all stay.  Rows without a conv_id form one conversation with a null
id.  Other columns are ignored.  An empty table gives an empty result.  The
turns of one conversation, whose digest and text are one value each by
contract, meet in one group; nothing else does.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """``start`` role ``middle`` text ``stop``; ``loss`` names the roles whose
    text carries loss; ``after`` the roles that may follow a role ("" is the
    beginning), ``last`` the roles that may end a conversation."""

    start: str = "<turn>"
    middle: str = "<text>"
    stop: str = "</turn>\n"
    escape: str = "\\"
    loss: frozenset[str] = frozenset({"assistant"})
    after: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )
    last: frozenset[str] = frozenset({"user", "assistant"})

    def __post_init__(self):
        first = {c[:1] for c in self.controls}
        if len(self.escape) != 1 or any(not c or self.escape in c for c in self.controls):
            raise ValueError("control strings are not empty and do not contain the one escape character")
        if any("\\E" in c for c in self.controls):
            raise ValueError("no control string may hold the end of a quotation, \\E")
        if any(f in c[1:] for c in self.controls for f in first):
            raise ValueError("a control string's first character may not occur inside control strings")
        if any(a != b and a.startswith(b) for a in self.controls for b in self.controls):
            raise ValueError("no control string may start with another one")

    @property
    def controls(self) -> tuple[str, str, str]:
        return (self.start, self.middle, self.stop)

    def escaped(self, text: Column) -> Column:
        text = F.replace(text, F.lit(self.escape), F.lit(self.escape + "0"))
        for i, control in enumerate(self.controls, 1):
            text = F.replace(text, F.lit(control), F.lit(f"{self.escape}{i}"))
        return text

    def unescaped(self, text: Column) -> Column:
        for i, control in reversed(list(enumerate(self.controls, 1))):
            text = F.replace(text, F.lit(f"{self.escape}{i}"), F.lit(control))
        return F.replace(text, F.lit(self.escape + "0"), F.lit(self.escape))


def _turns(rows: DataFrame) -> DataFrame:
    return rows.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )


def _allowed(before: Column, role: Column, template: Template) -> Column:
    steps = F.array(*(F.lit(f"{a}\n{b}") for a, follow in template.after.items() for b in follow))
    return F.array_contains(steps, F.concat(before, F.lit("\n"), role))


def _segments(role: Column, text: Column, template: Template) -> Column:
    """A turn's text segments with their loss flags."""

    def segment(value: Column, loss: Column) -> Column:
        return F.struct(value.alias("text"), loss.alias("loss"))

    no = F.lit(False)
    return F.array(
        segment(F.concat(F.lit(template.start), template.escaped(role), F.lit(template.middle)), no),
        segment(template.escaped(text), role.isin(*template.loss)),
        segment(F.lit(template.stop), no),
    )


def segments(rows: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per turn: ``conv_id, turn, position, role, allowed, segments``.
    ``allowed`` is the machine's step from the turn before; a window sorts a
    conversation and keeps no more than the turn before."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    turns = _turns(rows).withColumn("position", F.row_number().over(order) - 1)
    before = F.coalesce(F.lag("role").over(order), F.lit(""))
    return turns.withColumn("allowed", _allowed(before, F.col("role"), template)).select(
        "conv_id", "turn", "position", "role", "allowed",
        _segments(F.col("role"), F.col("text"), template).alias("segments"),
    )


def formatted(rows: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per conversation: ``conv_id, segments, formatted, valid``."""
    turn = F.struct("turn", "role", "text")
    conversations = _turns(rows).groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    roles = F.col("turns.role")
    before = F.concat(F.array(F.lit("")), F.slice(roles, 1, F.size(roles) - 1))
    steps = F.zip_with(before, roles, lambda a, b: _allowed(a, b, template))
    valid = F.forall(steps, lambda ok: ok) & F.element_at(roles, -1).isin(*template.last)
    parts = F.flatten(F.transform("turns", lambda t: _segments(t["role"], t["text"], template)))
    return conversations.select("conv_id", parts.alias("segments"), valid.alias("valid")).withColumn(
        "formatted", F.array_join("segments.text", "")
    )


def read_back(text: Column, template: Template = Template()) -> Column:
    """Roles and texts of a formatted conversation, in order."""
    pieces = F.split(text, _quoted(template.stop))
    # behind the last control string there is nothing
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        halves = F.split(F.substr(piece, F.lit(len(template.start) + 1)), _quoted(template.middle))
        return F.struct(
            template.unescaped(halves[0]).alias("role"), template.unescaped(halves[1]).alias("text")
        )

    return F.transform(pieces, turn)


def loss_text(parts: Column, template: Template = Template()) -> Column:
    """The text under the loss mask of a conversation's segments, unescaped
    segment by segment, with nothing between."""
    marked = F.filter(parts, lambda s: s["loss"])
    return F.array_join(F.transform(marked, lambda s: template.unescaped(s["text"])), "")


def _quoted(control: str) -> str:
    return "\\Q" + control + "\\E"
