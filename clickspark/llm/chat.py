"""Conversations as training text.

Only DataFrame functions: nothing here runs Python in a task.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """How turns are written, which order of roles is right, and what is learnt.

    A turn is ``opening``, the role's label, ``after_label``, its text and
    ``closing``. The control strings begin with characters of ``escapes``, and
    these never appear in an escaped text or label: each is written as
    a backslash and its letter. A template of which that does not hold is refused, as
    a text could pass for a turn.
    """

    opening: str = "### "
    after_label: str = ": "
    closing: str = "</turn>\n"
    labels: dict[str, str] = field(
        default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"}
    )
    learnt: tuple[str, ...] = ("assistant",)
    #: Which role may follow which; "" is the start.
    order: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )
    final: tuple[str, ...] = ("assistant",)
    #: Escaped in this order. The backslash comes first; ":" is for labels.
    escapes: tuple[tuple[str, str], ...] = (("\\", "e"), ("#", "h"), ("<", "l"), (":", "c"))

    def __post_init__(self) -> None:
        chars = [c for c, _ in self.escapes]
        letters = [x for _, x in self.escapes]
        if not chars or chars[0] != "\\" or any(len(c) != 1 for c in [*chars, *letters]):
            raise ValueError("escapes are single characters, the backslash first")
        if len({*chars}) < len(chars) or len({*letters}) < len(letters) or {*chars} & {*letters}:
            raise ValueError("escaped characters and their letters must differ from each other")
        for control in (self.opening, self.after_label, self.closing):
            if control[:1] not in chars[1:]:
                raise ValueError(f"a text could hold {control!r}: it must begin with an escaped character")
        names = [*self.labels.values()]
        if len({*names}) < len(names) or any(n[:1] == "?" or {*n} & {*chars} for n in names):
            raise ValueError("labels differ, begin with no question mark and hold no escaped character")

    def escape(self, text: Column) -> Column:
        for char, letter in self.escapes:
            text = F.replace(text, F.lit(char), F.lit("\\" + letter))
        return text

    def unescape(self, text: Column) -> Column:
        for char, letter in reversed(self.escapes):
            text = F.replace(text, F.lit("\\" + letter), F.lit(char))
        return text

    def label(self, role: Column) -> Column:
        """A known role's label; any other role as it is, escaped, after "?"."""
        labels = _lookup(self.labels)
        return F.coalesce(F.element_at(labels, role), F.concat(F.lit("?"), self.escape(role)))

    def role(self, label: Column) -> Column:
        roles = _lookup({v: k for k, v in self.labels.items()})
        return F.coalesce(F.element_at(roles, label), self.unescape(F.substr(label, F.lit(2))))


CHAT = Template()


def format_chats(
    turns: DataFrame,
    template: Template = CHAT,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per conversation: its id, ``segments`` (text and loss flag, in
    order), ``formatted`` (the segments joined), ``n_turns``, ``valid`` and
    ``bad_turn``.

    A finite-state machine goes over the roles; ``valid`` says that it accepts
    them and ``bad_turn`` is the index of the first turn that may not stand
    where it does (null if there is none, also when only the end is missing).
    Invalid conversations are formatted like others.

    Turns are put in order of ``turn`` (nulls first), ties by role and text;
    repeated rows stay. Null texts and roles are empty ones. Turns without a
    conversation id are one conversation. Other columns are ignored. A conversation
    is one value, so it must fit a task; its turns meet in one place by nature.
    """
    this = F.struct(
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    whole = turns.groupBy(F.col(conv_id).alias(conv_id)).agg(
        F.sort_array(F.collect_list(this)).alias("turns")
    )
    moves = _lookup(
        {f"{state}\n{role}": role for state, roles in template.order.items() for role in roles}
    )
    start = F.struct(
        F.lit("").alias("state"),
        F.lit(0).cast("long").alias("seen"),
        F.lit(None).cast("long").alias("bad"),
    )

    def step(at: Column, turn: Column) -> Column:
        to = F.when(
            at["bad"].isNull(), F.element_at(moves, F.concat(at["state"], F.lit("\n"), turn["role"]))
        )
        return F.struct(
            F.coalesce(to, at["state"]).alias("state"),
            (at["seen"] + 1).alias("seen"),
            F.coalesce(at["bad"], F.when(to.isNull(), at["seen"])).alias("bad"),
        )

    def written(turn: Column) -> Column:
        head = F.concat(
            F.lit(template.opening), template.label(turn["role"]), F.lit(template.after_label)
        )
        return F.array(
            _segment(head, F.lit(False)),
            _segment(template.escape(turn["text"]), turn["role"].isin(*template.learnt)),
            _segment(F.lit(template.closing), F.lit(False)),
        )

    read = whole.select(
        conv_id,
        F.flatten(F.transform("turns", written)).alias("segments"),
        F.size("turns").cast("long").alias("n_turns"),
        F.aggregate("turns", start, step).alias("end"),
    )
    return read.select(
        conv_id,
        "segments",
        F.array_join(F.col("segments.text"), "").alias("formatted"),
        "n_turns",
        (F.col("end.bad").isNull() & F.col("end.state").isin(*template.final)).alias("valid"),
        F.col("end.bad").alias("bad_turn"),
    )


def read_turns(formatted: Column, template: Template = CHAT) -> Column:
    """The turns (role, text) that a formatted conversation holds."""
    pieces = F.split(formatted, _quoted(template.closing))
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)
    after = template.after_label

    def turn(piece: Column) -> Column:
        body = F.substr(piece, F.lit(len(template.opening) + 1))
        at = F.instr(body, after)
        return F.struct(
            template.role(F.substr(body, F.lit(1), at - 1)).alias("role"),
            template.unescape(F.substr(body, at + len(after))).alias("text"),
        )

    return F.transform(pieces, turn)


def learnt_text(segments: Column, template: Template = CHAT) -> Column:
    """All text under the loss mask, unescaped."""
    under = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(under, lambda s: template.unescape(s["text"])), "")


def _segment(text: Column, loss: Column) -> Column:
    return F.struct(text.alias("text"), loss.alias("loss"))


def _lookup(pairs: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for pair in pairs.items() for x in pair))


def _quoted(text: str) -> str:
    return "\\Q" + text + "\\E"
