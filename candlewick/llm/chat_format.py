"""Chat formatting: turns in order, a declarative template, a state machine over
the roles and per-segment loss flags.  DataFrame functions only.

A conversation is one array of its turns (one row per conversation, as long as
its turns); every step is a higher-order function over that array.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Marks:
    """What stands before and after a turn's text, and whether the text is learnt."""
    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Marks per role; any other role is written as ``other`` with its name inside.

    ``escape`` starts every escape.  It and the first character of every mark
    are replaced inside texts (``&`` by ``&amp;``, ``[`` by ``&#91;`` and so
    on), so no mark can occur there and reading back is exact."""
    roles: dict[str, Marks] = field(default_factory=lambda: {
        "system": Marks("[SYS]", "[/SYS]\n"),
        "user": Marks("[INST]", "[/INST]\n"),
        "assistant": Marks("<s>", "</s>\n", loss=True)})
    other: Marks = Marks("[ROLE]", "[/ROLE]\n")
    other_name_end: str = "[:]"
    escape: str = "&"

    def marks(self) -> list[str]:
        own = [m for r in (*self.roles.values(), self.other) for m in (r.open, r.close)]
        return [*own, self.other_name_end]

    def starts(self) -> str:
        return "".join(sorted({m[0] for m in self.marks()}))

    def escapes(self) -> list[tuple[str, str]]:
        return [(self.escape, f"{self.escape}amp;"), *((c, f"{self.escape}#{ord(c)};") for c in self.starts())]


#: state, role -> next state; anything else is an error
TURN_ORDER = {
    ("start", "system"): "system", ("start", "user"): "user", ("system", "user"): "user",
    ("user", "assistant"): "assistant", ("assistant", "user"): "user"}
ENDS = ("assistant",)


def _escaped(text: Column, template: Template) -> Column:
    for plain, coded in template.escapes():
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def _unescaped(text: Column, template: Template) -> Column:
    for plain, coded in reversed(template.escapes()):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def _by_role(role: Column, template: Template, value, other) -> Column:
    out = None
    for name, marks in template.roles.items():
        out = F.when(role == name, value(marks)) if out is None else out.when(role == name, value(marks))
    return other if out is None else out.otherwise(other)


def conversations_in_order(rows: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn",
                           role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``(conv_id, turns array<struct<turn, role, text>>)``: by turn, ties by role and text."""
    turn = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.groupBy(F.col(conv_col).alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def turn_state(turns: Column) -> Column:
    """The machine's last state over ``turns``: ``valid`` and ``first_error`` (0-based
    turn, -1 if the turns are in order but end in a state where none may end)."""
    table = F.create_map(*[F.lit(x) for (state, role), then in TURN_ORDER.items() for x in (f"{state}>{role}", then)])

    def step(acc, turn):
        then = F.try_element_at(table, F.concat(acc["state"], F.lit(">"), turn["role"]))
        ok = acc["error"].isNull() & then.isNotNull()
        return F.struct(F.when(ok, then).otherwise(acc["state"]).alias("state"), (acc["at"] + 1).alias("at"),
                        F.when(acc["error"].isNull() & then.isNull(), acc["at"]).otherwise(acc["error"]).alias("error"))

    first = F.struct(F.lit("start").alias("state"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("error"))
    end = F.aggregate(turns, first, step)
    error = F.coalesce(end["error"], F.when(~end["state"].isin(*ENDS), F.lit(-1)))
    return F.struct(error.isNull().alias("valid"), error.alias("first_error"))


def chat_segments(rows: DataFrame, template: Template | None = None, **columns: str) -> DataFrame:
    """``(conv_id, segments array<struct<text, loss>>, valid, first_error)``.

    Three segments a turn: mark, escaped text, mark; only texts of roles with
    ``loss`` carry the flag.  Conversations whose turns are out of order are
    formatted all the same and marked.  NULL roles and texts are empty strings,
    a NULL conv_id is a conversation of its own, repeated rows are turns of
    their own, an empty table gives no row, and other columns are not read."""
    template = template or Template()

    def segments(turn):
        role, text = turn["role"], turn["text"]
        named = F.concat(F.lit(template.other.open), _escaped(role, template), F.lit(template.other_name_end))
        begin = _by_role(role, template, lambda m: F.lit(m.open), named)
        close = _by_role(role, template, lambda m: F.lit(m.close), F.lit(template.other.close))
        loss = _by_role(role, template, lambda m: F.lit(m.loss), F.lit(template.other.loss))
        return F.array(F.struct(begin.alias("text"), F.lit(False).alias("loss")),
                       F.struct(_escaped(text, template).alias("text"), loss.alias("loss")),
                       F.struct(close.alias("text"), F.lit(False).alias("loss")))

    found = conversations_in_order(rows, **columns)
    return found.select("conv_id", F.flatten(F.transform("turns", segments)).alias("segments"),
                        turn_state(F.col("turns")).alias("state")).select("conv_id", "segments", "state.*")


def format_chat(rows: DataFrame, template: Template | None = None, **columns: str) -> DataFrame:
    """``(conv_id, formatted, loss_spans array<struct<start, length>>, valid, first_error)``.

    ``formatted`` is the segments in order, ``loss_spans`` the code points
    (0-based start) of it that the loss covers."""
    def step(acc, segment):
        size = F.length(segment["text"]).cast("long")
        return F.struct((acc["at"] + size).alias("at"), F.when(
            segment["loss"], F.concat(acc["spans"], F.array(F.struct(acc["at"].alias("start"), size.alias("length")))))
            .otherwise(acc["spans"]).alias("spans"))

    first = F.struct(F.lit(0).cast("long").alias("at"),
                     F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))
    return chat_segments(rows, template, **columns).select(
        "conv_id", F.concat_ws("", F.transform("segments", lambda s: s["text"])).alias("formatted"),
        F.aggregate("segments", first, step, lambda a: a["spans"]).alias("loss_spans"), "valid", "first_error")


def read_turns(formatted: Column, template: Template | None = None) -> Column:
    """The turns ``array<struct<role, text>>`` of a formatted conversation."""
    template = template or Template()
    quoted = "[^" + re.escape(template.starts()) + "]*"
    opens = [re.escape(m.open) for m in template.roles.values()]
    opens.append(re.escape(template.other.open) + quoted + re.escape(template.other_name_end))
    found = F.regexp_extract_all(formatted, F.lit(f"(?:{'|'.join(opens)}){quoted}"), F.lit(0))

    def turn(piece):
        def rest(size):
            return F.substring(piece, F.lit(size + 1), F.length(piece))

        body = F.split(rest(len(template.other.open)), re.escape(template.other_name_end), 2)
        out = F.struct(_unescaped(body[0], template).alias("role"), _unescaped(body[1], template).alias("text"))
        for name, marks in template.roles.items():
            own = F.struct(F.lit(name).alias("role"), _unescaped(rest(len(marks.open)), template).alias("text"))
            out = F.when(piece.startswith(marks.open), own).otherwise(out)
        return out

    return F.transform(found, turn)


def read_loss(formatted: Column, spans: Column, template: Template | None = None) -> Column:
    """All text under the loss mask, unescaped, in order."""
    def text(span):
        return F.substring(formatted, (span["start"] + 1).cast("int"), span["length"].cast("int"))
    return _unescaped(F.concat_ws("", F.transform(spans, text)), template or Template())
