"""Chat formatting in DataFrame expressions: a finite-state machine over roles, segments with loss flags, and back.

A declarative template says what stands before and after a turn and which roles carry loss. Control strings inside
texts and roles are escaped so that they cannot end or start a turn, and the escapes are undone without loss.

Defined results: a null text or role counts as empty; rows of one conversation with equal turns are ordered by role
and text; a null turn sorts first; a null conv_id is a conversation of its own; roles outside the machine make the
order invalid (``valid`` false, ``error_turn`` its position from 0) but are formatted all the same; texts of any length
stay whole, and a conversation is one row, so its turns must fit in a task; an empty table gives an empty result; extra
columns, whatever their names, are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chosen


@dataclass(frozen=True)
class Template:
    """Text around turns, roles with loss, and the machine that turn order must follow: state -> role -> state."""

    start: str = "<|im_start|>"
    after_role: str = "\n"
    end: str = "<|im_end|>\n"
    control: str = "<|"
    loss_roles: tuple[str, ...] = ("assistant",)
    first_state: str = "begin"
    final_states: tuple[str, ...] = ("answered",)
    transitions: dict = field(
        default_factory=lambda: {
            "begin": {"system": "opened", "user": "asked"},
            "opened": {"user": "asked"},
            "asked": {"assistant": "answered"},
            "answered": {"user": "asked", "tool": "asked"},
        }
    )


CHATML = Template()


def escape(text: Column, template: Template = CHATML) -> Column:
    """Every backslash becomes backslash-b, a control opening gets a backslash after its first character, and a line
    feed (in roles only) is written by ``escape_role``; so each backslash in the output starts exactly one escape."""
    c = template.control
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit(c), F.lit(c[0] + "\\" + c[1:]))


def unescape(text: Column, template: Template = CHATML) -> Column:
    c = template.control
    return F.replace(F.replace(text, F.lit(c[0] + "\\" + c[1:]), F.lit(c)), F.lit("\\b"), F.lit("\\"))


def escape_role(role: Column, template: Template = CHATML) -> Column:
    return F.replace(escape(role, template), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column, template: Template = CHATML) -> Column:
    return unescape(F.replace(role, F.lit("\\n"), F.lit("\n")), template)


def role_machine(roles: Column, template: Template = CHATML) -> Column:
    """Struct of the state after all roles ('' once a role had no transition) and the position of the first bad role."""
    pairs = [(f"{s} {r}", t) for s, by in template.transitions.items() for r, t in by.items()]
    moves = F.create_map(*[F.lit(x) for pair in pairs for x in pair])
    start = F.struct(F.lit(template.first_state).alias("state"), F.lit(-1).alias("bad"), F.lit(0).alias("at"))

    def step(acc: Column, role: Column) -> Column:
        state = F.coalesce(F.try_element_at(moves, F.concat(acc["state"], F.lit(" "), role)), F.lit(""))
        bad = F.when((acc["bad"] < 0) & (state == ""), acc["at"]).otherwise(acc["bad"])
        return F.struct(state.alias("state"), bad.alias("bad"), (acc["at"] + 1).alias("at"))

    return F.aggregate(roles, start, step)


def format_chats(turns: DataFrame, template: Template = CHATML) -> DataFrame:
    """conv_id, segments (array of text and loss flag), valid, error_turn from rows of conv_id, turn, role, text."""
    rows = chosen(turns, "conv_id", "turn", "role", "text").select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    chats = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    # nulls sort first in a struct's order, so a null turn leads

    def segments(t: Column) -> Column:
        head = F.concat(F.lit(template.start), escape_role(t["role"], template), F.lit(template.after_role))
        part = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
        return F.array(part(head, F.lit(False)), part(escape(t["text"], template), t["role"].isin(*template.loss_roles)), part(F.lit(template.end), F.lit(False)))

    state = role_machine(F.transform("turns", lambda t: t["role"]), template)
    out = chats.select("conv_id", F.flatten(F.transform("turns", segments)).alias("segments"), state.alias("machine"))
    valid = (F.col("machine.bad") < 0) & F.col("machine.state").isin(*template.final_states)
    return out.select("conv_id", "segments", valid.alias("valid"), F.when(F.col("machine.bad") >= 0, F.col("machine.bad")).alias("error_turn"))


def read_chats(formatted: DataFrame, template: Template = CHATML) -> DataFrame:
    """conv_id, turns (array of role and text), loss_text, formatted: all read back from the segments."""
    whole = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"], template)), "")
    cut = F.split(F.col("formatted"), r"\Q" + template.start + r"\E")

    def turn(x: Column) -> Column:
        at = F.instr(x, template.after_role)
        body = F.substr(x, at + len(template.after_role), F.length(x) - at - len(template.after_role) - len(template.end) + 1)
        return F.struct(unescape_role(F.left(x, at - 1), template).alias("role"), unescape(body, template).alias("text"))

    df = formatted.select("conv_id", *[c for c in ("valid", "error_turn") if c in formatted.columns], whole.alias("formatted"), loss.alias("loss_text"))
    return df.withColumn("turns", F.transform(F.slice(cut, 2, F.greatest(F.size(cut) - 1, F.lit(0))), turn))
