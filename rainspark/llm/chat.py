"""Format conversations from a declarative template, with loss flags by segment, in DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _turns() -> dict[str, dict[str, str]]:
    return {
        "start": {"system": "system", "user": "user"},
        "system": {"user": "user"},
        "user": {"assistant": "assistant"},
        "assistant": {"user": "user"},
    }


@dataclass(frozen=True)
class Template:
    """How a turn is written, which roles are trained on, and which role may follow which.

    open and close are the control strings; `states` maps a state to the roles it admits and the states they lead to.
    `escapes` maps each character that could form a control string to the letter that stands for it after a
    backslash, so that a control character never occurs in an escaped text.
    """

    open: str = "### "
    colon: str = ": "
    close: str = " </turn>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    accept: tuple[str, ...] = ("assistant",)
    states: dict[str, dict[str, str]] = field(default_factory=_turns)
    escapes: tuple[tuple[str, str], ...] = (("\\", "b"), ("#", "h"), ("<", "l"), (":", "c"))


def escape(text: Column, template: Template) -> Column:
    """Write the backslash first, then the other control characters, as backslash and letter."""
    for char, letter in template.escapes:
        text = F.replace(text, F.lit(char), F.lit("\\" + letter))
    return text


def unescape(text: Column, template: Template) -> Column:
    """Undo escape(). Every backslash starts a pair, so the pairs can be read back in the opposite order."""
    for char, letter in reversed(template.escapes):
        text = F.replace(text, F.lit("\\" + letter), F.lit(char))
    return text


def final_state(roles: Column, template: Template) -> Column:
    """Run the finite-state machine over an array of roles; 'error' once a role isn't admitted."""
    moves = [
        x
        for state, admitted in template.states.items()
        for role, to in admitted.items()
        for x in (F.lit(f"{state}\n{role}"), F.lit(to))
    ]
    table = F.create_map(*moves)
    return F.aggregate(
        roles,
        F.lit(template.start),
        lambda state, role: F.coalesce(F.try_element_at(table, F.concat(state, F.lit("\n"), role)), F.lit("error")),
    )


def format_conversations(
    df: DataFrame,
    template: Template | None = None,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """conv_id, segments (array of text and loss), valid and formatted, a row for each conversation.

    Turns are ordered by turn, then role and text, so ties have one order; repeated rows stay. A null role or text is
    empty, a null turn comes first and a null conversation is one of its own. Conversations whose roles break the
    order are formatted all the same, with valid = false. A conversation is a unit: its text is one string.
    """
    t = template or Template()
    turn = F.struct(
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    turns = df.groupBy(F.col(conv_col).alias("conv_id")).agg(F.array_sort(F.collect_list(turn)).alias("turns"))

    def written(x: Column) -> Column:
        return F.array(
            F.struct(F.concat(F.lit(t.open), escape(x["role"], t), F.lit(t.colon)).alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(x["text"], t).alias("text"), x["role"].isin(*t.loss_roles).alias("loss")),
            F.struct(F.lit(t.close).alias("text"), F.lit(False).alias("loss")),
        )

    state = final_state(F.transform("turns", lambda x: x["role"]), t)
    out = turns.select(
        "conv_id", F.flatten(F.transform("turns", written)).alias("segments"), state.isin(*t.accept).alias("valid")
    )
    return out.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_turns(formatted: Column, template: Template | None = None) -> Column:
    """Read the turns (array of role and text) back from a formatted conversation.

    Close and open never occur in an escaped text, so splitting at them is exact.
    """
    t = template or Template()
    body = F.substring(formatted, F.lit(len(t.open) + 1), F.length(formatted) - len(t.open) - len(t.close))
    parts = F.when(F.length(formatted) > 0, F.split(body, _quoted(t.close + t.open), -1)).otherwise(F.array())

    def turn(part: Column) -> Column:
        at = F.locate(t.colon, part)
        return F.struct(
            unescape(F.substring(part, F.lit(1), at - 1), t).alias("role"),
            unescape(F.substring(part, at + len(t.colon), F.length(part)), t).alias("text"),
        )

    return F.transform(parts, turn)


def read_loss(segments: Column, template: Template | None = None) -> Column:
    """The text under the loss mask, in order, unescaped."""
    picked = F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: s["text"])
    return unescape(F.array_join(picked, ""), template or Template())


def _quoted(text: str) -> str:
    return "\\Q" + text + "\\E"
