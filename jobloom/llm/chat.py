"""Chat formatting: a state machine over roles and a declarative template, native expressions only."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom.functions.json import with_settled


@dataclass(frozen=True)
class ChatTemplate:
    """Markers around a turn, the roles that carry loss, and the turn order as a state machine.

    ``transitions[state][role]`` is the next state; a role without an entry leads to no state.  Both markers have to
    start with ``<|``, which is what escaping keeps out of texts.
    """

    open_mark: str = "<|im_start|>"
    close_mark: str = "<|im_end|>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    accept: tuple[str, ...] = ("assistant",)
    transitions: Mapping[str, Mapping[str, str]] = field(
        default_factory=lambda: {
            "start": {"system": "system", "user": "user"},
            "system": {"user": "user"},
            "user": {"assistant": "assistant"},
            "assistant": {"user": "user", "tool": "tool"},
            "tool": {"assistant": "assistant", "tool": "tool"},
        }
    )

    def __post_init__(self):
        for mark in (self.open_mark, self.close_mark):
            if not mark.startswith("<|"):
                raise ValueError("a mark has to start with <|")


CHATML = ChatTemplate()


def escape(text: Column) -> Column:
    r"""Takes every ``<|`` out of a text: one more backslash between ``<`` and ``|`` (``<|`` to ``<\|``, ``<\|`` to ``<\\|``)."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    r"""Undoes :func:`escape`: one backslash less between ``<`` and ``|``."""
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    r"""As :func:`escape`; line breaks and backslashes too, because a line break ends the role."""
    plain = F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    return F.regexp_replace(plain, r"<(\\*)\|", r"<\\u$1|")


def unescape_role(role: Column) -> Column:
    """Undoes :func:`escape_role`."""
    plain = F.regexp_replace(role, r"<\\u(\\*)\|", r"<$1|")
    parts = F.transform(F.split(plain, r"\\\\"), lambda p: F.replace(p, F.lit("\\n"), F.lit("\n")))
    return F.array_join(parts, "\\")


def _final_state(turns: Column, template: ChatTemplate) -> Column:
    """State after all turns; null once a role has no transition."""
    pairs = [
        (F.lit(f"{state}\n{role}"), F.lit(after))
        for state, row in template.transitions.items()
        for role, after in row.items()
    ]
    table = F.create_map(*[x for pair in pairs for x in pair])
    step = lambda state, turn: F.try_element_at(table, F.concat(state, F.lit("\n"), turn["role"]))
    return F.aggregate(turns, F.lit(template.start), step)


def format_chats(
    conversations: DataFrame,
    *,
    template: ChatTemplate = CHATML,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per conversation: its id, ``valid``, ``segments`` (text, loss) and ``formatted``, all segments joined.

    Turns stand in ascending turn order, a null turn first; equal turns by role, then text, and repeated rows stay.
    Null text and null role count as empty.  A conversation with an impossible turn order is formatted like any other
    and has ``valid`` false; leaving it out is the caller's choice.  Rows with a null id form one conversation.  Each
    turn gives three segments (header, text, end); only the text of a loss role has ``loss`` true.  An empty table
    gives an empty result; other columns are not read.

    Turns are gathered per conversation, which is the size of the row that has to come out; there is no other shuffle.
    """
    turn = F.struct(
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    chats = conversations.groupBy(F.col(id_col)).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    parts = F.flatten(
        F.transform(
            "turns",
            lambda t: F.array(
                F.struct(
                    F.concat(F.lit(template.open_mark), escape_role(t["role"]), F.lit("\n")).alias("text"),
                    F.lit(False).alias("loss"),
                ),
                F.struct(escape(t["text"]).alias("text"), t["role"].isin(*template.loss_roles).alias("loss")),
                F.struct(F.lit(template.close_mark).alias("text"), F.lit(False).alias("loss")),
            ),
        )
    )
    chats = with_settled(
        chats,
        {"valid": F.coalesce(_final_state(F.col("turns"), template).isin(*template.accept), F.lit(False)), "segments": parts},
    )
    return chats.select(id_col, "valid", "segments", F.array_join(F.col("segments.text"), "").alias("formatted"))


def read_turns(formatted: Column, template: ChatTemplate = CHATML) -> Column:
    """The turns (role, text) of a formatted conversation, escapes undone."""
    blocks = F.split(formatted, r"\Q" + template.open_mark + r"\E")
    blocks = F.slice(blocks, F.lit(2), F.size(blocks))

    def turn(block: Column) -> Column:
        end = F.locate("\n", block)
        body = F.substr(block, end + 1, F.length(block) - end - len(template.close_mark))
        return F.struct(unescape_role(F.substr(block, F.lit(1), end - 1)).alias("role"), unescape(body).alias("text"))

    return F.transform(blocks, turn)


def read_loss_text(segments: Column) -> Column:
    """All text under the loss mask, escapes undone, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
