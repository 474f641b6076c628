"""Chat formatting: a role state machine and a declarative template.

``format_conversations`` turns the rows of a conversation table (one row per
turn) into one row per conversation with the list of text segments and a loss
flag for each. Everything is built-in DataFrame functions; one shuffle by
conversation.

Defined results for odd input:

* null text or null role: the empty string; null turn: sorts first;
* turns with the same number: ordered by role, then text;
* null conversation id: the rows with no id form one conversation;
* a role outside the machine, or roles out of order: all segments are still
  emitted, ``valid`` is false and ``end_state`` is ``error``;
* an empty table gives no rows; other columns are ignored.

A conversation is one output row, so its text must fit in a row (2 GB).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERROR = "error"


@dataclass(frozen=True)
class ChatTemplate:
    """Marks around a turn, the roles under the loss mask, and the machine."""

    open: str = "<|im_start|>"
    close: str = "<|im_end|>"
    after_role: str = "\n"
    after_turn: str = "\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    accepting: tuple[str, ...] = ("assistant",)
    moves: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "start": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )


CHATML = ChatTemplate()


def escape(text: Column) -> Column:
    """``<|`` cannot occur in the result: one backslash goes between ``<`` and
    the backslashes and bar that follow it. ``unescape`` takes it out."""
    return F.regexp_replace(text, r"<(\\*+)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*+)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """A role holds no line break and no mark once escaped."""
    doubled = F.replace(role, F.lit("\\"), F.lit("\\\\"))
    return escape(F.replace(doubled, F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    parts = F.split(unescape(role), r"\\\\", -1)
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def end_state(turns: Column, template: ChatTemplate) -> Column:
    """Run the machine over ``turns`` (an array of structs with ``role``)."""
    moves = [F.lit(x) for state, roles in template.moves.items() for role in roles for x in (f"{state}\n{role}", role)]
    table = F.create_map(*moves)
    step = lambda state, t: F.coalesce(F.try_element_at(table, F.concat(state, F.lit("\n"), t["role"])), F.lit(ERROR))
    return F.aggregate(turns, F.lit(template.start), step)


def format_conversations(conversations: DataFrame, template: ChatTemplate = CHATML) -> DataFrame:
    """One row per conversation: ``conv_id``, ``segments`` (array of struct
    ``text, loss`` in output order), ``end_state`` and ``valid``.

    Concatenating the segment texts gives the formatted conversation. A turn
    is three segments: its opening mark with the role, its escaped text, and
    its closing mark; only the text of a loss role is flagged.
    """
    clean = conversations.select(
        "conv_id",
        F.struct(
            F.col("turn").alias("turn"),
            F.coalesce(F.col("role"), F.lit("")).alias("role"),
            F.coalesce(F.col("text"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    turns = clean.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def pieces(t: Column) -> Column:
        seg = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
        head = F.concat(F.lit(template.open), escape_role(t["role"]), F.lit(template.after_role))
        return F.array(
            seg(head, F.lit(False)),
            seg(escape(t["text"]), t["role"].isin(*template.loss_roles)),
            seg(F.lit(template.close + template.after_turn), F.lit(False)),
        )

    return turns.select(
        "conv_id",
        F.flatten(F.transform("turns", pieces)).alias("segments"),
        end_state(F.col("turns"), template).alias("end_state"),
    ).withColumn("valid", F.col("end_state").isin(*template.accepting))


def formatted_text(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def loss_text(segments: Column) -> Column:
    """The unescaped text under the loss mask, nothing in between."""
    kept = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(kept, lambda s: unescape(s["text"])), "")


def parse_turns(formatted: Column, template: ChatTemplate = CHATML) -> Column:
    """Read a formatted conversation back: array of struct ``role, text``."""
    close = template.close + template.after_turn
    parts = F.split(formatted, "\\Q" + template.open + "\\E", -1)
    blocks = F.slice(parts, F.lit(2), F.size(parts) - 1)

    def turn(block: Column) -> Column:
        role = F.substring_index(block, template.after_role, 1)
        skip = F.length(role) + len(template.after_role)
        body = F.substring(block, skip + 1, F.length(block) - skip - len(close))
        return F.struct(unescape_role(role).alias("role"), unescape(body).alias("text"))

    return F.transform(blocks, turn)
