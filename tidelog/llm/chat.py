"""Chat formatting: a state machine over roles and a declarative template.

All steps are column expressions.  The template names the marks around a turn,
the roles under the loss, and the transitions between roles; the machine is a
fold over the sorted turns of a conversation.

Escaping puts the escape character inside every control string, so that no
control string survives in a text, and doubles the escape character itself.
One pass that drops the escape character before any character undoes both.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ESCAPE = "\\"


@dataclass(frozen=True)
class Template:
    """``open`` role ``middle`` text ``close``, once per turn.

    ``hide`` lists the control strings to break up in texts and roles, as
    (string, place of the escape character).
    """

    open: str = "### "
    middle: str = ": "
    close: str = "</turn>\n"
    hide: Sequence[tuple[str, int]] = (("</turn>", 1), ("##", 1))
    loss: Sequence[str] = ("assistant",)
    start: str = "start"
    accept: Sequence[str] = ("assistant",)
    follows: Mapping[str, Sequence[str]] = field(default_factory=lambda: {
        "start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})


def escaped(text: Column, template: Template, extra: Sequence[tuple[str, int]] = ()) -> Column:
    out = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
    for mark, at in [*template.hide, *extra]:
        out = F.replace(out, F.lit(mark), F.lit(mark[:at] + ESCAPE + mark[at:]))
    return out


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _quoted(text: str) -> str:
    return r"\Q" + text + r"\E"


def conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation with its turns in order.

    A conversation is one training text, so its turns meet in one row; rows of
    one conversation are ordered by turn, role and text, nulls first, which
    settles ties.
    """
    turn = F.struct("turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                    F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return (turns.select("conv_id", turn.alias("one")).groupBy("conv_id")
            .agg(F.sort_array(F.collect_list("one")).alias("turns")))


def machine(turns: Column, template: Template) -> Column:
    """Fold the transitions over the turns: final state and first bad position."""
    edges = [F.lit(f"{state}\n{role}") for state, roles in template.follows.items() for role in roles]
    legal = F.array(*edges)

    def step(at: Column, turn: Column) -> Column:
        fits = at["bad"].isNull() & F.array_contains(legal, F.concat_ws("\n", at["state"], turn["role"]))
        return F.struct(F.when(fits, turn["role"]).otherwise(F.lit("error")).alias("state"),
                        (at["seen"] + 1).alias("seen"),
                        F.when(fits, F.lit(None).cast("int")).otherwise(F.coalesce(at["bad"], at["seen"])).alias("bad"))

    zero = F.struct(F.lit(template.start).alias("state"), F.lit(0).alias("seen"), F.lit(None).cast("int").alias("bad"))
    return F.aggregate(turns, zero, step)


def format_chats(turns: DataFrame, template: Template | None = None) -> DataFrame:
    """Formatted text, loss segments and validity of every conversation.

    ``turns`` needs ``conv_id, turn, role, text``; other columns are ignored.
    Null roles and texts are empty, a null ``conv_id`` is one conversation,
    repeated rows are repeated turns, and an empty table gives an empty result.
    Invalid turn order is reported, not dropped.

    Result: ``conv_id``, ``segments`` (array of text and loss flag, in order; the
    formatted text is their concatenation), ``formatted``, ``valid`` and
    ``bad_turn`` (position of the first turn the machine refuses, or the number
    of turns if the conversation only ends too early; null when valid).
    """
    t = template or Template()

    def segments(turn: Column) -> Column:
        head = F.concat(F.lit(t.open), escaped(turn["role"], t, [(t.middle, 1)]), F.lit(t.middle))
        return F.array(F.struct(head.alias("text"), F.lit(False).alias("loss")),
                       F.struct(escaped(turn["text"], t).alias("text"),
                                turn["role"].isin(list(t.loss)).alias("loss")),
                       F.struct(F.lit(t.close).alias("text"), F.lit(False).alias("loss")))

    chats = conversations(turns).select(
        "conv_id", F.flatten(F.transform("turns", segments)).alias("segments"),
        machine(F.col("turns"), t).alias("end"))
    valid = F.col("end.bad").isNull() & F.col("end.state").isin(list(t.accept))
    return chats.select(
        "conv_id", "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        valid.alias("valid"),
        F.when(~valid, F.coalesce("end.bad", "end.seen")).alias("bad_turn"))


def read_turns(formatted: Column, template: Template | None = None) -> Column:
    """The turns (role, text) that a formatted text holds, unescaped."""
    t = template or Template()
    # Every turn ends with the closing mark, so what follows the last one is empty.
    pieces = F.split(formatted, _quoted(t.close))
    whole = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        body = F.substring(piece, F.lit(len(t.open) + 1), F.char_length(piece))
        cut = F.locate(t.middle, body)
        return F.struct(unescaped(F.substring(body, F.lit(1), cut - 1)).alias("role"),
                        unescaped(F.substring(body, cut + len(t.middle), F.char_length(body))).alias("text"))

    return F.transform(whole, turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing in between."""
    under = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(under, lambda s: unescaped(s["text"])), "")
