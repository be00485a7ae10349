"""Conversations as training text, by a reversible template and column expressions alone."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablevault.functions.columns import column
from tablevault.llm.common import text_or_empty

_ESCAPE = "\\"


@dataclass(frozen=True)
class Template:
    """Control strings of a chat format, and the roles whose texts are learned.

    A conversation is `start` and its blocks; a block is `open`, a role, `close`, the texts
    of neighbouring turns of that role with `between` between them, and `end`.
    """

    start: str = "<s>"
    open: str = "[INST]"
    close: str = "[/INST]"
    between: str = "[SEP]"
    end: str = "</s>"
    learned: tuple[str, ...] = ("assistant",)

    def __post_init__(self) -> None:
        firsts = {c[:1] for c in self.controls}
        for control in self.controls:
            if len(control) < 2 or _ESCAPE in control or any(f in control[1:] for f in firsts):
                raise ValueError(f"unusable control string: {control!r}")
        if len(set(self.controls)) < len(self.controls):
            raise ValueError("control strings must differ")

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.start, self.open, self.close, self.between, self.end)

    def escaped(self, text: Column) -> Column:
        """`text` without control strings: a backslash stands behind their first characters.

        Backslashes of the text are doubled. Control strings hold none and begin with
        characters they have nowhere else, so none can arise where pieces meet.
        """
        parts = [f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in self.controls]
        doubled = F.replace(text, F.lit(_ESCAPE), F.lit(2 * _ESCAPE))
        return F.regexp_replace(doubled, "|".join(parts), r"$0\\")

    @staticmethod
    def unescaped(text: Column) -> Column:
        return F.regexp_replace(text, r"\\(\\)?", "$1")


def _literal(text: str) -> str:
    """A pattern that matches `text` and nothing else."""
    return f"\\Q{text}\\E"


def _blocks(turns: Column) -> Column:
    """Sorted turns as blocks: neighbours of the same role become one, their texts in order."""
    empty = F.array().cast("array<struct<role:string,texts:array<string>>>")

    def block(turn: Column, texts: Column) -> Column:
        return F.array(F.struct(turn["role"].alias("role"), texts.alias("texts")))

    def step(done: Column, turn: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        joined = F.concat(
            F.slice(done, 1, F.size(done) - 1),
            block(turn, F.concat(last["texts"], F.array(turn["text"]))),
        )
        fresh = F.concat(done, block(turn, F.array(turn["text"])))
        return F.when(last["role"] == turn["role"], joined).otherwise(fresh)

    return F.aggregate(turns, empty, step)


def format_chat(
    rows: DataFrame,
    template: Template = Template(),
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per conversation: the id, `formatted`, and `loss`.

    Turns are sorted, neighbouring turns of one role are merged into a block, and all is
    put together by the template. `loss` lists the stretches (start, end: bytes of
    `formatted` in UTF-8) that hold texts of learned roles, one for each text, without
    control strings.

    Defined cases: NULL roles and texts count as empty; NULL turn numbers come first; rows
    of the same turn number are ordered by escaped role and text, and repeated rows are
    turns of their own; rows with a NULL id make up one conversation; an empty table gives
    no rows; other columns are not read. A conversation ends up in one row, so it must fit
    into one (2 GB, a limit of Spark); its rows are put together in each task before they
    are shuffled.
    """
    turns = rows.select(
        column(id_col).alias("id"),
        F.struct(
            column(turn_col).alias("turn"),
            template.escaped(text_or_empty(role_col)).alias("role"),
            template.escaped(text_or_empty(text_col)).alias("text"),
        ).alias("one"),
    )
    sorted_turns = turns.groupBy("id").agg(F.array_sort(F.collect_list("one")).alias("turns"))
    learned = [_escaped_text(role, template) for role in template.learned]

    def piece(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def fixed(text: Column) -> Column:
        return piece(text, F.lit(False))

    def pieces(block: Column) -> Column:
        head = F.concat(F.lit(template.open), block["role"], F.lit(template.close))
        loss = block["role"].isin(*learned)
        texts = F.transform(
            block["texts"],
            lambda text, i: F.array(
                fixed(F.when(i == 0, head).otherwise(F.lit(template.between))), piece(text, loss)
            ),
        )
        return F.concat(F.flatten(texts), F.array(fixed(F.lit(template.end))))

    blocks = sorted_turns.select("id", _blocks(F.col("turns")).alias("blocks"))
    split = blocks.select(
        "id",
        F.concat(
            F.array(fixed(F.lit(template.start))), F.flatten(F.transform("blocks", pieces))
        ).alias("pieces"),
    )
    none = F.array().cast("array<struct<start:int,end:int>>")

    def walk(state: Column, p: Column) -> Column:
        end = state["at"] + F.octet_length(p["text"])
        span = F.array(F.struct(state["at"].alias("start"), end.alias("end")))
        spans = F.when(p["loss"], F.concat(state["spans"], span)).otherwise(state["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    start = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    return split.select(
        F.col("id").alias(id_col),
        F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("formatted"),
        F.aggregate("pieces", start, walk, lambda state: state["spans"]).alias("loss"),
    )


def _escaped_text(text: str, template: Template) -> str:
    """What `Template.escaped` makes of a constant."""
    text = text.replace(_ESCAPE, 2 * _ESCAPE)
    for control in template.controls:
        text = text.replace(control, control[0] + _ESCAPE + control[1:])
    return text


def read_chat(
    chats: DataFrame, template: Template = Template(), formatted_col: str = "formatted",
    loss_col: str = "loss",
) -> DataFrame:
    """Add `turns` (role, text) and `learned`, the texts under the loss mask, as they were.

    A text that does not begin with `start`, or whose last block is not ended, gives NULL
    turns; a NULL mask gives NULL.
    """
    formatted = column(formatted_col)
    whole = formatted.startswith(template.start) & (
        formatted.endswith(template.end) | (formatted == template.start)
    )
    body = F.substring(formatted, F.lit(len(template.start) + 1), F.length(formatted))
    blocks = F.split(body, _literal(template.end), -1)

    def turns(block: Column) -> Column:
        parts = F.split(block, _literal(template.close), 2)
        role = F.substring(parts[0], F.lit(len(template.open) + 1), F.length(parts[0]))
        return F.transform(
            F.split(parts[1], _literal(template.between), -1),
            lambda text: F.struct(
                template.unescaped(role).alias("role"), template.unescaped(text).alias("text")
            ),
        )

    read = F.flatten(F.transform(F.slice(blocks, 1, F.size(blocks) - 1), turns))
    data = formatted.cast("binary")
    learned = F.transform(
        column(loss_col),
        lambda s: template.unescaped(
            F.substring(data, s["start"] + 1, s["end"] - s["start"]).cast("string")
        ),
    )
    return chats.withColumns({"turns": F.when(whole, read), "learned": learned})
