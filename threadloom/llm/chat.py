"""Conversations in a turn-marking template, with a grammar that reads every output back.

    conversation := turn*        turn := "<s>" ["~"] "[INST]" role "[/INST]" text "</s>"

The parser is deterministic: it cuts at "</s>" and takes the shortest role. A turn is first rendered as it is and parsed
again; if the parser does not give back the same role and text, it is rendered with "~", and "&", "<" and "[" of role
and text written as "&amp;", "&lt;" and "&lsqb;", which leaves no control string in them and is undone in the reverse
order. The joined output is parsed as a whole and held against the source; a difference stops the job, it is never
written. Everything is a DataFrame expression; rows meet once, by conversation.

Turns go by number; equal numbers by role, then text; null numbers first. Null roles and texts count as empty. Rows with
a null conv_id form one conversation. A conversation's rows come together in one task, since its output is one string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE, ROLE, BODY, ESCAPED = "<s>", "</s>", "[INST]", "[/INST]", "~"
_ENTITIES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lsqb;"))
_TURN = r"(?s)^<s>(~?)\[INST\](.*?)\[/INST\](.*)$"


def escape(text: Column) -> Column:
    for plain, entity in _ENTITIES:
        text = F.replace(text, F.lit(plain), F.lit(entity))
    return text


def unescape(text: Column) -> Column:
    for plain, entity in reversed(_ENTITIES):
        text = F.replace(text, F.lit(entity), F.lit(plain))
    return text


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN + ROLE), role, F.lit(BODY), text, F.lit(CLOSE))


def render_escaped(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN + ESCAPED + ROLE), escape(role), F.lit(BODY), escape(text), F.lit(CLOSE))


def parse(formatted: Column) -> Column:
    """array<struct<role, text>>, or null where the string is not of the grammar."""
    parts = F.split(formatted, CLOSE)
    heads = F.slice(parts, F.lit(1), F.size(parts) - 1)

    def turn(part: Column) -> Column:
        role, text = (F.regexp_extract(part, _TURN, k) for k in (2, 3))
        undo = F.regexp_extract(part, _TURN, 1) == ESCAPED
        return F.struct(
            F.when(undo, unescape(role)).otherwise(role).alias("role"),
            F.when(undo, unescape(text)).otherwise(text).alias("text"),
        )

    fits = F.forall(heads, lambda p: F.rlike(p, F.lit(_TURN))) & (F.element_at(parts, -1) == "")
    return F.when(fits, F.transform(heads, turn))


def format_conversations(rows: DataFrame, learn: str = "assistant") -> DataFrame:
    """Table (conv_id, formatted, turns, loss): the source's turns, and spans (start, length, escaped) of `learn` texts.

    Starts count code points from 1. Spans cover the texts as they stand in `formatted`.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    plain = render(F.col("role"), F.col("text"))
    source = F.array(F.struct("role", "text"))
    rows = rows.withColumn("escaped", ~F.coalesce(parse(plain) == source, F.lit(False)))
    rows = rows.withColumn("out", F.when(F.col("escaped"), render_escaped(F.col("role"), F.col("text"))).otherwise(plain))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = rows.withColumn("nth", F.row_number().over(order)).withColumn(
        "end", F.sum(F.length("out")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    inside = F.when(F.col("escaped"), escape(F.col("text"))).otherwise(F.col("text"))
    length = F.length(inside).cast("long")
    start = F.col("end") - F.lit(len(CLOSE)) - length + 1
    span = F.struct(start.alias("start"), length.alias("length"), "escaped")
    turns = F.array_sort(F.collect_list(F.struct("nth", "role", "text", "out", F.when(F.col("role") == learn, span).alias("span"))))
    out = rows.groupBy("conv_id").agg(turns.alias("rows"))
    out = out.select(
        "conv_id",
        F.array_join(F.transform("rows", lambda r: r["out"]), "").alias("formatted"),
        F.transform("rows", lambda r: F.struct(r["role"].alias("role"), r["text"].alias("text"))).alias("turns"),
        F.filter(F.transform("rows", lambda r: r["span"]), lambda x: x.isNotNull()).alias("loss"),
    )
    same = F.coalesce(parse(F.col("formatted")) == F.col("turns"), F.lit(False))
    return out.withColumn(
        "formatted", F.when(same, F.col("formatted")).otherwise(F.raise_error(F.lit("a conversation can't be read back")))
    )


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask as the source has it, one after the other."""

    def of(x: Column) -> Column:
        part = F.substr(formatted, x["start"].cast("int"), x["length"].cast("int"))
        return F.when(x["escaped"], unescape(part)).otherwise(part)

    return F.array_join(F.transform(loss, of), "")
