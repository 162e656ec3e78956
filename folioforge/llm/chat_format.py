r"""Chat formatting from a declarative template, in DataFrame functions only.

A finite-state machine over roles checks turn order; each turn becomes segments with a loss flag, and the
formatted text is their concatenation; the loss mask is also given as byte ranges of it. Control characters of the template are escaped inside texts and role
names with two-character codes that stand for one character each, so formatted text reads back exactly.

Defined cases: a null text is empty, a null role is the empty role; turns with equal numbers are ordered by
role, then text; null turn numbers come first; rows with a null conv_id form one conversation; repeated rows are
repeated turns; an empty table gives an empty result; other columns are ignored. Conversations that the machine
rejects are formatted all the same and carry valid = false with the first offending position.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import narrow


@dataclass(frozen=True)
class ChatTemplate:
    """A turn is opening + role + head_end + text + closing; all but role and text are fixed strings."""

    opening: str = "<turn:"
    head_end: str = ">\n"
    closing: str = "</turn>\n"
    #: Roles whose text is under the loss mask.
    loss_roles: tuple[str, ...] = ("assistant",)
    #: Moves of the machine: (state, role) -> state. Any other move is an error.
    moves: dict[tuple[str, str], str] = field(default_factory=lambda: {
        ("start", "system"): "ready", ("start", "user"): "asked", ("ready", "user"): "asked",
        ("asked", "assistant"): "answered", ("answered", "user"): "asked",
    })
    final: tuple[str, ...] = ("answered",)
    #: Each escaped character and its code; the escape character itself comes first.
    escapes: tuple[tuple[str, str], ...] = (("\\", "\\b"), ("<", "\\l"), (">", "\\g"))


DEFAULT = ChatTemplate()


def escape(c: Column, t: ChatTemplate = DEFAULT) -> Column:
    for raw, code in t.escapes:
        c = F.replace(c, F.lit(raw), F.lit(code))
    return c


def unescape(c: Column, t: ChatTemplate = DEFAULT) -> Column:
    for raw, code in reversed(t.escapes):
        c = F.replace(c, F.lit(code), F.lit(raw))
    return c


def _machine(roles: Column, t: ChatTemplate) -> Column:
    """struct(state, at): the state after all roles; at: first position without a move, from 0."""

    def step(acc: Column, role: Column) -> Column:
        to = F.lit("error")
        for (state, name), after in t.moves.items():
            to = F.when((acc["state"] == state) & (role == name), F.lit(after)).otherwise(to)
        return F.struct(to.alias("state"), F.when(to != "error", acc["at"] + 1).otherwise(acc["at"]).alias("at"))

    start = F.struct(F.lit("start").alias("state"), F.lit(0).alias("at"))
    return F.aggregate(roles, start, step)


def format_chats(rows: DataFrame, template: ChatTemplate = DEFAULT) -> DataFrame:
    """(conv_id, segments array<struct<text, loss>>, formatted, loss_spans, valid, error_at), one row per conversation.

    loss_spans array<struct<start, size>> are the bytes of formatted (in UTF-8, from 1) under the loss mask.
    """
    own = narrow(rows, {"conv_id": "long", "turn": "long", "role": "string", "text": "string"}).fillna("", ["role", "text"])
    own = own.withColumns({"head": F.concat(F.lit(template.opening), escape(F.col("role"), template), F.lit(template.head_end)), "body": escape(F.col("text"), template)})
    before = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    width = F.octet_length("head") + F.octet_length("body") + len(template.closing.encode())
    own = own.withColumn("start", F.coalesce(F.sum(width).over(before), F.lit(0)) + F.octet_length("head") + 1)
    turn = F.struct("turn", "role", "text", "head", "body", "start")
    convs = own.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    # array_sort puts null turn numbers first inside structs, as the window's ascending order does.
    loss = lambda x: x["role"].isin(*template.loss_roles)

    def segments(x: Column) -> Column:
        return F.array(
            F.struct(x["head"].alias("text"), F.lit(False).alias("loss")),
            F.struct(x["body"].alias("text"), loss(x).alias("loss")),
            F.struct(F.lit(template.closing).alias("text"), F.lit(False).alias("loss")),
        )

    spans = F.transform(F.filter("turns", loss), lambda x: F.struct(x["start"].alias("start"), F.octet_length(x["body"]).cast("long").alias("size")))
    out = convs.select("conv_id", F.flatten(F.transform("turns", segments)).alias("segments"), spans.alias("loss_spans"), _machine(F.col("turns.role"), template).alias("m"))
    return out.select(
        "conv_id", "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        "loss_spans",
        F.col("m.state").isin(*template.final).alias("valid"),
        F.when(F.col("m.state") == "error", F.col("m.at")).alias("error_at"),
    )


def read_chats(formatted: DataFrame, template: ChatTemplate = DEFAULT) -> DataFrame:
    """conv_id and turns array<struct<role, text>>, read back from the formatted text alone."""
    parts = F.split(F.col("formatted"), _quoted(template.closing))
    parts = F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))

    def turn(p: Column) -> Column:
        cut = F.instr(p, template.head_end)
        role = p.substr(F.lit(len(template.opening) + 1), cut - len(template.opening) - 1)
        text = p.substr(cut + len(template.head_end), F.length(p))
        return F.struct(unescape(role, template).alias("role"), unescape(text, template).alias("text"))

    return formatted.withColumn("turns", F.transform(parts, turn))


def loss_text(formatted: Column, loss_spans: Column, template: ChatTemplate = DEFAULT) -> Column:
    """All text under the loss mask, cut from the formatted text's bytes and unescaped, nothing between."""
    cut = lambda data: F.array_join(F.transform(loss_spans, lambda s: F.decode(F.substring(data, s["start"].cast("int"), s["size"].cast("int")), "UTF-8")), "")
    return unescape(F.get(F.transform(F.array(F.encode(formatted, "UTF-8")), cut), F.lit(0)), template)


def _quoted(s: str) -> str:
    return "\\Q" + s + "\\E"
