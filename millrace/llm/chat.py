"""Operator 4: chat formatting from event logs, with DataFrame functions only.

An event log holds, for every conversation, events in sequence. ``delta`` appends to a message,
``edit`` replaces what the message holds, ``regenerate`` discards it and starts again with the event's own
text. Folding partitions the log by conversation, sorts by sequence, and keeps what follows each
message's last reset. Rendering marks turns and escapes control characters inside texts reversibly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, END = "<|turn|>", "<|end|>"

# The character that starts an escape comes first, then the characters that control strings are made of.
ESCAPES = {"\\": "\\0", "<": "\\1", ">": "\\2", "[": "\\3", "]": "\\4"}

#: A line break inside a role, which would otherwise end the turn's first line.
NEWLINE = "\\5"


def escape(text: Column) -> Column:
    """Text in which no control string is left: every ``\\ < > [ ]`` becomes a backslash and a digit."""
    for plain, code in ESCAPES.items():
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    """The inverse of escape(); the backslash itself is restored last."""
    for plain, code in reversed(ESCAPES.items()):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def fold_events(events: DataFrame, *, conv: str = "conv_id", seq: str = "seq", message: str = "message_id", kind: str = "kind", role: str = "role", text: str = "text") -> DataFrame:
    """Final messages: conv_id, message_id, role, text; one row per message that has an event.

    A null text is empty and a null role becomes ''. Events of the same sequence number are ordered by kind
    and text. An unknown or null kind counts as a delta. The role is that of the message's first event. Null
    conversation and message ids are ordinary values. Repeated events apply again. Other columns are ignored.
    """
    e = events.select(
        F.col(f"`{conv}`").alias("conv_id"),
        F.col(f"`{message}`").alias("message_id"),
        F.col(f"`{seq}`").alias("seq"),
        F.coalesce(F.col(f"`{kind}`"), F.lit("delta")).alias("kind"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    reset = F.col("kind").isin("edit", "regenerate")
    grouped = e.groupBy("conv_id", "message_id").agg(F.sort_array(F.collect_list(F.struct("seq", "kind", "text", reset.alias("reset"), "role"))).alias("log"))
    last = F.expr("aggregate(sequence(1, size(log)), 1, (best, i) -> if(element_at(log, i).reset, i, best))")
    kept = F.expr("slice(log, _last, size(log) - _last + 1)")
    return grouped.withColumn("_last", last).select(
        "conv_id", "message_id", F.col("log")[0]["role"].alias("role"), F.array_join(F.transform(kept, lambda x: x["text"]), "").alias("text")
    )


def render(messages: DataFrame, *, conv: str = "conv_id", order: str = "message_id", role: str = "role", text: str = "text", loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per message: conv_id, position, role, rendered, loss_start, loss_end.

    ``rendered`` concatenated by position is the conversation; loss_start and loss_end are code point offsets
    into that conversation of the text under the loss mask (both null for other roles). Messages of equal
    order are sorted by role and text. Null roles and texts are empty. Other columns are ignored.
    """
    m = messages.select(
        F.col(f"`{conv}`").alias("conv_id"), F.col(f"`{order}`").alias("_order"), F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text")
    )
    head = F.concat(F.lit(TURN), F.replace(escape(F.col("role")), F.lit("\n"), F.lit(NEWLINE)), F.lit("\n"))
    body = escape(F.col("_text"))
    m = m.withColumn("_head", head).withColumn("_body", body).withColumn("rendered", F.concat("_head", "_body", F.lit(END + "\n")))
    w = Window.partitionBy("conv_id").orderBy("_order", "role", "_text")
    start = F.coalesce(F.sum(F.length("rendered")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.length("_head")
    under_loss = F.col("role").isin(*loss_roles)
    m = m.withColumn("position", F.row_number().over(w) - 1).withColumn("_start", start)
    return m.select(
        "conv_id", "position", "role", "rendered", F.when(under_loss, F.col("_start")).alias("loss_start"), F.when(under_loss, F.col("_start") + F.length("_body")).alias("loss_end")
    )


def assemble(rendered: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_spans: the rendered messages of a conversation as one text.

    A conversation is one training example, so its text is one value; that is the only place where it meets.
    """
    turns = F.sort_array(F.collect_list(F.struct("position", "rendered", "loss_start", "loss_end")))
    grouped = rendered.groupBy("conv_id").agg(turns.alias("t"))
    spans = F.transform(F.filter("t", lambda x: x["loss_start"].isNotNull()), lambda x: F.struct(x["loss_start"].alias("start"), x["loss_end"].alias("end")))
    return grouped.select("conv_id", F.array_join(F.transform("t", lambda x: x["rendered"]), "").alias("formatted"), spans.alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_spans, turns array<struct<role, text>>, loss_text, all from the formatted text and its spans.

    loss_text is what stands under the spans, unescaped and joined in their order; a span ends with the turn in which it starts. Turns and
    spans are rows while they are matched by their places, so that a long conversation is read once and not once for each span.
    """
    none = lambda kind: F.lit(None).cast(kind)
    pieces = F.transform(F.split("formatted", r"(?=<\|turn\|>)"), lambda x, i: F.struct(F.lit(0).alias("kind"), i.alias("i"), x.alias("piece"), none("long").alias("start"), none("long").alias("end")))
    spans = F.transform("loss_spans", lambda s, i: F.struct(F.lit(1).alias("kind"), i.alias("i"), none("string").alias("piece"), s["start"].cast("long").alias("start"), s["end"].cast("long").alias("end")))
    rows = formatted.select("conv_id", F.explode(F.concat(pieces, spans)).alias("x")).select("conv_id", "x.*")
    own, is_turn = Window.partitionBy("conv_id"), F.col("kind") == 0
    before = F.coalesce(F.sum(F.length("piece")).over(own.orderBy("kind", "i").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("at", F.when(is_turn, before).otherwise(F.col("start")))
    around = F.last(F.when(is_turn, F.struct("at", "piece")), ignorenulls=True).over(own.orderBy("at", "kind", "i").rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("turn", around)
    inside = F.substring("turn.piece", F.col("start") - F.col("turn.at") + 1, F.col("end") - F.col("start"))
    head = F.substring_index(F.substring("piece", len(TURN) + 1, 2**31 - 1), "\n", 1)
    role = unescape(F.replace(head, F.lit(NEWLINE), F.lit("\n")))
    text = unescape(F.regexp_extract("piece", r"(?s)^[^\n]*\n(.*)<\|end\|>\n$", 1))
    turn = F.when(is_turn, F.struct("i", "piece", role.alias("role"), text.alias("text")))
    span = F.when(~is_turn, F.struct("i", "start", "end", unescape(inside).alias("text")))
    read = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("t"), F.sort_array(F.collect_list(span)).alias("s"))
    return read.select(
        "conv_id",
        F.array_join(F.transform("t", lambda x: x["piece"]), "").alias("formatted"),
        F.transform("s", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))).alias("loss_spans"),
        F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("turns"),
        F.array_join(F.transform("s", lambda x: x["text"]), "").alias("loss_text"),
    )
