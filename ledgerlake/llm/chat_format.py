"""Chat formatting from event logs, in DataFrame functions alone.

Events are (conv_id, seq, message, role, kind, text). Kinds: ``message`` (a whole
message by itself), ``delta`` (text streamed onto a message), ``edit`` (replaces the
message's text so far), ``regenerate`` (starts the message over with this text);
other kinds and null ones count as ``delta``. Logs are partitioned by conversation
and message, sorted by sequence and folded; messages follow each other by their
first sequence number. Grouping by message first splits long conversations; only
the finished string of a conversation meets in one row, as the output requires.

A conversation renders as ``<s>`` and, per turn, ``[INST]role[/INST]text</s>``.
Control characters ``<``, ``[`` and backslash inside roles and texts are each followed
by a backslash, so no control string can occur there, and one pass takes it back.

Null text and role are empty. Events with equal sequence numbers are taken in order
of (message, role, text); repeated rows of kind ``message`` are turns each. A null
conv_id is a conversation of its own. Extra columns are ignored; an empty table gives
no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BEGIN, OPEN, SHUT, END = "<s>", "[INST]", "[/INST]", "</s>"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"([<\[\\])", r"$1\\")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"([<\[\\])\\", "$1")


def events_of(conversations: DataFrame) -> DataFrame:
    """Conversation rows (conv_id, turn, role, text) as ``message`` events."""
    return conversations.select("conv_id", F.col("turn").cast("long").alias("seq"), F.col("turn").cast("long").alias("message"), "role", F.lit("message").alias("kind"), "text")


def reconstruct(events: DataFrame) -> DataFrame:
    """conv_id, message, seq, role, text: final messages. All events of a message, whole ones too, are
    sorted by sequence and folded: what was streamed becomes one message, a whole one stands for itself."""
    e = events.select("conv_id", "seq", "message", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("kind", F.lit("delta")).alias("kind"), F.coalesce("text", F.lit("")).alias("text"))
    logs = e.groupBy("conv_id", "message").agg(F.sort_array(F.collect_list(F.struct("seq", "role", "text", "kind"))).alias("log"))
    message = lambda seq, role, text: F.struct(seq.alias("seq"), role.alias("role"), text.alias("text"))
    whole = F.transform(F.filter("log", lambda x: x["kind"] == "message"), lambda x: message(x["seq"], x["role"], x["text"]))
    parts = F.filter("log", lambda x: x["kind"] != "message")
    fold = F.aggregate(parts, F.lit(""), lambda text, x: F.when(x["kind"].isin("edit", "regenerate"), x["text"]).otherwise(F.concat(text, x["text"])))
    streamed = F.transform(F.slice(parts, 1, 1), lambda first: message(first["seq"], first["role"], fold))
    return logs.select("conv_id", "message", F.inline(F.concat(whole, streamed)))


def render(messages: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_spans (start, length of each assistant text in ``formatted``, in characters)."""
    turn = F.struct("seq", "message", "role", "text")
    conv = messages.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    pieces = F.transform("turns", lambda t: F.struct(
        F.concat(F.lit(OPEN), escape(t["role"]), F.lit(SHUT)).alias("head"), escape(t["text"]).alias("body"), (t["role"] == "assistant").alias("loss")))
    conv = conv.select("conv_id", pieces.alias("p"))
    formatted = F.concat(F.lit(BEGIN), F.concat_ws("", F.transform("p", lambda t: F.concat(t["head"], t["body"], F.lit(END)))))
    start = F.struct(F.lit(len(BEGIN)).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))
    step = lambda s, t: F.struct(
        (s["at"] + F.length(t["head"]) + F.length(t["body"]) + len(END)).alias("at"),
        F.when(t["loss"], F.concat(s["spans"], F.array(F.struct((s["at"] + F.length(t["head"])).alias("start"), F.length(t["body"]).alias("length"))))).otherwise(s["spans"]).alias("spans"))
    return conv.select("conv_id", formatted.alias("formatted"), F.aggregate("p", start, step, lambda s: s["spans"]).alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """``formatted`` rows plus turns (role, text) parsed from the string and loss_text (unescaped)."""
    body = F.expr(f"substring(formatted, {len(BEGIN) + 1})")
    raw = F.split(body, END, -1)
    turns = F.transform(F.slice(raw, F.lit(1), F.size(raw) - 1), lambda t: F.struct(
        unescape(F.regexp_extract(t, r"(?s)^\[INST\](.*?)\[/INST\]", 1)).alias("role"), unescape(F.regexp_replace(t, r"(?s)^\[INST\].*?\[/INST\]", "")).alias("text")))
    loss = F.concat_ws("", F.transform("loss_spans", lambda s: unescape(F.substring("formatted", s["start"] + 1, s["length"]))))
    return formatted.withColumn("turns", turns).withColumn("loss_text", loss)


def format_chats(conversations: DataFrame) -> DataFrame:
    return render(reconstruct(events_of(conversations)))
