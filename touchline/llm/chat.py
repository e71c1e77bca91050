"""Chat formatting: conversations rebuilt from their event log, rendered, and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The template. A turn is OPEN role NEWLINE text CLOSE. Inside roles and texts the characters that
# marks are made of are written as escapes, so no text can look like a mark.
OPEN, CLOSE = "<turn>### ", "</turn>\n"
ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"))
NEWLINE = ("\n", "\\n")  # escaped in roles only

# What an event does to the message it names.
START, DELTA, EDIT, REGENERATE, DELETE = "start", "delta", "edit", "regenerate", "delete"


def escape(c: Column, role: bool = False) -> Column:
    for raw, safe in ESCAPES + ((NEWLINE,) if role else ()):
        c = F.replace(c, F.lit(raw), F.lit(safe))
    return c


def unescape(c: Column, role: bool = False) -> Column:
    for raw, safe in reversed(ESCAPES + ((NEWLINE,) if role else ())):
        c = F.replace(c, F.lit(safe), F.lit(raw))
    return c


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages of an event log: ``conv_id``, ``message``, ``role``, ``text``.

    ``events`` has ``conv_id``, ``seq``, ``message``, ``kind``, ``role``, ``text``.
    By ``seq``, a ``start`` opens a message, ``delta`` appends to its text,
    ``edit`` replaces the text, ``regenerate`` drops it so that the deltas that
    follow write it anew, ``delete`` removes the message unless a later event
    writes it again. The text of a message is thus that of the events since its
    last reset. The role is the last one given. Null texts are empty, null
    kinds count as ``delta``, other kinds change nothing. Events of one message
    with equal ``seq`` apply in order of kind, role and text. Events are dealt
    out by conversation and message, so a long conversation is folded by many
    tasks, and each message gathers only its own events.
    """
    kind = F.coalesce(F.lower("kind"), F.lit(DELTA))
    e = events.select("conv_id", "message", F.struct(
        "seq", kind.alias("kind"), F.col("role").cast("string").alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("e"))
    e = e.filter(F.col("e.kind").isin(START, DELTA, EDIT, REGENERATE, DELETE))
    log = e.groupBy("conv_id", "message").agg(F.array_sort(F.collect_list("e")).alias("log"))
    places = F.transform("log", lambda x, i: F.when(x["kind"] != DELTA, i + 1))
    reset = F.coalesce(F.array_max(places), F.lit(1))
    log = log.withColumn("live", F.slice("log", reset, F.greatest(F.size("log") - reset + 1, F.lit(0))))
    gone = (F.element_at("live", 1)["kind"] == DELETE) & (F.size("live") == 1)
    roles = F.filter("log", lambda x: x["role"].isNotNull())
    return log.filter(~gone).select(
        "conv_id", "message", F.try_element_at(roles, F.lit(-1))["role"].alias("role"),
        F.array_join(F.transform("live", lambda x: F.when(x["kind"].isin(REGENERATE, DELETE), "").otherwise(x["text"])), "").alias("text"))


def render(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted``, ``loss_spans``.

    Messages follow each other by ``message``. ``loss_spans`` has one entry for
    each turn: start and end, in code points of ``formatted``, of the text the
    loss is taken on, or an empty span where the role is another. Null roles
    are rendered as empty ones. A formatted conversation is one cell, so it
    must stay below Spark's 2 GB.
    """
    head = F.concat(F.lit(OPEN), escape(F.coalesce("role", F.lit("")), role=True), F.lit("\n"))
    m = messages.select("conv_id", "message", "role", head.alias("head"), escape(F.coalesce("text", F.lit(""))).alias("body"))
    turn = F.concat("head", "body", F.lit(CLOSE))
    upto = Window.partitionBy("conv_id").orderBy("message", "role", "body").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    m = m.withColumn("turn", turn).withColumn("end", F.sum(F.length("turn")).over(upto))
    stop = F.col("end") - len(CLOSE)
    start = F.when(F.col("role").eqNullSafe(loss_role), stop - F.length("body")).otherwise(stop)
    m = m.withColumn("part", F.struct("end", "turn", F.struct(start.alias("start"), stop.alias("end")).alias("span")))
    parts = m.groupBy("conv_id").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    return parts.select("conv_id", F.array_join(F.col("parts.turn"), "").alias("formatted"), F.col("parts.span").alias("loss_spans"))


def format_chats(events: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """Event log to formatted conversations: :func:`fold_events`, then :func:`render`."""
    return render(fold_events(events), loss_role)


def read_back(formatted: DataFrame) -> DataFrame:
    """``turns`` (role, text, unescaped) and ``loss_text`` of formatted conversations.

    The exact inverse of :func:`render`, from ``formatted`` and ``loss_spans`` alone.
    """
    pieces = F.split(F.col("formatted"), CLOSE)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        inner = F.substring(piece, len(OPEN) + 1, F.length(piece))
        at = F.locate("\n", inner)
        return F.struct(unescape(F.substring(inner, F.lit(1), at - 1), role=True).alias("role"),
                        unescape(F.substring(inner, at + 1, F.length(inner))).alias("text"),
                        F.substring(inner, at + 1, F.length(inner)).alias("body"))

    masked = F.zip_with("read", "loss_spans", lambda t, s: F.when(
        s["end"] > s["start"], unescape(F.substring(t["body"], F.length(t["body"]) - (s["end"] - s["start"]).cast("int") + 1, F.length(t["body"])))).otherwise(F.lit("")))
    return (formatted.withColumn("read", F.transform(pieces, turn))
            .withColumn("turns", F.transform("read", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))))
            .withColumn("loss_text", F.array_join(masked, "")).drop("read"))


def message_events(conversations: DataFrame) -> DataFrame:
    """An event log from a table of finished turns: each row starts its message and one delta streams its text.

    Rows are numbered by turn, then role and text, nulls first, so repeated rows stay separate messages.
    """
    place = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    m = conversations.select("conv_id", "role", "text", F.row_number().over(place).alias("message"))
    log = F.array(
        F.struct((F.col("message") * 2).alias("seq"), F.lit(START).alias("kind"), F.col("role").alias("role"), F.lit("").alias("text")),
        F.struct((F.col("message") * 2 + 1).alias("seq"), F.lit(DELTA).alias("kind"), F.lit(None).cast("string").alias("role"), F.col("text").alias("text")),
    )
    return m.select("conv_id", "message", F.explode(log).alias("e")).select("conv_id", "message", "e.*")
