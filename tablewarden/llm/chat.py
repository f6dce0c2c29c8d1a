"""Chat formatting from event logs: replay each conversation, then render it with a loss mask.

An event log holds what a chat client saw: messages that begin, streamed deltas, edits and
regenerations. Events are grouped by conversation and message, sorted by sequence and folded into the
message's last version; messages are rendered where they are, and only finished turns are brought
together per conversation. All of it is DataFrame expressions.

Template: ``<s>`` role ``[INST]`` text ``[/INST]</s>`` for every turn. Inside roles and texts a
backslash becomes two, and a backslash goes behind the first character of every control string, so
the marks of a rendered conversation are never part of a text, and the text can be read back.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, TEXT, END, CLOSE = "<s>", "[INST]", "[/INST]", "</s>"
#: Event kinds: a message begins, text is added, the text is replaced, the answer starts again.
MESSAGE, DELTA, EDIT, REGENERATE = "message", "delta", "edit", "regenerate"
LEARNT_ROLE = "assistant"


def escape(text: Column) -> Column:
    """Control strings and backslashes made harmless; :func:`unescape` is the inverse."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    first = F.regexp_replace(doubled, r"<(/?s>)", r"<\\$1")
    return F.regexp_replace(first, r"\[(/?INST\])", r"[\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def fold_events(events: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text): the last version of every message of an event log.

    ``events`` has conv_id, seq, kind, turn, role, text. ``message`` opens a turn with a role and a
    text, ``delta`` adds text, ``edit`` replaces the text so far, ``regenerate`` discards it. Events
    of a turn are folded by seq; ties by kind (message, edit, regenerate, delta), then text. Null
    texts are empty, null roles the empty role, unknown kinds are passed over; the last opening
    names the role. Deltas without an opening make a turn of the empty role. Null conversations or
    turns are groups of their own. Extra columns are left behind.
    """
    kind = F.col("kind")
    order = (F.when(kind == MESSAGE, 0).when(kind == EDIT, 1).when(kind == REGENERATE, 2)
             .when(kind == DELTA, 3))
    known = events.select(
        "conv_id", "turn",
        F.struct(F.col("seq"), order.alias("kind"), F.coalesce("text", F.lit("")).alias("text"),
                 F.coalesce("role", F.lit("")).alias("role")).alias("event"),
    ).filter(F.col("event.kind").isNotNull())
    sorted_events = F.array_sort(F.collect_list("event"))
    turns = known.groupBy("conv_id", "turn").agg(sorted_events.alias("log"))
    # What counts begins at the last event that is not a delta; joining once keeps it linear.
    reset = F.aggregate(
        F.transform("log", lambda e, i: F.when(e["kind"] < 3, i)),
        F.lit(0), lambda last, i: F.coalesce(i, last))
    live = F.slice(F.col("log"), reset + 1, F.size("log"))
    text = F.array_join(F.transform(
        live, lambda e: F.when(e["kind"] == 2, F.lit("")).otherwise(e["text"])), "")
    opened = F.filter("log", lambda e: e["kind"] == 0)
    role = F.coalesce(F.try_element_at(opened, F.lit(-1))["role"], F.lit(""))
    return turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))


def render(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, mask): each conversation as one text, with what the loss is taken on.

    ``turns`` has conv_id, turn, role, text; turns come by number, ties by role and text. ``mask``
    lists (segment, start, length): the learnt part of a turn, as code points within segment
    number ``segment`` of ``formatted`` split at the closing mark. A conversation is one value by
    its nature; everything before it is spread by turn.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(OPEN), escape(role), F.lit(TEXT))
    body = escape(text)
    shown = turns.select(
        "conv_id",
        F.struct(
            F.col("turn"), role.alias("role"), text.alias("text"),
            F.concat(head, body, F.lit(END + CLOSE)).alias("shown"),
            F.char_length(head).alias("start"), F.char_length(body).alias("length"),
        ).alias("t"))
    whole = shown.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    numbered = F.transform("t", lambda t, i: F.when(
        t["role"] == LEARNT_ROLE,
        F.struct(i.alias("segment"), t["start"].alias("start"), t["length"].alias("length"))))
    return whole.select(
        "conv_id", F.array_join(F.transform("t", lambda t: t["shown"]), "").alias("formatted"),
        F.filter(numbered, lambda m: m.isNotNull()).alias("mask"))


def read_back(rendered: DataFrame) -> DataFrame:
    """What a reader gets from ``formatted`` and ``mask``: conv_id, turns (role, text), learnt."""
    segments = F.split("formatted", CLOSE, -1)
    # The text after the last closing mark is empty; a conversation without turns has no segment.
    with_segments = rendered.select(
        "conv_id", "formatted", "mask",
        F.slice(segments, 1, F.size(segments) - 1).alias("segments"))

    def turn(segment: Column) -> Column:
        at = F.instr(segment, TEXT)
        role = F.substring(segment, F.lit(len(OPEN) + 1), at - (len(OPEN) + 1))
        length = F.char_length(segment) - at - (len(TEXT) - 1) - len(END)
        return F.struct(
            unescape(role).alias("role"),
            unescape(F.substring(segment, at + len(TEXT), length)).alias("text"))

    learnt = F.array_join(F.transform("mask", lambda m: unescape(F.substring(
        F.get("segments", m["segment"]), m["start"] + 1, m["length"]))), "")
    return with_segments.select(
        "conv_id", "formatted", F.transform("segments", turn).alias("turns"),
        learnt.alias("learnt"))


def event_log(rows: DataFrame, piece: int = 256) -> DataFrame:
    """The event log of finished turns (conv_id, turn, role, text) as a client would have seen it.

    User and system turns arrive at once; answers open empty and stream in deltas of ``piece`` code
    points. Every row is a message of its own: ``turn`` becomes a struct that also holds role, hash
    of the text and a row number, so that rows that repeat a turn stay apart, in that order.
    """
    text = F.coalesce("text", F.lit(""))
    turn = F.struct("turn", "role", F.xxhash64(text).alias("text_hash"),
                    F.monotonically_increasing_id().alias("row"))
    rows = rows.select("conv_id", turn.alias("turn"), "role", "text")
    streamed = F.col("role").eqNullSafe(F.lit(LEARNT_ROLE))
    n = F.when(streamed, F.ceil(F.char_length(text) / piece)).otherwise(0).cast("int")
    first = F.struct(
        F.lit(0).alias("part"), F.lit(MESSAGE).alias("kind"),
        F.when(streamed, F.lit("")).otherwise(text).alias("text"))
    deltas = F.transform(
        F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>")),
        lambda i: F.struct(i.alias("part"), F.lit(DELTA).alias("kind"),
                           F.substring(text, (i - 1) * piece + 1, F.lit(piece)).alias("text")))
    return rows.select(
        "conv_id", "turn", "role", F.inline(F.concat(F.array(first), deltas)),
    ).select("conv_id", F.col("part").alias("seq"), "kind", "turn", "role", "text")


def format_conversations(rows: DataFrame) -> DataFrame:
    """(conv_id, formatted, mask) of finished turns, by way of their event log.

    Null texts are empty, null roles the empty role; every row is a turn, also where a turn number
    is null or repeats. Conversations with a null id form one. An empty table gives no rows.
    """
    return render(fold_events(event_log(rows)))
