"""Chat formatting from event logs, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the template. Texts never hold a bare "<", so marks stay unique.
OPEN, BODY, CLOSE = "<turn ", ">\n", "</turn>\n"


def escape(text: Column) -> Column:
    """Texts without "<" and ">", reversibly."""
    text = F.replace(text, F.lit("&"), F.lit("&amp;"))
    return F.replace(F.replace(text, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def unescape(text: Column) -> Column:
    text = F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&gt;"), F.lit(">"))
    return F.replace(text, F.lit("&amp;"), F.lit("&"))


def fold(events: DataFrame) -> DataFrame:
    """Final messages of event logs with conv_id, msg, seq, kind, role, payload.

    Events of a message are ordered by ``seq`` (any orderable type). ``delta`` appends
    its payload, ``edit`` replaces all text so far by its payload, ``regenerate``
    clears it; other kinds carry no text. The text is therefore the payload of the
    last edit or regeneration (empty for the latter) and all deltas after it, joined
    once, in linear time. The role is that of the message's first event with a role.
    Null payloads and roles count as empty, a null message or conversation id is a
    value of its own, repeated events count as often as they occur (ties of ``seq``
    by kind and payload). One group is one message, never a conversation.

    Returns conv_id, msg, first_seq, role, text."""
    kind = F.coalesce("kind", F.lit(""))
    payload = F.when(kind.isin("delta", "edit"), F.coalesce("payload", F.lit(""))).otherwise("")
    one = F.struct("seq", kind.alias("kind"), payload.alias("payload"), F.col("role").alias("role"))
    log = F.array_sort(F.collect_list(one))
    folded = events.groupBy("conv_id", "msg").agg(log.alias("log"))
    starts = F.transform("log", lambda e, i: F.when(e["kind"].isin("edit", "regenerate"), i).otherwise(-1))
    folded = folded.withColumn("reset", F.greatest(F.lit(0), F.array_max(starts)))
    return folded.select(
        "conv_id", "msg", F.col("log")[0]["seq"].alias("first_seq"),
        F.coalesce(F.get(F.filter("log", lambda e: e["role"].isNotNull()), F.lit(0))["role"], F.lit("")).alias("role"),
        F.array_join(F.transform(F.filter("log", lambda e, i: i >= F.col("reset")), lambda e: e["payload"]), "").alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """One training text per conversation and its loss mask.

    Turns stand in the order of their first events. Marks are unescaped, texts and
    roles escaped. ``loss`` lists what is learned, the assistant's texts: per span
    the turn, and start and length in code points within that turn's rendering, so
    reading a span never scans the conversation. A conversation without messages
    does not occur; an empty table gives an empty result.

    Returns conv_id, formatted, loss array<struct<turn, start, length>>."""
    role, text = escape(F.col("role")), escape(F.col("text"))
    head = F.concat(F.lit(OPEN), role, F.lit(BODY))
    turn = F.struct("first_seq", "msg", F.concat(head, text, F.lit(CLOSE)).alias("part"),
                    (F.col("role") == "assistant").alias("learn"),
                    (F.length(head) + 1).alias("start"), F.length(text).alias("length"))
    turns = messages.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    spans = F.transform("turns", lambda t, i: F.struct(
        i.alias("turn"), t["start"].alias("start"), t["length"].alias("length"), t["learn"].alias("learn")))
    return turns.select(
        "conv_id", F.array_join(F.transform("turns", lambda t: t["part"]), "").alias("formatted"),
        F.transform(F.filter(spans, lambda s: s["learn"]),
                    lambda s: F.struct(s["turn"], s["start"], s["length"])).alias("loss"))


def parse(formatted: DataFrame) -> DataFrame:
    """Turns and learned text read back from rendered conversations: conv_id, turns
    array<struct<role, text>>, learned (all text under the loss mask, unescaped)."""
    parts = F.split("formatted", CLOSE)
    out = formatted.select("conv_id", "formatted", "loss", F.slice(parts, 1, F.size(parts) - 1).alias("parts"))

    def read(part: Column) -> Column:
        role = F.substring_index(F.substring(part, len(OPEN) + 1, 2**31 - 1), ">", 1)
        body = part.substr(F.length(role) + len(OPEN) + len(BODY) + 1, F.length(part))
        return F.struct(unescape(role).alias("role"), unescape(body).alias("text"))

    learned = F.transform("loss", lambda s: F.get("parts", s["turn"]).substr(s["start"], s["length"]))
    return out.select("conv_id", "formatted", F.transform("parts", read).alias("turns"),
                      F.array_join(F.transform(learned, unescape), "").alias("learned"))


def as_events(rows: DataFrame) -> DataFrame:
    """Event logs of plain conversation rows (conv_id, turn, role, text).

    An assistant's text arrives as a withdrawn draft (its first half), a
    regeneration and streamed deltas of up to 400 characters; any other text as a
    first draft and the edit that replaces it. Rows that repeat a turn are messages
    of their own, in a fixed order that their contents decide; null texts are empty."""
    text = F.coalesce("text", F.lit(""))
    half = F.substring(text, F.lit(1), F.floor(F.length(text) / 2).cast("int"))
    chunk = F.regexp_extract_all(text, F.lit("(?s).{1,400}"), F.lit(0))

    def event(kind: str, payload: Column, at: int) -> Column:
        return F.struct(F.lit(at).alias("step"), F.lit(0).alias("piece"), F.lit(kind).alias("kind"), payload.alias("payload"))

    streamed = F.transform(chunk, lambda c, i: F.struct(
        F.lit(3).alias("step"), i.alias("piece"), F.lit("delta").alias("kind"), c.alias("payload")))
    log = F.when(F.col("role") == "assistant",
                 F.concat(F.array(event("start", F.lit(None).cast("string"), 0), event("delta", half, 1),
                                  event("regenerate", F.lit(None).cast("string"), 2)), streamed)
                 ).otherwise(F.array(event("delta", half, 1), event("edit", text, 2)))
    rows = rows.groupBy("conv_id", "turn", "role", text.alias("text")).agg(F.count("*").alias("copies"))
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    msg = F.struct("turn", F.sha2(F.concat_ws("\n", "role", "text"), 256).alias("said"), "copy")
    return (rows.select("conv_id", msg.alias("msg"), "role", F.explode(log).alias("e"))
            .select("conv_id", "msg", F.struct(F.col("msg.turn").alias("turn"), "e.step", "e.piece").alias("seq"),
                    F.col("e.kind").alias("kind"), "role", F.col("e.payload").alias("payload")))
