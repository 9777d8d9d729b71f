"""Operator 10: chat formatting by event-sourced reconstruction (native).

A conversation is a log of events, each with a sequence number:

* ``message``  opens a message (``target`` is its own sequence number);
* ``delta``    appends streamed text to message ``target``;
* ``edit``     replaces the text of message ``target``;
* ``regenerate`` empties message ``target``, whose new text follows as deltas.

``reconstruct`` folds the log into final messages and ``render`` writes them by
the template.  Only DataFrame functions are used.  Work is split by message
first, so that a conversation's events meet only as finished messages.

Defined cases: a null text or role is empty; a null sequence number sorts
first; rows with a null conv_id form one conversation; repeated ``message``
rows are messages of their own, ordered by sequence, role and text; events whose
target has no message are dropped with it (there is no role to render); an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._stage import table

#: The template's control strings all begin with "<"; texts hold none after escaping.
OPEN, MID, CLOSE = "<turn ", ">\n", "</turn>\n"
ESCAPES = (("\\", "\\b"), ("<", "\\l"), (">", "\\g"))
EXTRA_CONVERSATION, EXTRA_TEXT = -7, "\\### Assistant: </turn> ok"


def escaped(text: Column) -> Column:
    """Reversible: afterwards each backslash is the first half of a code."""
    for raw, code in ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    """Codes other than the backslash's first, else ``\\b`` then ``l`` would fuse."""
    for raw, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(raw))
    return text


def reconstruct(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, seq, role, text) of an event log
    (conv_id, seq, kind, target, role, text)."""
    blank = F.lit("")
    log = events.select(
        "conv_id", F.when(F.col("kind") == "message", F.col("seq")).otherwise(F.col("target")).alias("m_target"),
        F.struct("seq", (F.col("kind") != "message").alias("later"), F.coalesce("role", blank).alias("role"),
                 F.coalesce("text", blank).alias("text"), "kind").alias("event"))
    log = log.where(F.col("event.kind").isin("message", "delta", "edit", "regenerate"))
    own = log.groupBy("conv_id", "m_target").agg(F.sort_array(F.collect_list("event")).alias("events"))
    opened = F.filter("events", lambda e: e["kind"] == "message")
    changes = F.filter("events", lambda e: e["kind"] != "message")
    # the last event that sets the text, and what was streamed after it
    reset = F.coalesce(F.array_max(F.transform(
        changes, lambda e, i: F.when(e["kind"] != "delta", i))), F.lit(-1))
    own = own.select("conv_id", F.col("m_target").alias("seq"), opened.alias("opened"), changes.alias("changes"),
                     reset.alias("reset"))
    base = F.when(F.col("reset") < 0, F.element_at("opened", -1)["text"]).when(
        F.get("changes", F.col("reset"))["kind"] == "edit", F.get("changes", F.col("reset"))["text"]).otherwise(blank)
    streamed = F.array_join(F.transform(F.filter(
        "changes", lambda e, i: (i > F.col("reset")) & (e["kind"] == "delta")), lambda e: e["text"]), "")
    last = F.size("opened") - 1
    final = F.transform("opened", lambda e, i: F.struct(
        e["role"].alias("role"), F.when(i == last, F.col("final")).otherwise(e["text"]).alias("text")))
    return (own.where(F.size("opened") > 0).withColumn("final", F.concat(base, streamed))
            .select("conv_id", "seq", F.inline(final)))


def render(messages: DataFrame) -> DataFrame:
    """One row for each conversation: ``formatted`` and its loss mask ``loss``,
    an array of (start, length) in code points that covers each assistant text."""
    head = F.concat(F.lit(OPEN), escaped(F.col("role")), F.lit(MID))
    body = escaped(F.col("text"))
    turn = F.struct("seq", "role", "text", F.concat(head, body, F.lit(CLOSE)).alias("out"),
                    F.length(head).alias("lead"), F.length(body).alias("body"))
    turns = messages.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))

    def place(state: Column, t: Column) -> Column:
        span = F.array(F.struct((state["at"] + t["lead"]).cast("long").alias("start"), t["body"].cast("long").alias("length")))
        return F.struct((state["at"] + F.length(t["out"])).cast("long").alias("at"),
                        F.when(t["role"] == "assistant", F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    return turns.select(
        "conv_id", F.array_join(F.transform("turns", lambda t: t["out"]), "").alias("formatted"),
        F.aggregate(F.transform("turns", lambda t: t.dropFields("text", "seq")), zero, place)["spans"].alias("loss"))


def read_back(rendered: DataFrame) -> DataFrame:
    """Parse ``formatted`` into ``turns`` (role, text) and cut ``loss_text`` by the mask."""
    pieces = F.filter(F.split("formatted", CLOSE), lambda p: F.length(p) > 0)
    turns = F.transform(pieces, lambda p: F.struct(
        unescaped(F.substring(F.substring_index(p, MID, 1), len(OPEN) + 1, 1 << 30)).alias("role"),
        unescaped(F.substr(p, F.instr(p, MID) + len(MID))).alias("text")))
    loss = F.array_join(F.transform("loss", lambda s: unescaped(
        F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
    return rendered.withColumns({"turns": turns, "loss_text": loss})


def conversation_events(conversations: DataFrame) -> DataFrame:
    """Each row of a conversations table as a ``message`` event."""
    return conversations.select("conv_id", F.col("turn").cast("long").alias("seq"), F.lit("message").alias("kind"),
                                F.col("turn").cast("long").alias("target"), "role", "text")


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.range(2).select(
        F.lit(EXTRA_CONVERSATION).cast("long").alias("conv_id"), F.col("id").alias("seq"), F.lit("message").alias("kind"),
        F.col("id").alias("target"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(EXTRA_TEXT).alias("text"))
    events = conversation_events(table(spark, sf_dir, "conversations")).unionByName(extra)
    back = read_back(render(reconstruct(events)))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.encode(told, "UTF-8"), 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.encode(F.col("loss_text"), "UTF-8"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


SQL = r"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(16 + length(role) + length(text) + length(regexp_replace(role || text, '[^\\<>]', '', 'g'))) AS BIGINT)
        AS formatted_chars
FROM rows GROUP BY conv_id
"""

QUERIES = {"op10_chat_format": op10_chat_format}
ORACLES = {"op10_chat_format": SQL}
