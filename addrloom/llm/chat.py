r"""Chat formatting by event-sourced reconstruction (native).

A conversation is a log of events. Events of one message are folded in sequence: ``message`` and
``regenerate`` start its text anew, ``edit`` replaces it, ``delta`` appends. The final messages are rendered as

    <turn>### role: text</turn>\n

Control strings inside texts are escaped so that the text comes back exactly: every backslash becomes
``\b``, ``</turn>`` ``\c``, ``<turn>`` ``\o`` and ``### `` ``\h``. A backslash in the output is thus always
followed by one of these letters, and undoing the last three, then ``\b``, restores the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

OPEN, CLOSE, HEAD, COLON = "<turn>", "</turn>", "### ", ": "
END = CLOSE + "\n"
#: In this order when escaping, backwards when undoing it. The colon is escaped in roles only.
ESCAPES = (("\\", "\\b"), (CLOSE, "\\c"), (OPEN, "\\o"), (HEAD, "\\h"))
ROLE_ESCAPES = (*ESCAPES, (":", "\\s"), ("\n", "\\n"))


def _replace_all(text: Column, pairs) -> Column:
    for a, b in pairs:
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def escape(text: Column, pairs=ESCAPES) -> Column:
    return _replace_all(text, pairs)


def unescape(text: Column, pairs=ESCAPES) -> Column:
    return _replace_all(text, [(b, a) for a, b in reversed(pairs)])


def fold_events(events: DataFrame, conv: str = "conv_id", seq: str = "seq", message: str = "message_id", op: str = "op", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv, position, role, text)``: the final messages of a log of events.

    Position: the message's smallest sequence number. A message's text is what the last event that starts
    it anew (``message``, ``edit``, ``regenerate``) says, and the ``delta`` texts after it, in sequence. Its
    role is that of its latest event that names one. Null text is empty, a null op is a ``message``; other
    ops change nothing. Events with equal sequence numbers go by op (a delta after what starts the message
    anew), then text; a null sequence number comes first; null conversation or message ids are keys like others.
    """
    kind = F.coalesce(F.col(op), F.lit("message"))
    starts = kind.isin("message", "edit", "regenerate")
    e = events.select(
        F.struct(F.col(conv).alias("c"), F.col(message).alias("m")).alias("k"),
        F.coalesce(F.col(seq).cast("long"), F.lit(-(2**63))).alias("s"),
        starts.alias("starts"),
        (kind == "delta").alias("adds"),
        F.col(role).alias("r"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"),
    )
    order = F.struct("s", (~F.col("starts")).alias("late"), "t")
    folded = e.groupBy("k").agg(
        F.min("s").alias("position"),
        F.max_by("r", F.when(F.col("r").isNotNull(), order)).alias("role"),
        F.max(F.when(F.col("starts"), F.struct("s", "t"))).alias("base"),
        F.array_sort(F.collect_list(F.when(F.col("adds"), F.struct("s", "t")))).alias("deltas"),
    )
    later = F.filter("deltas", lambda d: F.col("base").isNull() | (d["s"] >= F.col("base.s")))
    whole = F.concat(F.coalesce(F.col("base.t"), F.lit("")), F.array_join(F.transform(later, lambda d: d["t"]), ""))
    return folded.select(F.col("k.c").alias(conv), "position", "role", whole.alias("text"))


def render(messages: DataFrame, conv: str = "conv_id", position: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv, formatted)``: each row a message, in order of position, then role and text.

    Null role and text are empty, a null position comes first, a null conversation is one of its own; texts of any length
    are whole, repeated rows are turns of their own. No rows, no result; other columns are not read. A conversation becomes
    one text, so all of it meets in one row: what a task holds is bounded by the longest conversation, nothing else.
    """
    rendered = F.concat(
        F.lit(OPEN + HEAD), escape(F.coalesce(F.col(role).cast("string"), F.lit("")), ROLE_ESCAPES), F.lit(COLON),
        escape(F.coalesce(F.col(text).cast("string"), F.lit(""))), F.lit(END),
    )
    # The rendered turn starts with its role and goes on with its text: it breaks ties by itself.
    turns = messages.select(F.col(conv).alias("conv_id"), F.struct(F.col(position).alias("p"), rendered.alias("x")).alias("turn"))
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return grouped.select(F.col("conv_id").alias(conv), F.array_join(F.transform("turns", lambda t: t["x"]), "").alias("formatted"))


def parse(formatted: Column) -> Column:
    """The array of ``(role, text)`` that a formatted conversation holds."""
    parts = F.split(formatted, r"</turn>\n")
    turns = F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))
    head = len(OPEN + HEAD)

    def turn(x: Column) -> Column:
        at = F.locate(COLON, x)
        return F.struct(
            unescape(F.substring(x, F.lit(head + 1), at - F.lit(head + 1)), ROLE_ESCAPES).alias("role"),
            unescape(F.substring(x, at + len(COLON), F.length(x))).alias("text"),
        )

    return F.transform(turns, turn)


def loss_text(turns: Column, role: str = "assistant") -> Column:
    """All text under the loss mask: that of the given role, in order, unescaped, nothing between."""
    return F.array_join(F.transform(F.filter(turns, lambda t: t["role"] == role), lambda t: t["text"]), "")


def log_of(turns: DataFrame) -> DataFrame:
    """A plain table of turns as a log of events: every row a whole message of its own, so that repeated turns stay apart."""
    return turns.select(
        "conv_id", F.col("turn").alias("seq"), F.monotonically_increasing_id().alias("message_id"), F.lit("message").alias("op"), "role", "text"
    )


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``conversations`` and conversation -7 through the fold and the template, read back from the rendered text."""
    own = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    read = render(fold_events(log_of(rows)), position="position").withColumn("turns", parse(F.col("formatted"))).withColumn("loss", loss_text(F.col("turns")))
    digest = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(digest, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP1_SQL = r"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), e AS (
  SELECT *, '<turn>### ' || replace(replace(replace(replace(replace(replace(role, '\', '\b'), '</turn>', '\c'), '<turn>', '\o'), '### ', '\h'), ':', '\s'), chr(10), '\n')
    || ': ' || replace(replace(replace(replace(text, '\', '\b'), '</turn>', '\c'), '<turn>', '\o'), '### ', '\h') || '</turn>' || chr(10) AS x FROM r
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, x)) AS turns_sha256,
  coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, x), '')) AS loss_sha256,
  sum(length(x))::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
