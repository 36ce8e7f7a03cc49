"""Chat formatting with typed content parts, in DataFrame functions only.

A message holds an array of typed parts. A visitor over the parts of a
conversation writes text parts escaped and every image, audio or document part
as a numbered placeholder; it records each attachment's reference and the tokens
that the placeholder stands for once the model expands it.

Parts are rows until the end: a window in the order of the conversation numbers
attachments and adds up offsets, then one aggregation puts the pieces together.
Both share one shuffle, and work is linear in turns and parts.

Template
--------
``<turn ROLE>`` + newline + content + ``</turn>`` + newline, for each message in
turn order. ``<`` never occurs in escaped content, so every ``<`` in the output
is a control string. The escape is reversible: a backslash becomes ``\\s``,
``<`` becomes ``\\l`` and ``>`` becomes ``\\g``.

Defined results
---------------
Null role, text, part type or reference: empty. Null or empty part array: an
empty message. Equal (conversation, turn) keys: ordered by role, then content.
Null conversation ids form one conversation. An empty table gives no rows.
Columns other than those named in the arguments are ignored, so extra columns
and clashing names do no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyforge.llm.common import table

OPEN, CLOSE = "<turn ", "</turn>"
PART = "struct<type:string,text:string,ref:string,units:double>"
#: Tokens of an attachment for one unit (an image tile, a second of audio, a page).
TOKENS_PER_UNIT = {"image": 256.0, "audio": 12.5, "document": 800.0}


def escape(text: Column) -> Column:
    for plain, code in (("\\", "\\s"), ("<", "\\l"), (">", "\\g")):
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in ((">", "\\g"), ("<", "\\l"), ("\\", "\\s")):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def text_part(text: Column) -> Column:
    """A message of plain text as an array with one text part."""
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("double").alias("units"))).cast(f"array<{PART}>")


def is_text(part: Column) -> Column:
    return F.coalesce(part["type"], F.lit("")) == "text"


def part_tokens(part: Column, tokens_per_unit: dict[str, float]) -> Column:
    """Tokens after expansion; text counts its white-space words."""
    rate = F.coalesce(*[F.when(part["type"] == k, F.lit(v)) for k, v in tokens_per_unit.items()], F.lit(1.0))
    words = F.size(F.filter(F.split(F.coalesce(part["text"], F.lit("")), r"\s+"), lambda w: w != ""))
    return F.when(is_text(part), words).otherwise(F.ceil(F.coalesce(part["units"], F.lit(1.0)) * rate)).cast("long")


def visited(messages: DataFrame, tokens_per_unit: dict[str, float]) -> DataFrame:
    """One row per part (one for a message without any), in `message` and `part` order: its piece of the output.

    `number` is the attachment's, `start` the code point where the message's
    content begins and `length` its size, `inner` the same in the turn's text
    after its opening.
    """
    ordered = Window.partitionBy("conv_id").orderBy("turn", "role", "parts")
    each = messages.withColumn("message", F.row_number().over(ordered)).select("conv_id", "message", "role", F.size("parts").alias("n_parts"), F.posexplode_outer("parts").alias("part", "p"))
    p, there = F.col("p"), F.col("part").isNotNull()
    running = Window.partitionBy("conv_id").orderBy("message", "part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    attached = there & ~is_text(p)
    each = each.withColumn("number", F.when(attached, F.sum(attached.cast("int")).over(running).cast("int")))
    placeholder = F.concat(F.lit("<"), escape(F.coalesce(p["type"], F.lit(""))), F.lit(" "), F.col("number").cast("string"), F.lit(">"))
    content = F.when(~there, "").when(is_text(p), escape(F.coalesce(p["text"], F.lit("")))).otherwise(placeholder)
    head = F.when(F.coalesce("part", F.lit(0)) == 0, F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(">\n"))).otherwise("")
    tail = F.when(~there | (F.col("part") == F.col("n_parts") - 1), f"{CLOSE}\n").otherwise("")
    each = each.withColumns({"content": content, "head": head}).withColumn("piece", F.concat("head", "content", tail))
    size = F.length("piece")
    return each.select(
        "conv_id",
        "message",
        F.coalesce("part", F.lit(0)).alias("part"),
        "role",
        "piece",
        "number",
        F.coalesce(p["type"], F.lit("")).alias("type"),
        F.coalesce(p["ref"], F.lit("")).alias("ref"),
        F.when(there, part_tokens(p, tokens_per_unit)).otherwise(0).alias("tokens"),
        (F.sum(size).over(running) - size + F.length("head")).cast("int").alias("start"),
        (F.length("head") - len(OPEN)).alias("inner"),
        F.sum(F.length("content")).over(Window.partitionBy("conv_id", "message")).cast("int").alias("length"),
    )


def format_chats(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts", loss_roles: tuple[str, ...] = ("assistant",), tokens_per_unit: dict[str, float] = TOKENS_PER_UNIT) -> DataFrame:
    """One row per conversation: conv_id, formatted text, loss mask, attachments, expanded tokens.

    `loss_spans` holds (start, length) in code points of `formatted`, one for
    each message of a role in `loss_roles`. `loss_mask` says the same turn by
    turn, counted from the end of the turn's opening; null for other roles.
    Messages of one conversation meet in one row, which the output needs;
    conversations spread over all tasks.
    """
    rows = messages.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(parts).cast(f"array<{PART}>"), F.array().cast(f"array<{PART}>")).alias("parts"))
    piece = F.struct("message", "part", "piece", "role", "number", "type", "ref", "tokens", "start", "inner", "length")
    grouped = visited(rows, tokens_per_unit).groupBy("conv_id").agg(F.array_sort(F.collect_list(piece)).alias("pieces"), F.sum("tokens").cast("long").alias("expanded_tokens"))
    firsts = F.filter("pieces", lambda x: x["part"] == 0)
    learnt = lambda x: x["role"].isin(*loss_roles)
    return grouped.select(
        "conv_id",
        F.array_join(F.transform("pieces", lambda x: x["piece"]), "").alias("formatted"),
        F.transform(F.filter(firsts, learnt), lambda x: F.struct(x["start"].alias("start"), x["length"].alias("length"))).alias("loss_spans"),
        F.transform(firsts, lambda x: F.when(learnt(x), F.struct(x["inner"].alias("start"), x["length"].alias("length")))).alias("loss_mask"),
        F.transform(F.filter("pieces", lambda x: x["number"].isNotNull()), lambda x: F.struct(x["number"].alias("number"), x["type"].alias("type"), x["ref"].alias("ref"), x["tokens"].cast("long").alias("tokens"))).alias("attachments"),
        "expanded_tokens",
    )


def turn_texts(formatted: Column) -> Column:
    """Each turn of a formatted conversation after its opening."""
    return F.slice(F.split(formatted, OPEN, -1), 2, 1 << 30)


def read_back(formatted: Column) -> Column:
    """The (role, text) messages of a formatted conversation of text parts."""
    return F.transform(
        turn_texts(formatted),
        lambda b: F.struct(
            unescape(F.substring_index(b, ">\n", 1)).alias("role"),
            unescape(F.substring_index(F.substring(b, F.length(F.substring_index(b, ">\n", 1)) + 3, F.length(b)), CLOSE, 1)).alias("text"),
        ),
    )


def loss_text(formatted: Column, mask: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.array_join(F.zip_with(turn_texts(formatted), mask, lambda b, m: F.when(m.isNotNull(), unescape(F.substring(b, m["start"] + 1, m["length"])))), "")


EXTRA = "\\### Assistant: </turn> ok"


def op3_chat_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(EXTRA).alias("text"))
    chats = format_chats(rows.unionByName(extra).withColumn("parts", text_part(F.col("text"))))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return (
        chats.withColumn("turns", read_back(F.col("formatted")))
        .withColumn("loss", loss_text(F.col("formatted"), F.col("loss_mask")))
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2(turns, 256).alias("turns_sha256"),
            F.length("loss").cast("long").alias("loss_chars"),
            F.sha2("loss", 256).alias("loss_sha256"),
            F.length("formatted").cast("long").alias("formatted_chars"),
            F.size("attachments").cast("long").alias("n_attachments"),
            "expanded_tokens",
        )
    )


def typed_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations with an image in every second turn and a sound in every third, which SQL can format, too."""
    kinds = F.col("turn") % 2 == 0, F.col("turn") % 3 == 0
    part = lambda kind, ref, units: F.struct(F.lit(kind).alias("type"), F.lit(None).cast("string").alias("text"), F.concat(F.lit(ref), F.col("turn").cast("string")).alias("ref"), units.cast("double").alias("units"))
    more = F.array_compact(F.array(F.when(kinds[0], part("image", "i", F.col("turn") + 1)), F.when(kinds[1], part("audio", "a<", F.lit(None)))))
    rows = table(spark, sf_dir, "conversations").withColumn("parts", F.concat(text_part(F.col("text")), more.cast(f"array<{PART}>")))
    entry = lambda a: F.concat_ws(":", a["number"].cast("string"), a["type"], a["ref"], a["tokens"].cast("string"))
    return format_chats(rows).select("conv_id", "formatted", F.array_join(F.transform("attachments", entry), ",").alias("attachments"), "expanded_tokens", F.length(loss_text(F.col("formatted"), F.col("loss_mask"))).cast("long").alias("loss_chars"))


QUERIES = {"op3_chat_parts": op3_chat_parts, "typed_chats": typed_chats}

ORACLE = {
    "op3_chat_parts": r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
  SELECT *, length(role) + length(text) + length(regexp_replace(role || text, '[^<>\\]', '', 'g')) AS escaped,
         len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')) AS words
  FROM rows)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(escaped + length('<turn >' || '</turn>') + 2) AS BIGINT) AS formatted_chars,
       CAST(0 AS BIGINT) AS n_attachments, CAST(sum(words) AS BIGINT) AS expanded_tokens
FROM e GROUP BY conv_id""",
    "typed_chats": r"""
WITH m AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, turn % 2 = 0 AS seen, turn % 3 = 0 AS heard,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i FROM conversations),
n AS (SELECT *, coalesce(sum(CAST(seen AS INTEGER) + CAST(heard AS INTEGER)) OVER (PARTITION BY conv_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INTEGER AS k FROM m),
p AS (SELECT *, replace(replace(replace(text, '\', '\s'), '<', '\l'), '>', '\g') AS safe, CASE WHEN seen THEN '<image ' || (k + 1) || '>' ELSE '' END AS image,
         CASE WHEN heard THEN '<audio ' || (k + 1 + CAST(seen AS INTEGER)) || '>' ELSE '' END AS audio,
         len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')) + CASE WHEN seen THEN (turn + 1) * 256 ELSE 0 END + CASE WHEN heard THEN 13 ELSE 0 END AS tokens,
         concat_ws(',', CASE WHEN seen THEN (k + 1) || ':image:i' || turn || ':' || (turn + 1) * 256 END, CASE WHEN heard THEN (k + 1 + CAST(seen AS INTEGER)) || ':audio:a<' || turn || ':13' END) AS listed FROM n)
SELECT conv_id, string_agg('<turn ' || role || '>' || chr(10) || safe || image || audio || '</turn>' || chr(10), '' ORDER BY i) AS formatted, coalesce(string_agg(listed, ',' ORDER BY i) FILTER (listed <> ''), '') AS attachments,
       CAST(sum(tokens) AS BIGINT) AS expanded_tokens, CAST(coalesce(sum(length(text) + length(image) + length(audio)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars FROM p GROUP BY conv_id""",
}
