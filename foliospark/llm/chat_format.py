r"""Chat formatting: typed content parts become one text with marked turns, a loss mask and attachments.

A visitor, one branch for each kind of part, flattens a turn's parts in order: text as it is, image, audio
and document as placeholders that are numbered through the conversation, with their turn's place, the
reference and the count of tokens that the placeholder expands to (its units times the kind's rate, 1 at least).

The template writes a turn as `### role:\n`, its body, `</turn>\n`. Inside roles and texts `\` becomes `\b`,
`<` `\l` and `#` `\h` (in roles also `:` `\c` and a newline `\n`), so control strings can only come from the
template, and undoing the replacements in the opposite order gives every text back.

Offsets and numbers are running sums over a conversation's turns in order, so a long conversation takes time
in proportion to its turns.

Cases: a null or unknown part gives nothing; null text and null role are empty; turns are ordered by turn,
then role, then their texts, nulls first, and equal ones by their attachments; a null conv_id is a conversation of its own; repeated rows are repeated
turns; an empty table gives no rows. Only conv_id, turn, role and text (or parts) are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table

#: Tokens that a unit of a kind expands to: image tiles, audio seconds, document pages.
RATES = {"image": 256, "audio": 25, "document": 600}
ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"))
ROLE_ESCAPES = (*ESCAPES, (":", "\\c"), ("\n", "\\n"))
TURN_END = "</turn>\n"
PARTS = "array<struct<kind:string,text:string,ref:string,units:int>>"


def escape(text: Column, pairs: tuple = ESCAPES) -> Column:
    for raw, safe in pairs:
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def unescape(text: Column, pairs: tuple = ESCAPES) -> Column:
    for raw, safe in reversed(pairs):
        text = F.replace(text, F.lit(safe), F.lit(raw))
    return text


def text_parts(text: Column) -> Column:
    """A turn's plain text as its only part."""
    part = F.struct(F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("units"))
    return F.array(part).cast(PARTS)


def attached(parts: Column) -> Column:
    return F.filter(F.coalesce(parts, F.array().cast(PARTS)), lambda p: p["kind"].isin(*RATES))


def visit(parts: Column, before: Column) -> Column:
    """(body, attachments) of a turn: the flattened parts, and of each attached one number, kind, ref, tokens in order; `before` are attached earlier."""
    every = F.coalesce(parts, F.array().cast(PARTS))
    places = F.filter(F.transform(every, lambda p, i: F.when(p["kind"].isin(*RATES), i)), lambda i: i.isNotNull())
    flat = F.transform(
        every,
        lambda p, i: F.when(p["kind"] == "text", escape(F.coalesce(p["text"], F.lit(""))))
        .when(p["kind"].isin(*RATES), F.concat(F.lit("<"), p["kind"], F.lit(" "), (before + F.array_position(places, i)).cast("string"), F.lit(">")))
        .otherwise(F.lit("")),
    )
    rate = F.create_map(*[F.lit(x) for pair in RATES.items() for x in pair])
    refs = F.transform(
        attached(parts),
        lambda p, i: F.struct((before + i + 1).cast("int").alias("number"), p["kind"].alias("kind"), p["ref"].alias("ref"), (rate[p["kind"]] * F.greatest(F.coalesce(p["units"], F.lit(1)), F.lit(1))).alias("tokens")),
    )
    return F.struct(F.array_join(flat, "").alias("body"), refs.alias("attachments"))


def format_chats(turns: DataFrame, learn_role: str = "assistant") -> DataFrame:
    """conv_id, formatted, loss_mask (start, end in code points of each learned body), attachments (turn's place from 0, number, kind, ref, tokens).

    turns has conv_id, turn, role and parts (see PARTS).
    """
    said = F.array_join(F.transform(F.coalesce("parts", F.array().cast(PARTS)), lambda p: F.coalesce(p["text"], F.lit(""))), "")
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), "parts", said.alias("said"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "said", F.to_json("parts"))
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("place", F.row_number().over(order) - 1).withColumn("before", F.coalesce(F.sum(F.size(attached(F.col("parts")))).over(earlier), F.lit(0)))
    rows = rows.select("conv_id", "turn", "role", "said", "parts", "place", visit(F.col("parts"), F.col("before")).alias("v"))
    head = F.concat(F.lit("### "), escape(F.col("role"), ROLE_ESCAPES), F.lit(":\n"))
    rows = rows.select("conv_id", "turn", "role", "said", "parts", "place", head.alias("head"), F.col("v.body").alias("body"), F.col("v.attachments").alias("attachments"))
    width = F.length("head") + F.length("body") + len(TURN_END)
    rows = rows.withColumn("start", (F.coalesce(F.sum(width).over(earlier), F.lit(0)) + F.length("head")).cast("int"))
    each = F.struct(
        "place", F.concat("head", "body", F.lit(TURN_END)).alias("text"), (F.col("role") == learn_role).alias("learn"), "start", (F.col("start") + F.length("body")).alias("end"),
        F.transform("attachments", lambda a: F.struct(F.col("place").alias("turn"), a["number"].alias("number"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens"))).alias("attachments"),
    )
    chats = rows.select("conv_id", each.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("p"))
    mask = F.transform(F.filter("p", lambda t: t["learn"]), lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end")))
    return chats.select("conv_id", F.array_join(F.transform("p", lambda t: t["text"]), "").alias("formatted"), mask.alias("loss_mask"), F.flatten(F.transform("p", lambda t: t["attachments"])).alias("attachments"))


def parts_of(body: Column) -> Column:
    """(kind, text, number) of a body's stretches: in it an unescaped `<` only begins a placeholder, so a text that looks like one stays text."""
    pieces = F.split(body, "<", -1)

    def stretches(piece: Column, i: Column) -> Column:
        mark, rest = F.substring_index(piece, ">", 1), F.when(i == 0, piece).otherwise(F.substring(piece, F.length(F.substring_index(piece, ">", 1)) + 2, F.length(piece)))
        text = F.struct(F.lit("text").alias("kind"), unescape(rest).alias("text"), F.lit(None).cast("int").alias("number"))
        place = F.struct(F.substring_index(mark, " ", 1).alias("kind"), F.lit(None).cast("string").alias("text"), F.substring_index(mark, " ", -1).try_cast("int").alias("number"))
        return F.when(i == 0, F.array(text)).otherwise(F.array(place, text))

    return F.filter(F.flatten(F.transform(pieces, stretches)), lambda p: ~((p["kind"] == "text") & (p["text"] == "")))


def read_back(chats: DataFrame) -> DataFrame:
    """conv_id, turns (role, text with placeholders as they are, parts), learned (the text under the mask, unescaped), formatted: parsed from format_chats' output alone."""
    found = F.filter(F.split("formatted", TURN_END), lambda x: x != "")

    def turn(x: Column) -> Column:
        role = F.substring_index(x, ":\n", 1)
        body = F.substring(x, F.length(role) + 3, F.length(x))
        return F.struct(unescape(F.substring(role, F.lit(5), F.length(x)), ROLE_ESCAPES).alias("role"), unescape(body).alias("text"), parts_of(body).alias("parts"))

    learned = F.array_join(F.transform("loss_mask", lambda m: unescape(F.substring(F.col("formatted"), m["start"] + 1, m["end"] - m["start"]))), "")
    return chats.select("conv_id", F.transform(found, turn).alias("turns"), learned.alias("learned"), "formatted")


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    said = F.lit("\\### Assistant: </turn> ok")
    two = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"), said.alias("text"))
    back = read_back(format_chats(rows.unionByName(two).select("conv_id", "turn", "role", text_parts(F.col("text")).alias("parts"))))
    digest = F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256)
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), digest.alias("turns_sha256"), F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP3_SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
x AS (SELECT *, length(text) + length(regexp_replace(text, '[^\\<#]', '', 'g')) AS body,
      length(role) + length(regexp_replace(role, '[^\\<#:\n]', '', 'g')) AS head FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(4 + head + 2 + body + 8) AS BIGINT) AS formatted_chars
FROM x GROUP BY conv_id
"""
