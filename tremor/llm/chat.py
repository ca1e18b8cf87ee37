"""Chat formatting with Spark expressions only.

Template: ``<s>`` opens a conversation; adjacent turns of one role form one
block. A block of the role ``assistant`` is ``[ASST]text</s>``, any other
block is ``[INST]role[:]text[/INST]``; the texts of a merged block are joined
by ``[+]``, so every turn can be read back. Control strings inside a text or
role get a tilde after their first character (one more if they already have
some), which is undone on reading. The loss mask lists (start, length) in
code points of each assistant text in the formatted string.

Defined cases: a null text or role counts as empty; turns sort by (turn, role,
text), nulls first, so ties and repeated rows have one order and are all
kept; rows with a null conv_id form one conversation; an empty table gives an
empty table; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.session import table

CONTROL = r"(/?s>|/?INST\]|ASST\]|:\]|\+\])"
ESCAPE = (rf"([<\[])(~*){CONTROL}", "$1~$2$3")
UNESCAPE = (rf"([<\[])~(~*){CONTROL}", "$1$2$3")
ASSISTANT = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, *ESCAPE)


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, *UNESCAPE)


def format_chats(turns: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_mask array<struct<start,length>> from rows (conv_id, turn, role, text)."""
    rows = turns.select(
        "conv_id",
        F.struct(
            "turn",
            F.coalesce(F.col("role"), F.lit("")).alias("role"),
            F.coalesce(F.col("text"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def piece(t: Column, i: Column) -> Column:
        before, after = F.get(F.col("turns"), i - 1), F.get(F.col("turns"), i + 1)
        opens = ~(before["role"].eqNullSafe(t["role"]))
        closes = ~(after["role"].eqNullSafe(t["role"]))
        mine = t["role"] == ASSISTANT
        head = F.when(mine, F.lit("[ASST]")).otherwise(F.concat(F.lit("[INST]"), escape(t["role"]), F.lit("[:]")))
        tail = F.when(mine, F.lit("</s>")).otherwise(F.lit("[/INST]"))
        return F.struct(
            mine.alias("loss"),
            F.when(opens, head).otherwise(F.lit("")).alias("head"),
            escape(t["text"]).alias("body"),
            F.when(closes, tail).otherwise(F.lit("[+]")).alias("tail"),
        )

    parts = chats.select("conv_id", F.transform("turns", piece).alias("parts"))
    spans = F.aggregate(
        "parts",
        F.struct(F.lit(3).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("mask")),
        lambda acc, p: F.struct(
            (acc["at"] + F.length(p["head"]) + F.length(p["body"]) + F.length(p["tail"])).cast("long").alias("at"),
            F.when(
                p["loss"],
                F.array_append(
                    acc["mask"],
                    F.struct(
                        (acc["at"] + F.length(p["head"])).cast("long").alias("start"),
                        F.length(p["body"]).cast("long").alias("length"),
                    ),
                ),
            ).otherwise(acc["mask"]).alias("mask"),
        ),
        lambda acc: acc["mask"],
    )
    text = F.transform("parts", lambda p: F.concat(p["head"], p["body"], p["tail"]))
    return parts.select("conv_id", F.concat(F.lit("<s>"), F.array_join(text, "")).alias("formatted"), spans.alias("loss_mask"))


def read_chats(formatted: DataFrame) -> DataFrame:
    """conv_id, turns array<struct<role,text>>, loss_texts array<string> parsed from the formatted strings."""
    body = F.expr("substring(formatted, 4)")
    blocks = F.filter(F.split(body, r"(?=\[INST\]|\[ASST\])"), lambda b: b != "")

    def parse(b: Column) -> Column:
        mine = F.startswith(b, F.lit("[ASST]"))
        role = F.when(mine, F.lit(ASSISTANT)).otherwise(
            unescape(F.regexp_extract(b, r"(?s)^\[INST\](.*?)\[:\]", 1))
        )
        content = F.when(mine, F.regexp_extract(b, r"(?s)^\[ASST\](.*)</s>$", 1)).otherwise(
            F.regexp_extract(b, r"(?s)^\[INST\].*?\[:\](.*)\[/INST\]$", 1)
        )
        return F.transform(F.split(content, r"\[\+\]", -1), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return formatted.select(
        "conv_id",
        "formatted",
        F.flatten(F.transform(blocks, parse)).alias("turns"),
        F.transform(
            "loss_mask", lambda m: unescape(F.substring(F.col("formatted"), (m["start"] + 1).cast("int"), m["length"].cast("int")))
        ).alias("loss_texts"),
    )


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: all conversations plus conversation -7, formatted and read back."""
    own = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(ASSISTANT).alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join("loss_texts", "")
    return read_chats(format_chats(rows)).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLE_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, length(regexp_replace(text, '([<\[])(~*)(/?s>|/?INST\]|ASST\]|:\]|\+\])', '\1~\2\3', 'g')) AS n_text,
    length(regexp_replace(role, '([<\[])(~*)(/?s>|/?INST\]|ASST\]|:\]|\+\])', '\1~\2\3', 'g')) AS n_role,
    lag(role) OVER w IS DISTINCT FROM role AS opens, lead(role) OVER w IS DISTINCT FROM role AS closes
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  (3 + sum(n_text + CASE WHEN NOT opens THEN 0 WHEN role = 'assistant' THEN 6 ELSE 9 + n_role END
    + CASE WHEN NOT closes THEN 3 WHEN role = 'assistant' THEN 4 ELSE 7 END))::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
