"""Quotation linking, in DataFrame functions alone.

Each line of a message has a quote level, the number of ``>`` marks in front. Lines of level 1 and more are quoted:
their text is normalised (ASCII white space runs to one blank, trimmed, lower case) and hashed, and joined by
conversation and hash to the earliest message of the conversation in which the line stands as own text (level 0).
The *parent* of a message is the earlier message that most of its level-1 text comes from (most characters; of equals
the latest); deeper levels count as links too. Replies point to earlier turns, so parents form trees; roots and depths
are found by doubling pointers, in as many rounds as the depth has binary digits. Sorted by ``conv_id, root_turn, depth,
turn`` every reply follows what it replies to. Texts are returned without quotes and without the lines that announce
them ("On ... wrote:").

Originals are one row per conversation and line before the join, so a line that many messages hold and quote joins
once per quote; hot conversations are split by the adaptive skew join.

Defined results: null text is an empty text. Rows without conversation or turn, and quotes of nothing earlier, have no
parent: they are roots (root_turn = turn, depth 0). Of repeated turns the first by hash stands for the turn as parent's
child; each row keeps its own text. Repeated rows give repeated rows; an empty table gives an empty table; further
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantflow.llm.common import GAP, pick, staged

MARKS = r"^[ \t]*(?:>[ \t]*)+"
ANNOUNCES = r"(?i)^(?:on|le|am|el) [^\n]{1,300}(?:wrote|écrit|schrieb|escribió) ?:$"


def _lines(text: Column) -> Column:
    """Array of (level, body, norm, next level) of the lines of a text."""
    marks = lambda line: F.regexp_extract(line, MARKS, 0)
    lines = F.transform(F.split(text, "\n"), lambda line: F.struct(
        (F.length(marks(line)) - F.length(F.replace(marks(line), F.lit(">"), F.lit("")))).alias("level"),
        F.regexp_replace(line, MARKS, "").alias("body")))
    return F.transform(lines, lambda x: F.struct(
        x["level"].alias("level"), x["body"].alias("body"),
        F.lower(F.trim(F.regexp_replace(x["body"], GAP, " "))).alias("norm")))


def linked_messages(
    messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text", role_col: str = "role",
) -> DataFrame:
    """``conv_id, turn, role, own_text, n_quoted_lines, n_linked_lines, max_level, parent_turn, root_turn, depth``."""
    rows = pick(messages, conv_col, turn_col, text_col, role_col).toDF("conv", "turn", "text", "role").select(
        F.col("conv").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), "role",
        F.coalesce("text", F.lit("")).alias("text"))
    lines = rows.select("conv", "turn", "role", F.xxhash64("text").alias("mark"), _lines(F.col("text")).alias("lines"))
    cut = lines.select(
        "conv", "turn", "role", "mark", F.filter("lines", lambda x: (x["level"] > 0) & (x["norm"] != "")).alias("quoted"),
        F.filter("lines", lambda x: (x["level"] == 0) & (x["norm"] != "")).alias("plain"),
        F.trim(F.array_join(F.transform(_own_lines(), lambda x: x["body"]), "\n"), F.lit(" \t\r\n")).alias("own_text"),
    )
    usable = "conv IS NOT NULL AND turn IS NOT NULL"
    quotes = staged(
        cut.where(usable).where(F.size("quoted") > 0).select("conv", "turn", "mark", F.explode("quoted").alias("q")).select(
            "conv", "turn", "mark", F.xxhash64("q.norm").alias("line"), F.col("q.level").alias("level"),
            F.length("q.norm").alias("chars")), "quotes")
    asked = quotes.select("conv", "line").distinct()
    originals = (
        cut.where(usable).select("conv", "turn", F.explode("plain").alias("p"))
        .select("conv", "turn", F.xxhash64("p.norm").alias("line"))
        .join(asked, ["conv", "line"], "left_semi").groupBy("conv", "line").agg(F.min("turn").alias("source"))
    )
    links = quotes.join(originals, ["conv", "line"]).where("source < turn")
    votes = links.groupBy("conv", "turn", "mark", "source").agg(
        F.sum(F.when(F.col("level") == 1, F.col("chars")).otherwise(0)).alias("chars"), F.count("*").alias("n"))
    parents = staged(
        votes.groupBy("conv", "turn", "mark").agg(
            F.max(F.when(F.col("chars") > 0, F.struct("chars", "source")))["source"].alias("parent"),
            F.sum("n").alias("linked")), "parents")
    roots = _roots(parents)
    joined = cut.join(parents, ["conv", "turn", "mark"], "left").join(
        roots.withColumnRenamed("turn", "parent"), ["conv", "parent"], "left")
    top = F.when(F.col("parent").isNull(), F.col("turn")).otherwise(F.coalesce("root", "parent"))
    return joined.select(
        F.col("conv").alias("conv_id"), "turn", "role", "own_text", F.size("quoted").cast("long").alias("n_quoted_lines"),
        F.coalesce("linked", F.lit(0)).alias("n_linked_lines"),
        F.coalesce(F.array_max(F.transform("quoted", lambda x: x["level"])), F.lit(0)).cast("long").alias("max_level"),
        F.col("parent").alias("parent_turn"), top.alias("root_turn"),
        F.when(F.col("parent").isNull(), 0).otherwise(F.coalesce("depth", F.lit(0)) + 1).cast("long").alias("depth"),
    )


def _own_lines() -> Column:
    """Lines of level 0, but for one that announces the quote after it."""
    return F.filter("lines", lambda x, i: (x["level"] == 0) & ~(
        x["body"].rlike(ANNOUNCES) & (F.coalesce(F.get("lines", i + 1)["level"], F.lit(0)) > 0)))


def _roots(parents: DataFrame) -> DataFrame:
    """``conv, turn, root, depth`` of every turn that has a parent, by doubling."""
    at = staged(
        parents.where("parent IS NOT NULL").groupBy("conv", "turn").agg(F.min(F.struct("mark", "parent"))["parent"].alias("root"))
        .withColumn("depth", F.lit(1).cast("long")), "up")
    while True:
        up = at.select("conv", F.col("turn").alias("root"), F.col("root").alias("over"), F.col("depth").alias("more"))
        further = at.join(up, ["conv", "root"])
        if not further.limit(1).count():
            return at
        at = staged(
            at.join(up, ["conv", "root"], "left").select(
                "conv", "turn", F.coalesce("over", "root").alias("root"),
                (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")), "up")


# The same in SQL (turns of a conversation are taken to be different).
ORACLE_SQL = r"""
WITH RECURSIVE m AS (
  SELECT row_number() OVER () AS rid, conv_id, turn, role, string_split(coalesce(text, ''), chr(10)) AS parts
  FROM conversations
), cut AS (
  SELECT rid, conv_id, turn, i, regexp_extract(parts[i], '^[ \t]*(?:>[ \t]*)+') AS marks,
         regexp_replace(parts[i], '^[ \t]*(?:>[ \t]*)+', '') AS body
  FROM (SELECT *, unnest(generate_series(1, len(parts))) AS i FROM m)
), line AS (
  SELECT rid, conv_id, turn, i, body, length(marks) - length(replace(marks, '>', '')) AS level,
         lower(trim(regexp_replace(body, '[\x20\x09-\x0D]+', ' ', 'g'))) AS norm,
         lead(length(marks) - length(replace(marks, '>', '')), 1, 0) OVER (PARTITION BY rid ORDER BY i) AS next_level
  FROM cut
), own AS (
  SELECT rid, coalesce(trim(string_agg(body, chr(10) ORDER BY i) FILTER (level = 0 AND NOT (next_level > 0 AND regexp_matches(
           body, '(?i)^(?:on|le|am|el) [^\n]{1,300}(?:wrote|écrit|schrieb|escribió) ?:$'))), chr(32) || chr(9) || chr(13) || chr(10)), '') AS own_text,
         count(*) FILTER (level > 0 AND norm <> '') AS n_quoted_lines,
         coalesce(max(level) FILTER (level > 0 AND norm <> ''), 0) AS max_level
  FROM line GROUP BY rid
), original AS (
  SELECT conv_id, norm, min(turn) AS source FROM line
  WHERE level = 0 AND norm <> '' AND conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY 1, 2
), vote AS (
  SELECT l.rid, l.conv_id, l.turn, o.source, sum(CASE WHEN l.level = 1 THEN length(l.norm) ELSE 0 END) AS chars, count(*) AS n
  FROM line l JOIN original o USING (conv_id, norm) WHERE l.level > 0 AND o.source < l.turn GROUP BY 1, 2, 3, 4
), parent AS (
  SELECT rid, conv_id, turn, (max({'c': chars, 's': source}) FILTER (chars > 0)).s AS parent, sum(n) AS linked
  FROM vote GROUP BY 1, 2, 3
), up AS (
  SELECT rid, conv_id, parent AS above, 1 AS depth FROM parent WHERE parent IS NOT NULL
  UNION ALL
  SELECT u.rid, u.conv_id, p.parent, u.depth + 1 FROM up u JOIN parent p ON p.conv_id = u.conv_id AND p.turn = u.above
  WHERE p.parent IS NOT NULL
), root AS (SELECT rid, max(depth) AS depth, arg_max(above, depth) AS root FROM up GROUP BY rid)
SELECT m.conv_id, m.turn, m.role, o.own_text, o.n_quoted_lines, CAST(coalesce(p.linked, 0) AS BIGINT) AS n_linked_lines,
       CAST(o.max_level AS BIGINT) AS max_level, p.parent AS parent_turn, coalesce(r.root, m.turn) AS root_turn,
       CAST(coalesce(r.depth, 0) AS BIGINT) AS depth
FROM m JOIN own o USING (rid) LEFT JOIN parent p USING (rid) LEFT JOIN root r USING (rid)
"""
