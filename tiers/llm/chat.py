"""Chat formatting in budgeted windows, with built-in column functions only.

A conversation's turns are laid on a line of tokens by prefix sums. Windows are turn-aligned spans of that line: a turn of
more than half the room is a span by itself, and the others belong to the half-room in which they end, so that a span
never exceeds the room unless a single turn does. A window repeats the conversation's system turn and the turns before it
that fit a history budget; repeated turns are not learned from again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Tokens of a window and of the history it repeats; tokens that a turn's marks take.
BUDGET, HISTORY, MARKS = 512, 128, 4
#: Marks of the template. Texts cannot hold them: their `<` and `[` are written as references.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
TOKEN = "[0-9A-Za-z_]+|[^0-9A-Za-z_\\x09-\\x0D\\x20]"
REFERENCES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))


def escape(text: Column, line: bool = False) -> Column:
    for plain, coded in (*REFERENCES, *((("\n", "&#10;"),) if line else ())):
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column, line: bool = False) -> Column:
    for plain, coded in ((("\n", "&#10;"),) if line else ()) + REFERENCES[::-1]:
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """A row per window: conv_id, window (from 1), context (turns repeated), formatted, loss (begin and length of each span).

    Turns are in order of turn (NULL first), then role and text; NULL roles and texts are empty. The first turn with role
    `system` is the one retained. Offsets count characters from 1. A turn above the budget keeps its whole text. Rows with
    a NULL conv_id are one conversation.
    """
    turns = conversations.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("tokens", (F.regexp_count("text", F.lit(TOKEN)) + MARKS).cast("long"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    placed = turns.withColumn("end", F.sum("tokens").over(order)).withColumn("start", F.col("end") - F.col("tokens"))
    line = Window.partitionBy("conv_id").orderBy("start")
    past = line.rangeBetween(-history, 0)
    whole = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    item = F.struct("start", "role", "text")
    system = F.first(F.when(F.col("role") == "system", F.struct("start", "role", "text", "tokens")), ignorenulls=True).over(whole)
    placed = placed.withColumn("system", system).withColumn("history", F.collect_list(item).over(past))
    half = F.greatest(budget - history - F.coalesce("system.tokens", F.lit(0)), F.lit(budget // 4)) / 2
    place = F.when(F.col("tokens") > half, -F.col("end")).otherwise(F.floor((F.col("end") - 1) / half))
    placed = placed.withColumn("place", place)
    begins = F.coalesce(F.lag("place").over(line) != F.col("place"), F.lit(True)).cast("int")
    placed = placed.withColumn("begins", begins).withColumn("window", F.sum("begins").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    spans = placed.groupBy("conv_id", "window").agg(
        F.first("system").alias("system"),
        F.min("start").alias("from"),
        F.min_by("history", "start").alias("history"),
        F.array_sort(F.collect_list(item)).alias("turns"),
    )
    before = F.expr("filter(array_sort(history), h -> h.start < from)")
    ahead = F.expr("if(system.start < coalesce(get(before, 0).start, from), array(named_struct('start', system.start, 'role', system.role, 'text', system.text)), array())")
    spans = spans.withColumn("before", before).withColumn("before", F.concat(ahead, "before"))

    def written(t: Column) -> Column:
        return F.concat(F.lit(OPEN), escape(t["role"], True), F.lit("\n"), escape(t["text"]), F.lit(CLOSE))

    spans = spans.select(
        "conv_id",
        "window",
        F.size("before").alias("context"),
        F.transform("before", written).alias("old"),
        F.transform("turns", lambda t: F.struct(written(t).alias("text"), t["role"].alias("role"), F.length(escape(t["text"])).alias("n"))).alias("new"),
    )
    first = F.length(F.array_join("old", "")) + 1
    step = F.aggregate(
        "new",
        F.struct(first.cast("int").alias("at"), F.expr("cast(array() as array<struct<begin:int,length:int>>)").alias("loss")),
        lambda s, t: F.struct(
            (s["at"] + F.length(t["text"])).cast("int").alias("at"),
            F.when(
                t["role"] == "assistant",
                F.concat(s["loss"], F.array(F.struct((s["at"] + F.length(t["text"]) - len(CLOSE) - t["n"]).cast("int").alias("begin"), t["n"].cast("int").alias("length")))),
            ).otherwise(s["loss"]).alias("loss"),
        ),
    )
    text = F.concat(F.array_join("old", ""), F.array_join(F.transform("new", lambda t: t["text"]), ""))
    return spans.select("conv_id", "window", "context", text.alias("formatted"), step["loss"].alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """A row per conversation, from what `windows` wrote: its turns (role, line feed, text, line feed) and learned texts."""
    parts = F.expr(f"slice(split(formatted, '{OPEN.replace('|', chr(92) * 2 + '|')}'), context + 2, size(split(formatted, '{OPEN.replace('|', chr(92) * 2 + '|')}')))")
    plain = F.transform(
        parts,
        lambda p: F.concat(
            unescape(F.substring_index(p, "\n", 1), True),
            F.lit("\n"),
            unescape(p.substr(F.length(F.substring_index(p, "\n", 1)) + 2, F.length(p) - F.length(F.substring_index(p, "\n", 1)) - 1 - len(CLOSE))),
            F.lit("\n"),
        ),
    )
    learned = F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), s["begin"], s["length"])))
    rows = formatted.select(
        "conv_id",
        F.struct("window", F.array_join(plain, "").alias("turns"), F.array_join(learned, "").alias("learned")).alias("part"),
        F.size(parts).alias("n"),
        F.length("formatted").alias("chars"),
    )
    whole = rows.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.array_sort(F.collect_list("part")).alias("parts"), F.sum("chars").alias("formatted_chars"), F.count("*").alias("n_windows")
    )
    text = F.array_join(F.transform("parts", lambda p: p["turns"]), "")
    loss = F.array_join(F.transform("parts", lambda p: p["learned"]), "")
    return whole.select("conv_id", "n_turns", text.alias("turns"), loss.alias("loss"), "formatted_chars", "n_windows")


def digests(conversations: DataFrame) -> DataFrame:
    """Formatted and read back: what came through, as digests."""
    back = read_back(windows(conversations))
    return back.select(
        "conv_id",
        "n_turns",
        F.sha2("turns", 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


ORACLE = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), sized AS (
  SELECT *, len(regexp_extract_all(text, '[0-9A-Za-z_]+|[^0-9A-Za-z_\x09-\x0D\x20]')) + 4 AS tokens,
    12 + length(replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&#91;'), chr(10), '&#10;')) + 1
      + length(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&#91;')) + 11 AS chars
  FROM turns
), placed AS (
  SELECT *, sum(tokens) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING) - tokens AS start
  FROM sized
), lead AS (
  SELECT conv_id, min_by(tokens, start) AS tokens, min(start) AS start, min_by(chars, start) AS chars FROM placed
  WHERE role = 'system' GROUP BY conv_id
), room AS (
  SELECT p.*, l.start AS s_start, l.chars AS s_chars, greatest(384 - coalesce(l.tokens, 0), 128) / 2.0 AS half,
    sum(p.chars) OVER w - p.chars AS h_chars, min(p.start) OVER w AS h_start
  FROM placed p LEFT JOIN lead l ON l.conv_id IS NOT DISTINCT FROM p.conv_id
  WINDOW w AS (PARTITION BY p.conv_id ORDER BY p.start RANGE BETWEEN 128 PRECEDING AND CURRENT ROW)
), spot AS (
  SELECT *, CASE WHEN tokens > half THEN -(start + tokens) ELSE floor((start + tokens - 1) / half) END AS place FROM room
), cut AS (
  SELECT *, coalesce(lag(place) OVER (PARTITION BY conv_id ORDER BY start) <> place, true) AS begins FROM spot
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY start)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY start) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars + CASE WHEN begins THEN h_chars + CASE WHEN s_start < h_start THEN s_chars ELSE 0 END ELSE 0 END) AS BIGINT) AS formatted_chars
FROM cut GROUP BY conv_id
"""
