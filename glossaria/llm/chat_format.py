"""Chat formatting: one view of a dialogue for each of its speakers.

In a speaker's view that speaker is the assistant, everyone else is a user with a name, and the mask covers what the
assistant says. Built of DataFrame functions only.

Dialogues as a rule are short and are gathered whole, by one shuffle. A long one is rendered in parts, consecutive runs
of its messages, so that no row or task holds more than a few hundred of them, even where a dialogue has a third of
all messages or a turn has no bound. Every speaker has a row for every part, silent or not, and places count from the
dialogue's begin, so that the parts in a row are the whole view.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from glossaria.llm.common import stage, table

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
#: Turns of a part of a long dialogue, and rows that one may have before messages of equal turns are told apart too.
PART_TURNS, CROWD = 256, 1024
#: Ids of long dialogues are broadcast up to this many; beyond, the joins shuffle.
BROADCAST_DIALOGUES = 500_000
#: Roles that give instructions and take no part.
INSTRUCTORS = ("system",)


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """A join on ``keys`` that counts null as a value; ``right``'s keys go."""
    named = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return left.join(named, on, how).drop(*(f"__{k}" for k in keys))


def _in_order(said: Column) -> Column:
    """Messages by turn, then the hash of role and text, then the role."""
    told = F.transform(said, lambda m: F.struct(m["turn"].alias("turn"), _digest(m["role"], m["text"]).alias("digest"), m["role"].alias("role"), m["text"].alias("text")))
    return F.array_sort(told)


def _digest(role: Column, text: Column) -> Column:
    return F.md5(F.concat(F.coalesce(role, F.lit("")), F.lit(":"), text))


def _takes_part(role: Column, instructors: Sequence[str]) -> Column:
    return role.isNotNull() & ~role.isin(*instructors)


def _laid(views: DataFrame, instructors: Sequence[str]) -> DataFrame:
    """Adds ``messages`` to ``said`` and ``speaker``; numbers and places count from the part's begin."""

    def head(m: Column) -> Column:
        other = F.when(m["role"].isin(*instructors), m["role"]).otherwise(F.concat(F.lit("user"), F.coalesce(F.concat(F.lit(" name="), m["role"]), F.lit(""))))
        return F.concat(F.lit(OPEN), F.when(m["role"] == F.col("speaker"), F.lit("assistant")).otherwise(other), F.lit("\n"))

    tail = F.lit(CLOSE + "\n")
    drawn = F.transform("said", lambda m: F.struct(head(m).alias("head"), F.concat(m["text"], tail).alias("body"), F.coalesce(m["role"] == F.col("speaker"), F.lit(False)).alias("own")))
    none = F.array().cast("array<struct<number:bigint,start:bigint,rendered:string,mask_start:bigint,mask_end:bigint>>")

    def step(acc: Column, p: Column) -> Column:
        mask = acc["chars"] + F.length(p["head"])
        end = mask + F.length(p["body"])
        message = F.struct(
            F.size(acc["messages"]).cast("long").alias("number"), acc["chars"].alias("start"), F.concat(p["head"], p["body"]).alias("rendered"),
            F.when(p["own"], mask).alias("mask_start"), F.when(p["own"], end - 1).alias("mask_end"),  # without the newline after the mark
        )
        return F.struct(end.cast("long").alias("chars"), F.concat(acc["messages"], F.array(message)).alias("messages"))

    made = F.aggregate(drawn, F.struct(F.lit(0).cast("long").alias("chars"), none.alias("messages")), step)
    return views.withColumn("made", made).select(*(c for c in views.columns if c != "said"), "made.messages", "made.chars")


def _moved(messages: Column, numbers: Column, places: Column) -> Column:
    return F.transform(messages, lambda m: F.struct((m["number"] + numbers).alias("number"), (m["start"] + places).alias("start"), m["rendered"].alias("rendered"), (m["mask_start"] + places).alias("mask_start"), (m["mask_end"] + places).alias("mask_end")))


def rotate(dialogues: DataFrame, instructors: Sequence[str] = INSTRUCTORS, part_turns: int = PART_TURNS, crowd: int = CROWD) -> DataFrame:
    """Renders every dialogue once for each speaker in it.

    Input: ``conv_id``, ``turn``, ``role`` (who speaks), ``text``; other columns are not read. Output: ``conv_id``,
    ``speaker``, ``part`` (0, 1, ...; 0 alone for all but long dialogues), ``n_messages``, ``start`` (characters of the
    view before this part), ``rendered``, ``mask``: an array of ``start`` and ``end`` (long; characters of the view, end
    exclusive) of the speaker's texts with their closing marks, and ``messages``: an array of each message's ``number`` in the
    dialogue, ``start``, ``rendered``, ``mask_start`` and ``mask_end`` (null for messages of others).

    Messages are ordered by turn, then the hash of role and text; a null turn comes first and a null text is
    empty. Rows that repeat in all four columns are one message. Messages without a role are rendered as a nameless
    user and get no view of their own; nor do ``instructors``, whose messages keep their role. A dialogue of instructors
    alone gives no row. Null dialogue ids are one dialogue. An empty table gives an empty result.
    """
    told = dialogues.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text")).withColumn("run", F.floor(F.col("turn") / part_turns).cast("long"))
    runs = stage(told.groupBy("conv_id", "run").agg(F.count(F.lit(1)).alias("rows")), "dialogue-runs")
    long = stage(runs.groupBy("conv_id").agg(F.count(F.lit(1)).alias("runs"), F.max("rows").alias("most")).where((F.col("runs") > 1) | (F.col("most") > crowd)).select("conv_id"), "dialogues-long")
    some_long = not long.isEmpty()
    if some_long:
        checked = F.broadcast(long) if long.count() <= BROADCAST_DIALOGUES else long
        short = _null_safe(told, checked, ["conv_id"], "left_anti")
    else:
        short = told
    # A set: copies of a message fall together before the shuffle.
    message = F.struct("turn", "role", "text")
    whole = short.groupBy("conv_id").agg(F.collect_set(message).alias("said")).select("conv_id", _in_order(F.col("said")).alias("said"))
    speakers = F.array_distinct(F.filter(F.transform("said", lambda m: m["role"]), lambda r: _takes_part(r, instructors)))
    out = _laid(whole.select("conv_id", F.lit(0).cast("long").alias("part"), F.explode(speakers).alias("speaker"), "said"), instructors).withColumn("start", F.lit(0).cast("long"))
    columns = ["conv_id", "speaker", "part", "start", "messages"]
    out = out.select(*columns)
    if some_long:
        out = out.unionByName(_in_parts(_null_safe(told, checked, ["conv_id"], "left_semi"), runs, instructors, crowd).select(*columns))
    spans = F.transform(F.filter("messages", lambda m: m["mask_start"].isNotNull()), lambda m: F.struct(m["mask_start"].alias("start"), m["mask_end"].alias("end")))
    rendered = F.array_join(F.transform("messages", lambda m: m["rendered"]), "")
    return out.select("conv_id", "speaker", "part", F.size("messages").cast("long").alias("n_messages"), "start", rendered.alias("rendered"), spans.alias("mask"), "messages")


def _in_parts(told: DataFrame, runs: DataFrame, instructors: Sequence[str], crowd: int) -> DataFrame:
    """Long dialogues: a part for each run of turns, or for each turn and beginning of the messages' hash where a run is crowded."""
    crowded = runs.where(F.col("rows") > crowd).select("conv_id", "run", F.ceil(F.log(16.0, F.col("rows") / crowd)).cast("int").alias("hex"))
    cut = _null_safe(told, crowded, ["conv_id", "run"], "left")
    cut = cut.withColumn("fine", F.when(F.col("hex").isNotNull(), F.struct("turn", F.expr("substring(md5(concat(coalesce(role, ''), ':', text)), 1, hex)").alias("begin")))).drop("hex")
    cells = ["conv_id", "run", "fine"]
    held = stage(cut.groupBy(*cells).agg(F.collect_set(F.struct("turn", "role", "text")).alias("said")), "dialogue-parts")
    sized = held.select(*cells, F.size("said").cast("long").alias("n"))
    order, earlier = Window.partitionBy("conv_id").orderBy("run", "fine"), (Window.unboundedPreceding, -1)
    numbered = stage(sized.select(*cells, (F.row_number().over(order) - 1).cast("long").alias("part"), F.coalesce(F.sum("n").over(order.rowsBetween(*earlier)), F.lit(0)).alias("first")), "dialogue-numbers")
    speakers = stage(told.where(_takes_part(F.col("role"), instructors)).select("conv_id", F.col("role").alias("speaker")).distinct(), "dialogue-speakers")
    parts = _null_safe(held, numbered, cells, "inner")
    laid = _laid(_null_safe(parts, speakers, ["conv_id"], "inner").withColumn("said", _in_order(F.col("said"))), instructors)
    # Only lengths go through the window, not texts.
    places = stage(laid.select("conv_id", "speaker", "part", "chars"), "dialogue-chars")
    along = Window.partitionBy("conv_id", "speaker").orderBy("part").rowsBetween(*earlier)
    places = places.select("conv_id", "speaker", "part", F.coalesce(F.sum("chars").over(along), F.lit(0)).alias("start"))
    placed = _null_safe(laid, places, ["conv_id", "speaker", "part"], "inner")
    return placed.withColumn("messages", _moved(F.col("messages"), F.col("first"), F.col("start")))


def op3_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every view, a row per message: its number, its first character's place in the view, its text, and what the mask covers."""
    views = rotate(table(spark, sf_dir, "conversations"))
    return views.select("conv_id", "speaker", F.explode("messages").alias("m")).select("conv_id", "speaker", "m.*")


OP3_SQL = f"""
WITH messages AS (SELECT DISTINCT conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
speakers AS (SELECT DISTINCT conv_id, role AS speaker FROM messages WHERE role IS NOT NULL AND role <> 'system'),
parts AS (
  SELECT s.conv_id, s.speaker, m.turn, m.role, md5(concat(coalesce(m.role, ''), ':', m.text)) AS digest,
    concat('{OPEN}', CASE WHEN m.role = s.speaker THEN 'assistant' WHEN m.role = 'system' THEN 'system' ELSE concat('user', coalesce(' name=' || m.role, '')) END, chr(10)) AS head,
    concat(m.text, '{CLOSE}', chr(10)) AS body, coalesce(m.role = s.speaker, false) AS own
  FROM speakers s JOIN messages m ON m.conv_id IS NOT DISTINCT FROM s.conv_id),
placed AS (
  SELECT *, row_number() OVER view - 1 AS number, CAST(sum(length(head) + length(body)) OVER (view ROWS UNBOUNDED PRECEDING) AS BIGINT) AS till
  FROM parts WINDOW view AS (PARTITION BY conv_id, speaker ORDER BY turn NULLS FIRST, digest, role NULLS FIRST))
SELECT conv_id, speaker, number, till - length(head) - length(body) AS start, concat(head, body) AS rendered,
  CASE WHEN own THEN till - length(body) END AS mask_start, CASE WHEN own THEN till - 1 END AS mask_end
FROM placed
"""

QUERIES = {"op3_chat_rotation": op3_chat_rotation}
SQL = {"op3_chat_rotation": OP3_SQL}
