"""Multi-party chat formatting by perspective rotation.

For every participant of a conversation the whole dialogue is rendered once, with that participant as the assistant and
all others as named users; system turns stay system turns. The loss mask covers the assistant's words and end marks only.

The result has one row per conversation, perspective and turn: the rendered segment, its character range in the whole
rendering (segments of one perspective, joined in order of seq, are the rendering) and the mask's range. A conversation
may be very long, so offsets come from prefix sums over blocks of turns, not from one task that holds a conversation.

Defined results: a null role reads as "unknown", a null text as empty, a null conv_id is a conversation of its own;
turns with equal numbers are ordered by role and text, null turns come first; repeated rows are turns like others; a
conversation without participants (system turns only) and an empty table give no rows; other columns are ignored. Names
and texts are rendered as they are: one that holds the format's marks or a line break in a name stays as it is, and only
the offsets tell where its turn ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

START, END = "<|im_start|>", "<|im_end|>"
#: Turn numbers that one block of the prefix sums spans.
BLOCK_TURNS = 256


def turns_of(conversations: DataFrame) -> DataFrame:
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.coalesce(F.col("turn").cast("long"), F.lit(-1)).alias("turn"),
        F.coalesce("role", F.lit("unknown")).alias("speaker"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def _header(role: str, name: Column | None = None) -> Column:
    return F.concat(F.lit(f"{START}{role}"), *([] if name is None else [F.lit(" name="), name]), F.lit("\n"))


def rotate(conversations: DataFrame, system_role: str = "system", block_turns: int = BLOCK_TURNS) -> DataFrame:
    """conv_id, perspective, seq, turn, speaker, role, segment, seg_start, seg_end, mask_start, mask_end (ends exclusive;
    an empty mask has mask_start = mask_end = seg_end)."""
    conv = ["conv", "none"]  # keys without nulls
    turns = turns_of(conversations).withColumns({"conv": F.coalesce("conv_id", F.lit(0)), "none": F.col("conv_id").isNull(), "block": F.floor(F.col("turn") / block_turns)})
    system = F.col("speaker") == system_role
    header = F.when(system, _header("system")).otherwise(_header("user", F.col("speaker")))
    turns = turns.withColumn("chars", (F.length(header) + F.length("text") + len(END) + 1).cast("long"))
    # For someone who says nothing a rendering is the sum of these lengths; a participant's own turns have a shorter
    # header each. So offsets need lengths per block, and each participant's number of turns before it.
    parts = turns.select(*conv, "block", "speaker", "chars")
    sums = parts.groupBy(*conv, "block").agg(F.sum("chars").alias("b_chars"), F.count("*").alias("b_turns"))
    own = parts.where(~system).groupBy(*conv, "block", F.col("speaker").alias("perspective")).agg(F.count("*").alias("b_own"))
    frame = sums.join(own.select(*conv, "perspective").distinct(), conv).join(own, [*conv, "block", "perspective"], "left")
    before = Window.partitionBy(*conv, "perspective").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    earlier = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    frame = frame.select(*conv, "block", "perspective", earlier("b_chars").alias("chars_before"), earlier("b_turns").alias("turns_before"), earlier("b_own").alias("own_before"))
    # texts are shuffled once, to their blocks; perspectives meet them there
    within = Window.partitionBy(*conv, "block").orderBy("turn", "speaker", "text")
    rows = turns.withColumns({"place": F.row_number().over(within), "to": F.sum("chars").over(within.rowsBetween(Window.unboundedPreceding, 0))})
    rows = rows.join(frame, [*conv, "block"])
    mine = F.col("speaker") == F.col("perspective")
    up_to = Window.partitionBy(*conv, "block", "perspective").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    shorter = F.length(_header("assistant")) - F.length(_header("user", F.col("perspective")))
    head = F.when(mine, _header("assistant")).otherwise(header)
    rows = rows.withColumns({"end": F.col("chars_before") + F.col("to") + (F.col("own_before") + F.count_if(mine).over(up_to)) * shorter, "head": head})
    segment = F.concat("head", "text", F.lit(END + "\n"))
    start = F.col("end") - F.length("head") - F.length("text") - len(END) - 1
    return rows.select(
        "conv_id",
        "perspective",
        (F.col("turns_before") + F.col("place") - 1).cast("long").alias("seq"),
        "turn",
        "speaker",
        F.when(system, "system").when(mine, "assistant").otherwise("user").alias("role"),
        segment.alias("segment"),
        start.alias("seg_start"),
        F.col("end").alias("seg_end"),
        F.when(mine, start + F.length("head")).otherwise(F.col("end")).alias("mask_start"),
        F.when(mine, F.col("end") - 1).otherwise(F.col("end")).alias("mask_end"),
    )


ORACLE = f"""
WITH t AS (
  SELECT conv_id, coalesce(turn, -1) AS turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS text
  FROM conversations),
p AS (SELECT DISTINCT conv_id AS c, speaker AS perspective FROM t WHERE speaker <> 'system'),
r AS (
  SELECT t.*, p.perspective,
    CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant' ELSE 'user' END AS role,
    '{START}' || CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant'
                      ELSE 'user name=' || speaker END || chr(10) AS head
  FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.c),
s AS (
  SELECT *, head || text || '{END}' || chr(10) AS segment,
    row_number() OVER w - 1 AS seq,
    sum(length(head || text || '{END}' || chr(10))) OVER (w ROWS UNBOUNDED PRECEDING) AS seg_end
  FROM r WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn, speaker, text))
SELECT conv_id, perspective, seq, turn, speaker, role, segment,
  CAST(seg_end - length(segment) AS BIGINT) AS seg_start, CAST(seg_end AS BIGINT) AS seg_end,
  CAST(CASE WHEN role = 'assistant' THEN seg_end - length(segment) + length(head) ELSE seg_end END AS BIGINT) AS mask_start,
  CAST(CASE WHEN role = 'assistant' THEN seg_end - 1 ELSE seg_end END AS BIGINT) AS mask_end
FROM s
"""
