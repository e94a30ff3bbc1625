"""Multi-party perspective rotation of conversations, in DataFrame operations.

For every participant of a conversation the dialogue is rendered with that
speaker as the assistant and all others as named users; system turns stay
system turns and have no perspective of their own. A rendered dialogue is the
chain of its segments in order of ``nth``; the mask of a segment covers what
the assistant has to say, its text with the end mark, and is empty elsewhere.

Nothing brings a conversation together: turns are numbered along one range
exchange, running lengths are sums within its partitions plus the sums of the
partitions before.

Turns are ordered by turn, then speaker, then the text's md5; equal rows are
rendered each. Nulls: a null text is empty, a null speaker is called
``unknown``, a null turn comes first, rows of a null conv_id are one
conversation. A conversation without participants, and an empty table, give no
rows. The marks' opening ``<|`` is broken by a backslash where a text holds it.
Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taxaweave.llm.common import query, table, written

SYSTEM = "system"
END = "<|end|>\n"


def header(role: Column, name: Column) -> Column:
    return F.when(role == "user", F.concat(F.lit("<|user name="), name, F.lit("|>\n"))).otherwise(F.concat(F.lit("<|"), role, F.lit("|>\n")))


def rotated(conversations: DataFrame, speaker: str = "role") -> DataFrame:
    """conv_id, perspective, nth, turn, speaker, chat_role, segment, start,
    mask_start, mask_end: code point offsets in the rendered dialogue."""
    said = F.replace(F.coalesce("text", F.lit("")), F.lit("<|"), F.lit("<\\|"))
    who = F.coalesce(F.col(speaker), F.lit("unknown"))
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", who.alias("speaker"), said.alias("said"), F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("tie"))
    order = ["conv_id", "turn", "speaker", "tie"]
    laid = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    # the row ids rise with the order, over all partitions
    laid = written(laid.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row")), "turns")
    narrow = laid.select("conv_id", "part", "row", "speaker", F.length("said").cast("long").alias("n"))
    parties = narrow.where(F.col("speaker") != SYSTEM).select(F.col("conv_id").alias("of"), F.col("speaker").alias("perspective")).distinct()
    role = F.when(F.col("speaker") == SYSTEM, SYSTEM).when(F.col("speaker") == F.col("perspective"), "assistant").otherwise("user")
    seen = narrow.join(parties, F.col("conv_id").eqNullSafe(F.col("of"))).withColumn("chat_role", role).withColumn("head", header(F.col("chat_role"), F.col("speaker")))
    seen = seen.withColumn("size", F.length("head") + F.col("n") + len(END))
    dialogue = ["of", "perspective"]
    here = Window.partitionBy("part", *dialogue).orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = seen.withColumn("upto", F.sum("size").over(here)).withColumn("no", F.row_number().over(Window.partitionBy("part", *dialogue).orderBy("row")))
    sums = seen.groupBy("part", *dialogue).agg(F.sum("size").alias("size"), F.count("*").alias("rows"))
    earlier = Window.partitionBy(*dialogue).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    before = sums.select(
        F.col("part").alias("p"), F.col("of").alias("o"), F.col("perspective").alias("v"),
        F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("size0"), F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows0"),
    )
    placed = local.join(before, (F.col("part") == F.col("p")) & F.col("of").eqNullSafe(F.col("o")) & (F.col("perspective") == F.col("v")))
    start = F.col("size0") + F.col("upto") - F.col("size")
    placed = placed.select("row", "perspective", "chat_role", "head", "size", (F.col("rows0") + F.col("no") - 1).alias("nth"), start.alias("start"))
    said_at = F.col("start") + F.length("head")
    return placed.join(laid.select("row", "conv_id", "turn", "speaker", "said"), "row").select(
        "conv_id",
        "perspective",
        "nth",
        "turn",
        "speaker",
        "chat_role",
        F.concat("head", "said", F.lit(END)).alias("segment"),
        "start",
        said_at.alias("mask_start"),
        F.when(F.col("chat_role") == "assistant", F.col("start") + F.col("size")).otherwise(said_at).alias("mask_end"),
    )


ORACLE = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, replace(coalesce(text, ''), '<|', '<\|') AS said, md5(coalesce(text, '')) AS tie
  FROM conversations
),
p AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'),
s AS (
  SELECT t.*, perspective,
    CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant' ELSE 'user' END AS chat_role
  FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id
),
h AS (
  SELECT *, CASE WHEN chat_role = 'user' THEN '<|user name=' || speaker || '|>' ELSE '<|' || chat_role || '|>' END || chr(10) AS head FROM s
),
g AS (SELECT *, head || said || '<|end|>' || chr(10) AS segment FROM h),
o AS (
  SELECT *,
    row_number() OVER w - 1 AS nth,
    sum(length(segment)) OVER w - length(segment) AS start
  FROM g WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, tie ROWS UNBOUNDED PRECEDING)
)
SELECT conv_id, perspective, nth::BIGINT AS nth, turn, speaker, chat_role, segment, start::BIGINT AS start,
  (start + length(head))::BIGINT AS mask_start,
  (CASE WHEN chat_role = 'assistant' THEN start + length(segment) ELSE start + length(head) END)::BIGINT AS mask_end
FROM o
"""


@query("op10_chat_perspectives", ORACLE)
def op10_chat_perspectives(spark, sf_dir):
    return rotated(table(spark, sf_dir, "conversations"))
