"""Preference formatting of conversations, in DataFrame operations only (operator 8).

Conversations 2k and 2k + 1 form pair k: the even one is chosen, the odd one rejected. The longest
common prefix of turns is rendered once, as prompt; the turns after it are the two completions, of
which only the assistant's turns count in the loss.

The result has a row for each rendered turn, so a conversation of any length is never gathered into
one value: turns are aligned by their number, and the prefix ends before the first number at which
the two sides differ, which is a minimum with partial sums before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: How a turn is rendered.
OPEN, MIDDLE, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"


def preference_pairs(turns: DataFrame) -> DataFrame:
    """(pair_id, part, turn, role, segment, in_loss, pair_status), a row for each rendered turn.

    `turns` has conv_id, turn, role, text. part: prompt (common prefix, once), chosen or rejected.
    pair_status: paired, identical (no completion is left) or unpaired (the other conversation does
    not exist; all its turns are the completion and none is a prompt). Null roles and texts are
    rendered as empty; they equal empty ones. Turns that share a number are one step, rendered in
    the order of role and text, repeated rows included; null turn numbers come before all others.
    Rows without a conv_id belong to no conversation and are left out. An empty table gives no rows.
    """
    rows = turns.where("conv_id is not null").select(
        F.floor(F.col("conv_id") / 2).cast("long").alias("pair_id"),
        F.pmod(F.col("conv_id"), F.lit(2)).cast("int").alias("side"),
        F.coalesce(F.col("turn").cast("long"), F.lit(-(2**63))).alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    # One row for each distinct turn and side; what stands at a number is compared by hashes of its turns, with how often each occurs.
    steps = rows.groupBy("pair_id", "turn", "role", "text").agg(F.count_if(F.col("side") == 0).alias("chosen"), F.count_if(F.col("side") == 1).alias("rejected"))
    ends = steps.groupBy("pair_id").agg(
        F.coalesce(F.min(F.when(F.col("chosen") != F.col("rejected"), F.col("turn"))), F.lit(2**63 - 1)).alias("ends"),
        F.max("chosen").alias("has_chosen"),
        F.max("rejected").alias("has_rejected"),
    )
    status = F.when((F.col("has_chosen") == 0) | (F.col("has_rejected") == 0), "unpaired").when(F.col("ends") == 2**63 - 1, "identical").otherwise("paired")
    both = steps.join(ends.withColumn("pair_status", status), "pair_id")
    copies = F.when(F.col("turn") < F.col("ends"), F.array(F.struct(F.lit("prompt").alias("part"), F.col("chosen").alias("n")))).otherwise(
        F.array(F.struct(F.lit("chosen").alias("part"), F.col("chosen").alias("n")), F.struct(F.lit("rejected").alias("part"), F.col("rejected").alias("n")))
    )
    parts = both.withColumn("p", F.explode(copies)).where("p.n > 0")
    parts = parts.withColumn("repeat", F.explode(F.sequence(F.lit(1).cast("long"), F.col("p.n"))))
    return parts.select(
        "pair_id",
        F.col("p.part").alias("part"),
        F.when(F.col("turn") != -(2**63), F.col("turn")).alias("turn"),
        "role",
        F.concat(F.lit(OPEN), "role", F.lit(MIDDLE), "text", F.lit(CLOSE)).alias("segment"),
        ((F.col("p.part") != "prompt") & (F.col("role") == "assistant")).alias("in_loss"),
        "pair_status",
    )


SQL = f"""
WITH t AS (
  SELECT conv_id // 2 AS pair_id, conv_id % 2 AS side, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), at_turn AS (
  SELECT pair_id, turn, list((role, text) ORDER BY role, text) FILTER (side = 0) AS c, list((role, text) ORDER BY role, text) FILTER (side = 1) AS r FROM t GROUP BY ALL
), ends AS (
  SELECT pair_id, min(turn) FILTER (c IS DISTINCT FROM r) AS e, bool_or(c IS NOT NULL) AS hc, bool_or(r IS NOT NULL) AS hr FROM at_turn GROUP BY 1
), parts AS (
  SELECT pair_id, CASE WHEN e IS NULL OR turn < e THEN 'prompt' WHEN side = 0 THEN 'chosen' ELSE 'rejected' END AS part, side, turn, role, text,
    CASE WHEN NOT hc OR NOT hr THEN 'unpaired' WHEN e IS NULL THEN 'identical' ELSE 'paired' END AS pair_status
  FROM t JOIN ends USING (pair_id)
)
SELECT pair_id::BIGINT AS pair_id, part, turn, role, '{OPEN}' || role || chr(10) || text || '<|im_end|>' || chr(10) AS segment,
  part <> 'prompt' AND role = 'assistant' AS in_loss, pair_status
FROM parts WHERE part <> 'prompt' OR side = 0
"""
