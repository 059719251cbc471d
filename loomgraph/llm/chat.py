"""Preference formatting of chat conversations, with DataFrame functions only.

Two conversations, the chosen and the rejected one, are compared turn by turn.  Their longest common prefix of turns is
rendered once as the prompt; what follows in each becomes its completion, with a mask of runs ``LENGTHxFLAG``: the header
of every turn and turns of other roles have flag 0, contents of assistant turns and their end mark flag 1.

A conversation's turns are gathered by one shuffle on the pair, for a training example is one record by nature.

A table of conversations that names no preferences gives pairs by ``by_replies``: a conversation is chosen over itself with
one assistant turn, drawn by a hash of conv_id, replaced by the last assistant turn of conversation conv_id + 1, with
nothing behind it.

Defined results: turns are ordered by number, role and text (nulls first); null roles and texts are empty; a turn whose
number repeats is a turn of its own; a missing side is a conversation without turns; equal conversations give empty
completions; rows with a null pair or conv_id are dropped; a conversation without assistant turns is continued by the
other's, and without another the rejected side ends before the drawn turn; empty input, empty output; other columns may
have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"
LEARNED_ROLE = "assistant"
SEED = 23


def _shown(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit(MIDDLE), turn["text"], F.lit(CLOSE))


def _mask(turn: Column) -> Column:
    header = F.length(turn["role"]) + len(OPEN) + len(MIDDLE)
    body = F.length(turn["text"]) + len(CLOSE)
    return F.concat(header.cast("string"), F.lit("x0,"), body.cast("string"), F.when(turn["role"] == LEARNED_ROLE, F.lit("x1")).otherwise(F.lit("x0")))


def _turn() -> Column:
    """One turn of a table of turns, comparable in the order of a conversation."""
    return F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def preference_pairs(turns: DataFrame, pair: Column, chosen: Column) -> DataFrame:
    """One row per pair: pair_id, numbers of turns, prompt, chosen, chosen_mask, rejected, rejected_mask.

    turns: turn, role, text; ``pair`` and ``chosen`` are expressions over it (the pair's key; whether the row is of the
    chosen conversation).
    """
    rows = turns.select(pair.alias("pair_id"), chosen.alias("is_chosen"), _turn().alias("said")).where("pair_id is not null")
    side = lambda flag: F.sort_array(F.collect_list(F.when(F.col("is_chosen") == F.lit(flag), F.col("said"))))
    return formatted(rows.groupBy("pair_id").agg(side(True).alias("a"), side(False).alias("b")))


def formatted(both: DataFrame) -> DataFrame:
    """Pairs from pair_id and the turns of the chosen (a) and the rejected (b) conversation in order."""
    said = lambda name: F.transform(name, lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))
    both = both.select("pair_id", said("a").alias("a"), said("b").alias("b"))
    shorter = F.least(F.size("a"), F.size("b"))
    same = F.zip_with(F.slice("a", F.lit(1), shorter), F.slice("b", F.lit(1), shorter), lambda x, y: x == y)
    first_apart = F.array_position(same, F.lit(False))
    both = both.withColumn("n_common", F.when(first_apart > 0, first_apart - 1).otherwise(shorter).cast("long"))
    rest = lambda name: F.slice(name, F.col("n_common").cast("int") + 1, F.size(name))
    joined = lambda turns, how, sep: F.array_join(F.transform(turns, how), sep)
    return both.select(
        "pair_id",
        "n_common",
        F.size("a").cast("long").alias("n_chosen"),
        F.size("b").cast("long").alias("n_rejected"),
        joined(F.slice("a", F.lit(1), F.col("n_common").cast("int")), _shown, "").alias("prompt"),
        joined(rest("a"), _shown, "").alias("chosen"),
        joined(rest("a"), _mask, ",").alias("chosen_mask"),
        joined(rest("b"), _shown, "").alias("rejected"),
        joined(rest("b"), _mask, ",").alias("rejected_mask"),
    )


def by_replies(conversations: DataFrame, seed: int = SEED) -> DataFrame:
    """Each conversation paired with itself cut at one of its replies and ended by the last reply of the next one.

    One shuffle: a reply travels to its own conversation and, as the largest of its partition, to the one before.
    """
    known = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), _turn().alias("said")).where("conv_id is not null")
    nothing = F.lit(None).cast(known.schema["said"].dataType)
    own = F.struct(F.col("conv_id").alias("pair_id"), F.col("said").alias("said"), nothing.alias("reply"))
    lent = F.struct(F.try_subtract("conv_id", F.lit(1)).alias("pair_id"), nothing.alias("said"), F.when(F.col("said.role") == LEARNED_ROLE, F.col("said")).alias("reply"))
    rows = known.select(F.explode(F.array(own, lent)).alias("x")).select("x.*").where("pair_id is not null and (said is not null or reply is not null)")
    both = rows.groupBy("pair_id").agg(F.sort_array(F.collect_list("said")).alias("a"), F.max("reply").alias("reply")).where(F.size("a") > 0)
    replies = F.filter(F.transform("a", lambda x, i: F.when(x["role"] == LEARNED_ROLE, i)), lambda i: i.isNotNull())
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col("pair_id").cast("string")).cast("binary")), 1, 8), 16, 10).cast("long")
    both = both.withColumn("replies", replies)
    cut = F.when(F.size("replies") > 0, F.get("replies", F.pmod(draw, F.size("replies").cast("long")).cast("int"))).otherwise(F.size("a"))
    end = F.when(F.col("reply").isNotNull(), F.array("reply")).otherwise(F.array().cast(both.schema["a"].dataType))
    return formatted(both.select("pair_id", "a", F.concat(F.slice("a", F.lit(1), cut), end).alias("b")))


ORACLE_SQL = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k FROM said),
replies AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY k) - 1 AS j, count(*) OVER (PARTITION BY conv_id) AS n
  FROM numbered WHERE role = 'assistant'),
cuts AS (SELECT conv_id, k AS cut FROM replies WHERE j = ('0x' || substr(md5('23:' || conv_id), 1, 8))::BIGINT % n),
ends AS (
  SELECT n.conv_id, coalesce(min(c.cut), count(*) + 1) AS cut FROM numbered n LEFT JOIN cuts c USING (conv_id) GROUP BY n.conv_id),
sides AS (
  SELECT conv_id AS pair_id, true AS is_chosen, k, role, text FROM numbered
  UNION ALL SELECT n.conv_id, false, n.k, n.role, n.text FROM numbered n JOIN ends e USING (conv_id) WHERE n.k < e.cut
  UNION ALL SELECT e.conv_id, false, e.cut, r.role, r.text FROM ends e JOIN replies r ON r.conv_id = e.conv_id + 1 AND r.j = r.n - 1),
apart AS (
  SELECT a.pair_id, min(a.k) AS k
  FROM sides a LEFT JOIN sides b ON a.pair_id = b.pair_id AND a.k = b.k AND NOT b.is_chosen
  WHERE a.is_chosen AND (b.k IS NULL OR a.role <> b.role OR a.text <> b.text) GROUP BY a.pair_id),
counts AS (
  SELECT pair_id, count(*) FILTER (WHERE is_chosen) AS n_chosen, count(*) FILTER (WHERE NOT is_chosen) AS n_rejected
  FROM sides GROUP BY pair_id),
common AS (
  SELECT c.*, coalesce(a.k - 1, c.n_chosen) AS n_common FROM counts c LEFT JOIN apart a USING (pair_id)),
shown AS (
  SELECT n.pair_id, n.is_chosen, n.k, c.n_common,
         '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS said,
         (length(role) + 13) || 'x0,' || (length(text) + 11) || CASE WHEN role = 'assistant' THEN 'x1' ELSE 'x0' END AS mask
  FROM sides n JOIN common c USING (pair_id))
SELECT c.pair_id, c.n_common, c.n_chosen, c.n_rejected,
       coalesce((string_agg(said, '' ORDER BY k) FILTER (WHERE is_chosen AND k <= s.n_common)), '') AS prompt,
       coalesce((string_agg(said, '' ORDER BY k) FILTER (WHERE is_chosen AND k > s.n_common)), '') AS chosen,
       coalesce((string_agg(mask, ',' ORDER BY k) FILTER (WHERE is_chosen AND k > s.n_common)), '') AS chosen_mask,
       coalesce((string_agg(said, '' ORDER BY k) FILTER (WHERE NOT is_chosen AND k > s.n_common)), '') AS rejected,
       coalesce((string_agg(mask, ',' ORDER BY k) FILTER (WHERE NOT is_chosen AND k > s.n_common)), '') AS rejected_mask
FROM common c JOIN shown s USING (pair_id) GROUP BY ALL
"""
