"""Chat formatting: every participant's view of a conversation.

For each participant (each distinct role but ``system``) the dialogue is
rendered with that speaker as the assistant and the others as named users.
The mask lists the character spans that the assistant speaks (text and end
marker), end exclusive.

A conversation is rendered in parts of ``part_turns`` turn numbers, so a
conversation that holds a third of all turns is many small groups, never one;
participants are joined to parts, and a text is the concatenation of its
parts in order.  Repeated rows of one (conversation, part) beyond that are
kept; the group is as large as the part's rows.  Offsets count from the
start of the part.

Built-in functions only.  Defined cases: null text is empty; a null role is
the participant ``unknown``; a null turn comes first, in part -1; rows of equal turn are
ordered by role, then text; a null conv_id is one conversation; a
conversation of system turns alone has no participant and no row; markers
inside texts and role names are broken up and line ends in names are blanks, so neither can end or open a turn; other input columns
are not used.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.llm.textops import let, whole

START, END = "<|im_start|>", "<|im_end|>"
PART_TURNS = 256


def chat_views(turns: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """(conv_id, part, perspective, n_turns, text, masks array<struct<begin,end>>)."""
    t = turns.select(
        "conv_id", F.coalesce(F.floor(F.col("turn") / part_turns), F.lit(-1)).cast("bigint").alias("part"), "turn",
        F.coalesce(F.col("role"), F.lit("unknown")).alias("role"),
        F.replace(whole("text"), F.lit("<|im_"), F.lit("<| im_")).alias("text"))
    # null ids must meet: the key is never null
    key = F.struct(F.col("conv_id").isNull().alias("none"), F.coalesce(F.col("conv_id"), F.lit(0)).alias("id"))
    t = t.withColumn("k", key)
    who = t.where(F.col("role") != "system").groupBy("k").agg(F.collect_set("role").alias("who"))
    parts = t.groupBy("k", "part").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    rows = parts.join(who, "k").select("k", "part", "turns", F.explode("who").alias("perspective"))

    def shown(role):
        return F.replace(F.translate(role, "\n\r", "  "), F.lit("<|im_"), F.lit("<| im_"))

    def segment(x, me):
        mine = x["role"] == me
        head = F.when(x["role"] == "system", F.lit(f"{START}system\n")).when(mine, F.lit(f"{START}assistant\n")).otherwise(
            F.concat(F.lit(f"{START}user name="), shown(x["role"]), F.lit("\n")))
        return F.struct(F.concat(head, x["text"], F.lit(f"{END}\n")).alias("s"), F.length(head).alias("head"),
                        mine.alias("mine"))

    def view(segs):
        # where each segment ends: running sums over at most one part's turns
        ends = F.aggregate(segs, F.array().cast("array<bigint>"), lambda acc, s: F.concat(
            acc, F.array(F.coalesce(F.get(acc, F.size(acc) - 1), F.lit(0)) + F.length(s["s"]))))
        spans = let(ends, lambda e: F.filter(F.transform(segs, lambda s, i: F.when(s["mine"], F.struct(
            (F.get(e, i) - F.length(s["s"]) + s["head"]).alias("begin"), (F.get(e, i) - 1).alias("end")))),
            lambda m: m.isNotNull()))
        return F.struct(F.array_join(F.transform(segs, lambda s: s["s"]), "").alias("text"), spans.alias("masks"),
                        F.size(segs).cast("bigint").alias("n_turns"))
    out = rows.withColumn("v", let(F.transform("turns", lambda x: segment(x, F.col("perspective"))), view))
    return out.select(F.when(~F.col("k.none"), F.col("k.id")).alias("conv_id"), "part", "perspective", "v.n_turns",
                      "v.text", "v.masks")


def chat_digest(turns: DataFrame) -> DataFrame:
    """The columns of the registered query: whole rendered texts, masks as ``begin:end`` lists."""
    return chat_views(turns).select(
        "conv_id", "part", "perspective", "n_turns", "text", F.length("text").cast("bigint").alias("n_chars"),
        F.array_join(F.transform("masks", lambda m: F.concat_ws(":", m["begin"], m["end"])), ",").alias("masks"),
        F.aggregate("masks", F.lit(0).cast("bigint"), lambda a, m: a + m["end"] - m["begin"]).alias("n_mask_chars"))


CHAT_SQL = r"""
WITH t AS (
  SELECT conv_id, coalesce(floor(turn / 256), -1)::BIGINT AS part, turn, coalesce(role, 'unknown') AS role,
         replace(coalesce(text, ''), '<|im_', '<| im_') AS text FROM conversations),
who AS (SELECT DISTINCT conv_id, role AS perspective FROM t WHERE role <> 'system'),
s AS (
  SELECT t.conv_id, part, perspective, role = perspective AS mine,
         CASE WHEN role = 'system' THEN '<|im_start|>system' WHEN role = perspective THEN '<|im_start|>assistant'
              ELSE '<|im_start|>user name=' || replace(translate(role, chr(10) || chr(13), '  '), '<|im_', '<| im_') END || chr(10) AS head, text,
         row_number() OVER (PARTITION BY t.conv_id, part, perspective ORDER BY turn NULLS FIRST, role, text) AS i
  FROM t JOIN who ON t.conv_id IS NOT DISTINCT FROM who.conv_id),
e AS (
  SELECT *, head || text || '<|im_end|>' || chr(10) AS seg,
         sum(length(head) + length(text) + 11) OVER (PARTITION BY conv_id, part, perspective ORDER BY i)::BIGINT AS stop FROM s)
SELECT conv_id, part, perspective, count(*)::BIGINT AS n_turns, string_agg(seg, '' ORDER BY i) AS text,
       sum(length(seg))::BIGINT AS n_chars,
       coalesce(string_agg((stop - length(seg) + length(head))::VARCHAR || ':' || (stop - 1)::VARCHAR, ',' ORDER BY i)
                FILTER (WHERE mine), '') AS masks,
       coalesce(sum(length(text) + 10) FILTER (WHERE mine), 0)::BIGINT AS n_mask_chars
FROM e GROUP BY conv_id, part, perspective
"""
