"""Preference pairs for chat training: the longest common turn prefix once as prompt, two masked completions.

A pair is a chosen and a rejected conversation. Their prompt is the longest run of first turns that both have alike
(turn number, role and text); what follows on each side is its completion. Every turn is rendered as
``<|role|>`` line, text, ``<|end|>`` line, and comes out as a row of its own with its place, so that a conversation
of any length is never gathered in one task; putting a side's rows together by place gives its string. A row's mask is
1 where the loss counts: the assistant's turns of a completion.

The registered query pairs every conversation with a copy of itself whose last assistant turn is the next
conversation's last assistant turn (ids ascending, after the last the first), the usual random negative.

Defined cases: rows without a conversation id belong to none and are left out; a null turn number comes after all
numbers; different messages with one turn number are one turn, in order of role and text, and repeated rows are one;
a null role or text is rendered as an empty string; a pair with a missing side has an empty prompt; a pair of equal
conversations has a prompt and no completions; without an assistant turn there is nothing to replace and the copies
are equal; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressgauge.llm.graph import written
from pressgauge.llm.ranks import ranked

_LAST = (1 << 63) - 1
KINDS = ("prompt", "chosen", "rejected")


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("")), F.lit("|>\n"), F.coalesce(text, F.lit("")), F.lit("\n<|end|>\n"))


def pairs(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """``pair_id, part, turn, place, role, text, mask``: the rendered turns of the prompt and of both completions.

    ``chosen``, ``rejected``: pair_id, turn, role, text. ``place`` orders several messages of one turn.

    The sides are compared by 128-bit hashes of their messages; the texts are shuffled once, by pair and turn, to learn
    their part. Only turns of several rows are put together, and these are few."""
    columns = ["pair_id", F.coalesce("turn", F.lit(_LAST)).alias("turn"), "role", "text"]
    rows = chosen.select(*columns, F.lit(True).alias("left")).union(rejected.select(*columns, F.lit(False).alias("left")))
    rows = rows.filter("pair_id is not null")
    message = F.struct(F.xxhash64("role", "text"), F.xxhash64(F.lit(1), "text", F.lit(2), "role"))
    left = F.col("left")
    marks = rows.groupBy("pair_id", "turn").agg(
        F.array_sort(F.collect_set(F.when(left, message))).alias("c"), F.array_sort(F.collect_set(F.when(~left, message))).alias("r"),
        F.greatest(F.count(F.when(left, 1)), F.count(F.when(~left, 1))).alias("times"),
    )
    marks = written(marks.select("pair_id", "turn", (F.col("c") != F.col("r")).alias("differs"), (F.col("times") > 1).alias("several")), "turns")
    # The first turn number at which the sides differ; a turn that one side lacks differs.
    split = marks.filter("differs").groupBy("pair_id").agg(F.min("turn").alias("split"))
    info = marks.join(split, "pair_id", "left").select(
        "pair_id", "turn", "several", (F.col("split").isNull() | (F.col("turn") < F.col("split"))).alias("common"),
    )
    part = F.when(F.col("common"), F.when(left, F.lit("prompt"))).when(left, F.lit("chosen")).otherwise(F.lit("rejected"))
    placed = rows.join(info, ["pair_id", "turn"]).select("pair_id", "turn", "role", "text", "several", part.alias("part")).filter("part is not null")
    single = placed.filter("not several").select("pair_id", "part", "turn", F.lit(0).alias("place"), "role", "text")
    several = placed.filter("several").groupBy("pair_id", "part", "turn").agg(
        F.array_sort(F.collect_set(F.struct("role", "text"))).alias("messages"),
    ).select("pair_id", "part", "turn", F.posexplode("messages").alias("place", "m")).select("pair_id", "part", "turn", "place", "m.role", "m.text")
    number = F.when(F.col("turn") < _LAST, F.col("turn"))
    mask = ((F.col("part") != "prompt") & F.coalesce(F.col("role") == "assistant", F.lit(False))).cast("int")
    return single.union(several).select(
        "pair_id", "part", number.alias("turn"), "place", "role", rendered(F.col("role"), F.col("text")).alias("text"), mask.alias("mask"),
    )


def with_swapped_answers(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every conversation as the chosen side of a pair of its own id, and the rejected side: the same turns, but for
    the last assistant turn, which is the last one of the next conversation that has one."""
    chosen = conversations.filter("conv_id is not null").select(F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    answer = F.struct(F.coalesce("turn", F.lit(_LAST)).alias("at"), F.col("text").alias("text"))
    last = chosen.filter("role = 'assistant'").groupBy("pair_id").agg(F.max(answer).alias("last"))
    order = ranked(last.select("pair_id", "last"), [F.col("pair_id")])
    n = order.count()
    following = order.select(F.pmod(F.col("rank") - 1, F.lit(max(n, 1))).alias("rank"), F.col("last.text").alias("other"))
    swap = order.join(following, "rank").select("pair_id", F.col("last.at").alias("at"), F.col("last.text").alias("own"), "other")
    hit = (F.col("role") == "assistant") & (F.coalesce("turn", F.lit(_LAST)) == F.col("at")) & F.col("text").eqNullSafe(F.col("own"))
    rejected = chosen.join(swap, "pair_id", "left").select(
        "pair_id", "turn", "role", F.when(hit, F.col("other")).otherwise(F.col("text")).alias("text"),
    )
    return chosen, rejected


def query(spark: SparkSession, d: str) -> DataFrame:
    return pairs(*with_swapped_answers(spark.read.parquet(f"{d}/conversations.parquet")))


SQL = """
WITH c AS (SELECT DISTINCT conv_id AS pair_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
answers AS (SELECT pair_id, list(struct_pack(spot := coalesce(turn, 9223372036854775807), text := text)
    ORDER BY coalesce(turn, 9223372036854775807) DESC, text DESC NULLS LAST)[1] AS last
  FROM c WHERE role = 'assistant' GROUP BY pair_id),
swap AS (SELECT pair_id, last.spot AS spot, last.text AS own,
    coalesce(lead(last.text) OVER (ORDER BY pair_id), first_value(last.text) OVER (ORDER BY pair_id)) AS other FROM answers),
r AS (SELECT pair_id, turn, role, CASE WHEN role = 'assistant' AND coalesce(turn, 9223372036854775807) = spot
    AND text IS NOT DISTINCT FROM own THEN other ELSE text END AS text FROM c LEFT JOIN swap USING (pair_id)),
lc AS (SELECT pair_id, coalesce(turn, 9223372036854775807) AS t, list(struct_pack(role := role, text := text) ORDER BY role NULLS FIRST, text NULLS FIRST) AS m
  FROM c GROUP BY ALL),
lr AS (SELECT pair_id, coalesce(turn, 9223372036854775807) AS t, list(struct_pack(role := role, text := text) ORDER BY role NULLS FIRST, text NULLS FIRST) AS m
  FROM (SELECT DISTINCT * FROM r) GROUP BY ALL),
split AS (SELECT pair_id, min(t) AS s FROM lc FULL JOIN lr USING (pair_id, t) WHERE lc.m IS DISTINCT FROM lr.m GROUP BY pair_id),
parts AS (
  SELECT pair_id, CASE WHEN s IS NULL OR t < s THEN 'prompt' ELSE 'chosen' END AS part, t, m FROM lc LEFT JOIN split USING (pair_id)
  UNION ALL SELECT pair_id, 'rejected', t, m FROM lr JOIN split USING (pair_id) WHERE t >= s),
rows AS (SELECT pair_id, part, t, unnest(range(0, len(m))) AS place, unnest(m) AS x FROM parts)
SELECT pair_id, part, CASE WHEN t < 9223372036854775807 THEN t END AS turn, CAST(place AS INT) AS place, x.role AS role,
  '<|' || coalesce(x.role, '') || '|>' || chr(10) || coalesce(x.text, '') || chr(10) || '<|end|>' || chr(10) AS text,
  CASE WHEN part <> 'prompt' AND x.role = 'assistant' THEN 1 ELSE 0 END AS mask
FROM rows
"""
