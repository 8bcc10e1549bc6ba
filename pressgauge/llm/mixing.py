"""Mixing sources to target weights by hash-threshold histograms.

A document's size is its number of words (runs of other characters than blanks, tabs and line ends). Sources in code
point order, null last, weigh 1, 2, 3, 1, 2, 3, ...; together they get the size of all documents, but none more than
three times its own: what is above goes to the others by weight, until none is above.

A source that gets r times its size takes every document floor(r) times, and once more those whose hash lies below a
threshold that spends the rest of its budget. The thresholds come from histograms: sizes are summed by source and the
first bits of the hash, the bucket in which the budget ends is found from running sums over the buckets, and only the
documents of that bucket are summed again by the next bits. Nothing is sorted, and the copies of one pass lie within
those of a larger budget.

Defined cases: a null text has size 0; documents of one id have one hash, so they are taken together; a null id is an
id; a source without words has target 0 and is taken whole number times 0; an empty table gives an empty result;
other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pressgauge.llm.graph import written
from pressgauge.llm.ranks import ranked

WEIGHTS = (1, 2, 3)
MOST = 3
#: Hash bits that a round of histograms resolves, and rounds: 60 bits in all.
BITS, ROUNDS = 12, 5


def words(text: Column | str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def draw(doc_id: Column | str) -> Column:
    """60 bits of a document's hash."""
    return F.conv(F.substring(F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``.

    Each round shares what is left by weight among the sources that are not yet full; the driver sees three sums."""
    by_rank = F.array(*[F.lit(w) for w in weights])
    now = ranked(sizes, [F.col("source").asc_nulls_last()]).select(
        "source", "source_size", F.element_at(by_rank, (F.pmod("rank", F.lit(len(weights))) + 1).cast("int")).cast("double").alias("weight"),
        F.lit(False).alias("full"),
    )
    total = now.agg(F.sum("source_size")).first()[0] or 0
    cap = F.col("source_size") * F.lit(float(most))
    while True:
        taken, weight, full = now.agg(
            F.coalesce(F.sum(F.when(F.col("full"), cap)), F.lit(0.0)), F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))), F.lit(0.0)),
            F.count(F.when(F.col("full"), 1)),
        ).first()
        share = F.col("weight") * F.lit((total - taken) / weight if weight else 0.0)
        after = written(now.withColumn("full", F.col("full") | (share > cap)), "targets")
        if after.filter("full").count() == full:
            return now.select("source", "source_size", F.when(F.col("full"), cap).otherwise(share).alias("target"))
        now = after


def thresholds(sized: DataFrame, goals: DataFrame) -> DataFrame:
    """``source, below``: the hash below which a source's documents are taken once more.

    ``sized``: source, size, draw; ``goals``: source, rest (the words to be spent)."""
    found = goals.select("source", "rest", F.lit(0).cast("long").alias("below"))
    rows = sized.select("source", "size", "draw")
    by_source = Window.partitionBy("source").orderBy("bucket")
    for k in range(ROUNDS):
        left = BITS * (ROUNDS - 1 - k)
        width = 1 << left
        histogram = rows.groupBy("source", F.shiftright("draw", left).alias("bucket")).agg(F.sum("size").alias("size"))
        # A source has at most 2^BITS buckets, all in the one that the round before has left open.
        ends = histogram.withColumn("upto", F.sum("size").over(by_source)).join(found.select(F.col("source").alias("s"), "rest", "below"), F.col("source").eqNullSafe(F.col("s")))
        # The first bucket that doesn't fit whole, and the words of those before it.
        open_bucket = ends.filter("upto > rest").groupBy("s").agg(
            F.min("bucket").alias("bucket"), F.min_by(F.col("upto") - F.col("size"), "bucket").alias("before"),
        ).withColumnRenamed("s", "o")
        found = written(
            found.join(open_bucket, F.col("source").eqNullSafe(F.col("o")), "left").select(
                "source",
                # A source whose buckets all fit takes them all.
                F.when(F.col("bucket").isNull(), F.lit(-1)).otherwise(F.col("rest") - F.col("before")).alias("rest"),
                F.when(F.col("bucket").isNull(), F.col("below") + F.lit(width << BITS)).otherwise(F.col("bucket") * F.lit(width)).alias("below"),
                F.coalesce("bucket", F.lit(-1)).alias("bucket"),
            ), "thresholds",
        )
        done = found.filter("rest < 0").drop("bucket")
        going = found.filter("rest >= 0")
        if k == ROUNDS - 1 or going.isEmpty():
            return found.select("source", "below")
        rows = rows.join(
            going.select(F.col("source").alias("s"), F.col("bucket").alias("b")),
            F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("draw", left) == F.col("b")),
        ).select("source", "size", "draw")
        found = going.drop("bucket").union(done)


def mixed(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The documents with ``size, source_size, target, copies, taken``, which take the place of columns of these names;
    their other columns as they were."""
    made = ["size", "source_size", "target", "copies", "taken"]
    own = documents.drop(*made)
    sized = written(own.select("source", words("text").alias("size"), draw("doc_id").alias("draw")), "sized")
    goals = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    ratio = F.col("target") / F.greatest(F.col("source_size"), F.lit(1))
    goals = written(goals.withColumn("times", F.floor(ratio).cast("long")).withColumn(
        "rest", F.col("target") - F.col("times") * F.col("source_size"),
    ), "goals")
    below = thresholds(sized, goals.filter("source_size > 0")).withColumnRenamed("source", "s")
    # One row for each source, written so that Spark knows its size when it chooses the join.
    plan = written(goals.join(below, F.col("source").eqNullSafe(F.col("s")), "left").select(
        F.col("source").alias("__mix"), F.struct("source_size", "target", "times", F.coalesce("below", F.lit(0)).alias("below")).alias("__plan"),
    ), "plan")
    size, goal = words("text"), F.col("__plan")
    copies = goal["times"] + F.when(draw("doc_id") < goal["below"], 1).otherwise(0)
    return own.join(plan, F.col("source").eqNullSafe(F.col("__mix")), "left").select(
        *own.columns, size.alias("size"), goal["source_size"].alias("source_size"), goal["target"].alias("target"),
        copies.cast("long").alias("copies"), (size * copies).alias("taken"),
    )


def query(spark: SparkSession, d: str) -> DataFrame:
    documents = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "source", "text")
    return mixed(documents).select("doc_id", "size", "source_size", "target", "taken")


def stage(spark: SparkSession, docs: DataFrame, d: str) -> DataFrame:
    """The documents that the mix takes, with the times that it takes them."""
    return mixed(docs).filter("copies > 0")


#: Sorted sums in place of histograms; the shares of the sources that stay below their limit in closed form.
SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS draw FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS w,
    CAST(source_size * 3 AS DOUBLE) AS cap, sum(source_size) OVER () AS total FROM s),
o AS (SELECT *, row_number() OVER u AS k, cap / w AS ratio,
    (total - coalesce(sum(cap) OVER (u ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(w) OVER (u ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM r WINDOW u AS (ORDER BY cap / w, source NULLS LAST)),
t AS (SELECT source, source_size, least(cap, w * (SELECT arg_min(level, k) FROM o WHERE level <= ratio)) AS target FROM r),
p AS (SELECT *, floor(target / greatest(source_size, 1)) AS times FROM t),
c AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY draw RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM d)
SELECT doc_id, size, source_size, target,
  CAST(size * (times + CASE WHEN upto <= target - times * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM c JOIN p ON c.source IS NOT DISTINCT FROM p.source
"""
